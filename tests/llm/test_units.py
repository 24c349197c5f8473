"""Line and paragraph dedup against a dictionary of units in order."""

import random
import re
import time

import pytest

from carelens.llm import units

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, breaks, least):
    """Per row (doc_id, text) in rank order of equal doc_ids: gone units and kept bytes."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = {}, [None] * len(rows)
    for i in order:
        doc_id, text = rows[i]
        body = (text or "").encode()
        found, last = [], None
        for m in WORDS.finditer(body):
            if last is None or body[last : m.start()].count(b"\n") >= breaks:
                found.append([])
            found[-1].append(m)
            last = m.end()
        gone, kept, at = [], b"", 0
        for unit in found:
            if len(unit) < least:
                continue
            key = tuple(m[0].translate(bytes(c + 32 if 65 <= c < 91 else c for c in range(256))) for m in unit)
            start, end = unit[0].start(), unit[-1].end()
            if key in seen:
                gone.append((start, end, len(unit), *seen[key]))
                kept += body[at:start]
                at = end + len(body[end:]) - len(body[end:].lstrip(b" \t\n\x0b\x0c\r"))
            else:
                seen[key] = (doc_id, start)
        out[i] = (gone, (kept + body[at:]).decode())
    return out


def some_rows(seed):
    rng = random.Random(seed)
    lines = ["One two  three four", "one TWO three\tfour ", "a b", "é x É y", "É x É y", "", "  ", "p q r s\x0bt"]
    rows = [(None, "one two three four"), (3, None), (2, ""), (5, "\n\n"), (1, "a b c d\n\na b c d\n e")]
    rows += [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 8)))) for i in range(10, 50)]
    return rows + [(None, "é x É y"), (12, "p q r s t\nnew words of this row")]


@pytest.mark.parametrize(("breaks", "least"), [(1, 3), (2, 4), (1, 1)])
def test_against_brute_force(work, frame, breaks, least):
    rows = some_rows(breaks + least)
    docs = frame([(i, t, None) for i, t in rows]).coalesce(1)
    out = units.unit_dedup(work, docs, breaks, least).collect()
    got = sorted(repr((r.doc.doc_id, sorted(tuple(g) for g in r.gone or []), r.kept)) for r in out)
    assert got == sorted(repr((i, gone, kept)) for (i, _), (gone, kept) in zip(rows, brute(rows, breaks, least), strict=True))
    for r in out:
        body = (r.doc.text or "").encode()
        assert b"".join(body[p.start : p.end] for p in r.places).decode() == r.kept


def test_a_long_text_of_repeated_lines_is_cut_in_linear_time(work, frame):
    line = "one two three four five six seven eight nine ten\n"
    text = line * 80_000  # 4 MB, all but one line goes
    docs = frame([(1, text, None), (2, line, None)])
    start = time.time()
    got = sorted((r.doc.doc_id, r.kept, len(r.gone or [])) for r in units.unit_dedup(work, docs).select("doc", "kept", "gone").collect())
    assert time.time() - start < 60  # cutting the rest of the text for every line took minutes
    assert got == [(1, line, 79_999), (2, "", 1)]


def test_rows_that_repeat_a_doc_id_rank_by_their_columns(spark, work, frame):
    rows = [(7, "first line of ten words which is here and there again\nx", "a"), (7, "first line of ten words which is here and there again\ny", "b")]
    kept = []
    for parts in (rows, rows[::-1]):
        docs = frame(parts).repartition(2, "source")
        kept.append(sorted((r.doc.source, r.kept) for r in units.unit_dedup(work, docs).collect()))
    assert kept[0] == kept[1]


def test_empty(work, frame):
    assert units.unit_dedup(work, frame([(1, "x", None)]).where("false")).count() == 0
