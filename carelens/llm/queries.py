"""The operators as queries over the given tables, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm import forest, html, lines, merkle, minhash, mixing, packing, spots, substring, toxicity, trie, units, vectors
from carelens.llm.common import Work
from carelens.llm.tokens import vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_DRAW = " ".join(f"WHEN {k} THEN ('0x' || substr(md5('{k // 4}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), {1 + 8 * (k % 4)}, 8))::BIGINT" for k in range(mixing.DRAWS))


@_query("op7_mix_sources", f"""
WITH sizes AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
turned AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS full_size FROM per),
levels AS (SELECT *, CAST((SELECT sum(source_size) FROM turned) - coalesce(sum(full_size) OVER before, 0) AS DOUBLE)
             / CAST((SELECT sum(w) FROM turned) - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS level
           FROM turned WINDOW before AS (ORDER BY CAST(full_size AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aims AS (SELECT source, source_size, CASE WHEN full_size > level * w THEN (SELECT max(level) FROM levels WHERE full_size > level * w) * w ELSE CAST(full_size AS DOUBLE) END AS target FROM levels),
drawn AS (SELECT s.*, a.source_size, a.target, k, CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0 END AS rate, CASE k {_DRAW} END AS draw
          FROM sizes s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source CROSS JOIN range({mixing.DRAWS}) AS r(k)),
copied AS (SELECT *, CAST(floor(rate) AS BIGINT) + CAST(draw < (rate - floor(rate)) * 4294967296.0 AS BIGINT) AS copies FROM drawn),
chosen AS (SELECT source, k FROM (SELECT source, k, row_number() OVER (PARTITION BY source ORDER BY abs(sum(copies * size) - any_value(target)), k) AS place FROM copied GROUP BY source, k) WHERE place = 1)
SELECT c.doc_id, c.size, c.source_size, c.target, CAST(c.copies * c.size AS BIGINT) AS taken
FROM copied c JOIN chosen h ON c.k = h.k AND c.source IS NOT DISTINCT FROM h.source""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.plan(Work(spark, "op7"), _table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query("op8_line_dedup", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, {_KEY} AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (f.key IS NOT NULL) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY r, doc_id""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lines.line_dedup(Work(spark, "op8"), docs)
    return out.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


@_query("op5_pack_sequences")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(Work(spark, "op5"), _table(spark, sf_dir, "documents"), vocabulary())
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@_query("op9_near_vectors")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_vectors(Work(spark, "op9"), _table(spark, sf_dir, "embeddings"))


@_query("op10_nearest_vectors", """
WITH good AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
              WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
far AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS score
        FROM good q JOIN good c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM far)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 10""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(Work(spark, "op10"), _table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@_query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SAME = f"regexp_replace(translate(trim(body, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')"
#: Units with their places (r, doc_id, start, size, body) to those that stand earlier.
_LATER = f"""w AS (SELECT *, {_SAME} AS unit FROM u WHERE trim(body, {_WHITE}) <> ''),
n AS (SELECT *, CAST(len(string_split(unit, ' ')) AS BIGINT) AS n_words FROM w),
f AS (SELECT *, row_number() OVER o AS place, first_value(doc_id) OVER o AS kept_doc_id, first_value(start) OVER o AS kept_start
      FROM n WHERE n_words >= {units.MIN_WORDS} WINDOW o AS (PARTITION BY unit ORDER BY doc_id NULLS LAST, r, start))
SELECT doc_id, start, CAST(start + size AS BIGINT) AS "end", n_words, kept_doc_id, kept_start FROM f WHERE place > 1"""


def _units(spark: SparkSession, sf_dir: str, name: str, breaks: int) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = units.unit_dedup(Work(spark, name), docs, breaks).select("doc.doc_id", F.explode("gone").alias("g"))
    return out.select("doc_id", "g.start", "g.end", "g.n_words", "g.kept_doc_id", "g.kept_start")


@_query("op2_unit_dedup", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
p AS (SELECT *, coalesce(sum(strlen(line) + 1) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_at FROM l),
u AS (SELECT r, doc_id, CAST(line_at + strlen(line) - strlen(ltrim(line, {_WHITE})) AS BIGINT) AS start, strlen(trim(line, {_WHITE})) AS size, line AS body FROM p),
{_LATER}""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _units(spark, sf_dir, "op2", units.LINE)


_GAP = "[\\x20\\x09\\x0B-\\x0D]"
#: Words with no more than one line break between them.
_PARAGRAPH = f"[^\\x20\\x09-\\x0D]+(?:(?:{_GAP}+|{_GAP}*\\n{_GAP}*)[^\\x20\\x09-\\x0D]+)*"


@_query("paragraph_dedup", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_PARAGRAPH}') AS us, string_split_regex(coalesce(text, ''), '{_PARAGRAPH}') AS gaps FROM documents),
l AS (SELECT r, doc_id, generate_subscripts(us, 1) AS i, unnest(us) AS body, gaps FROM d),
u AS (SELECT r, doc_id, body, strlen(body) AS size, CAST(sum(strlen(gaps[i])) OVER w + coalesce(sum(strlen(body)) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM l WINDOW w AS (PARTITION BY r ORDER BY i)),
{_LATER}""")
def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _units(spark, sf_dir, "paragraphs", units.PARAGRAPH)


@_query("op3_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.pages_text(_table(spark, sf_dir, "pages"))


@_query("op6_near_documents")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_documents(Work(spark, "op6"), _table(spark, sf_dir, "documents"))


@_query("op1_substring_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring.substring_dedup(Work(spark, "op1"), docs)
    return out.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op12_spot_fingerprints")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.fingerprint_docs(Work(spark, "op12"), _table(spark, sf_dir, "documents"))


#: The unsigned CRC-32 of a text, byte by byte with the table of its polynomial.
_CRC = """bits AS (SELECT i, 0 AS k, i AS v FROM range(256) AS r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crcs AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8)"""


def _crc(text: str) -> str:
    """SQL for the CRC-32 of an ASCII text, where the table crcs is joined."""
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda a, b: xor(a >> 8, t[CAST(xor(a & 255, b) AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"


def _hashed(fields: dict[str, str]) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in (f"CAST({v} AS VARCHAR)" for v in fields.values())) + ")"


@_query("op11_prefix_trie", f"""
WITH RECURSIVE {_CRC},
own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p,
          coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id AS c, conv_id - conv_id % 20 AS base, {_crc("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM own, crcs),
rebuilt AS (SELECT c, p, role, text FROM convs JOIN own ON conv_id = base WHERE p <= h UNION ALL SELECT c, p + 3, role, text FROM convs JOIN own ON conv_id = c WHERE p > h),
turned AS (SELECT c, row_number() OVER w AS d, count(*) OVER (PARTITION BY c) AS n, text,
             md5(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY p)) AS start FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY p)),
ways AS (SELECT c, d, n, start, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM turned
  UNION ALL SELECT c, 0, coalesce(n, 0), '', 0 FROM convs LEFT JOIN (SELECT DISTINCT c, n FROM turned) AS t USING (c)),
named AS (SELECT *, min(c) OVER (PARTITION BY d, start) AS node FROM ways),
nodes AS (SELECT node, d, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = n), '')) AS ends_sha256,
            CAST(count(*) = count(*) FILTER (d = n) AS BIGINT) AS leaf FROM named GROUP BY node, d),
below AS (SELECT w.node, w.d, sum(u.leaf) AS n_leaves, sum(u.saved) AS saved_tokens, count(*) FILTER (u.d = w.d + 1) AS n_children
          FROM nodes u JOIN named w ON w.c = u.node AND w.d <= u.d GROUP BY w.node, w.d)
SELECT m.node AS conv_id, m.d AS depth, w.node AS parent_conv_id, m.n_convs, b.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM nodes m JOIN below b ON b.node = m.node AND b.d = m.d LEFT JOIN named w ON w.c = m.node AND w.d = m.d - 1""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "op11")
    return trie.trie(work, *trie.share_starts(work, trie.turns(work, _table(spark, sf_dir, "conversations"))))


_FIELDS = {c: c for c in merkle.FIELDS}


@_query("op13_merkle_manifest", f"""
WITH RECURSIVE {_CRC},
hashed AS (SELECT row_number() OVER () AS r, doc_id, lang, {_hashed(_FIELDS)} AS leaf,
             CASE WHEN n_chars IS NOT NULL AND {_crc("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_hashed(_FIELDS | {"n_chars": "(n_chars + 1)"})} END AS raised
           FROM documents, crcs),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
up AS (SELECT lang, 0 AS level, i, n, leaf AS node FROM leaves
  UNION ALL SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY lang, level, i // 2, n),
langs AS (SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
high AS (SELECT 0 AS level, i, n, node FROM langs
  UNION ALL SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, i // 2, n),
way AS (SELECT r, lang, 0 AS level, i, n, coalesce(raised, leaf) AS node, '' AS seen FROM leaves
  UNION ALL SELECT r, w.lang, w.level + 1, w.i // 2, (w.n + 1) // 2, sha256(CASE w.i % 2 WHEN 1 THEN u.node || w.node ELSE w.node || coalesce(u.node, '') END), seen || coalesce(u.node, '')
    FROM way w LEFT JOIN up u ON u.lang IS NOT DISTINCT FROM w.lang AND u.level = w.level AND u.i = w.i + 1 - 2 * (w.i % 2) WHERE w.n > 1),
on_top AS (SELECT r, lang, 0 AS level, l.i, l.n, w.node, seen, l.node AS subroot FROM way w JOIN langs l USING (lang) WHERE w.n = 1 AND lang IS NOT NULL
  UNION ALL SELECT r, w.lang, 0, l.i, l.n, w.node, seen, l.node FROM way w JOIN langs l ON l.lang IS NULL AND w.lang IS NULL WHERE w.n = 1
  UNION ALL SELECT r, lang, w.level + 1, w.i // 2, (w.n + 1) // 2, sha256(CASE w.i % 2 WHEN 1 THEN u.node || w.node ELSE w.node || coalesce(u.node, '') END), seen || coalesce(u.node, ''), subroot
    FROM on_top w LEFT JOIN high u ON u.level = w.level AND u.i = w.i + 1 - 2 * (w.i % 2) WHERE w.n > 1)
SELECT l.doc_id, l.leaf, w.subroot, h.node AS root, sha256(w.seen) AS proof_sha256, w.node AS folded_root, w.node = h.node AS verified
FROM leaves l JOIN on_top w ON w.r = l.r AND w.n = 1 JOIN high h ON h.n = 1""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    out = merkle.manifest(Work(spark, "op13"), _table(spark, sf_dir, "documents"), tampered)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


_query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
