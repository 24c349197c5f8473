"""Sorted runs of strings with known common prefixes: front coding, and merging by a loser tree.

A run is a list of byte strings in order, with the length of the common prefix that each shares with the one before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np


#: Bytes that one part of a packed run holds.
PART_BYTES = 1 << 18


def common_prefix(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, of which `start` bytes are known."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    step = 16
    while a[start : start + step] == b[start : start + step]:
        start += step
        step *= 2
    low, high = start, min(start + step, end)  # they differ before high
    while high - low > 8:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    while a[low] == b[low]:
        low += 1
    return low


def prefixes(run: list[bytes]) -> list[int]:
    return [0, *(common_prefix(a, b, 0) for a, b in zip(run, run[1:], strict=False))][: len(run)]


def _packed(entries: list[tuple[int, int, bytes]]) -> bytes:
    number = np.array([e[0] for e in entries], np.int64)
    shared = np.array([e[1] for e in entries], np.int32)
    tails = [e[2][e[1] :] for e in entries]
    length = np.array([len(t) for t in tails], np.int32)
    body = zlib.compress(np.int64(len(entries)).tobytes() + number.tobytes() + shared.tobytes() + length.tobytes() + b"".join(tails), 1)
    return len(body).to_bytes(8, "little") + body


def encode(entries: list[tuple[int, int, bytes]]) -> bytes:
    """Front coding of a run: (number, shared bytes, string) becomes the shared length and the rest of the string. A run is
    packed in parts of about PART_BYTES, so that reading it holds one of them."""
    out, start, size = [], 0, 0
    for i, (_, shared, string) in enumerate(entries):
        size += len(string) - shared + 16
        if size >= PART_BYTES:
            out.append(_packed(entries[start : i + 1]))
            start, size = i + 1, 0
    if start < len(entries):
        out.append(_packed(entries[start:]))
    return b"".join(out)


def decode(block: bytes) -> Iterator[tuple[int, int, bytes]]:
    here, last = 0, b""
    while here < len(block):
        size = int.from_bytes(block[here : here + 8], "little")
        body = zlib.decompress(block[here + 8 : here + 8 + size])
        here += 8 + size
        n = int(np.frombuffer(body, np.int64, 1)[0])
        number = np.frombuffer(body, np.int64, n, 8).tolist()
        shared = np.frombuffer(body, np.int32, n, 8 + 8 * n).tolist()
        length = np.frombuffer(body, np.int32, n, 8 + 12 * n).tolist()
        at = 8 + 16 * n
        for k, s, m in zip(number, shared, length, strict=True):
            last = last[:s] + body[at : at + m]
            at += m
            yield k, s, last


def merge(runs: list[Iterator[tuple[int, int, bytes]]]) -> Iterator[tuple[int, int, int, bytes]]:
    """All strings of the runs in order: (run, number, bytes shared with the string before, string).

    A loser tree of the runs' current strings. Each loser keeps how many bytes it shares with the string that beat it.
    When the next string of a run climbs, every length on its way is relative to the string last put out. The one that
    shares more is the smaller, without a look at either; only with equal lengths are bytes compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    # Current string of a run, None when it is over; bytes it shares with the string last put out.
    current: list[bytes | None] = []
    number, shared = [0] * k, [0] * k
    for i in range(k):
        first = next(runs[i], None) if i < len(runs) else None
        number[i] = first[0] if first else 0
        current.append(first[2] if first else None)

    def beats(a: int, b: int) -> tuple[int, int, int]:
        """Winner, loser, and the bytes these two share, given what each shares with the string last put out."""
        x, y = current[a], current[b]
        if y is None:
            return a, b, 0
        if x is None:
            return b, a, 0
        if shared[a] != shared[b]:
            return (a, b, shared[b]) if shared[a] > shared[b] else (b, a, shared[a])
        same = common_prefix(x, y, shared[a])
        if same == len(x) or (same < len(y) and x[same] < y[same]):
            return a, b, same
        return b, a, same

    losers = [0] * k
    # Play the first round from the leaves up.
    winners = list(range(k))
    base = k
    node_winner = [0] * (2 * k)
    node_winner[k:] = winners
    for node in range(base - 1, 0, -1):
        win, lose, same = beats(node_winner[2 * node], node_winner[2 * node + 1])
        node_winner[node], losers[node] = win, lose
        shared[lose] = same
    top = node_winner[1] if k > 1 else 0
    out_shared = 0
    while current[top] is not None:
        yield top, number[top], out_shared, current[top]
        follow = next(runs[top], None)
        if follow is None:
            current[top], shared[top] = None, 0
        else:
            number[top], shared[top], current[top] = follow
        node = (top + k) // 2
        while node:
            win, lose, same = beats(top, losers[node])
            if current[lose] is not None:
                shared[lose] = same
            top, losers[node] = win, lose
            node //= 2
        out_shared = shared[top]
