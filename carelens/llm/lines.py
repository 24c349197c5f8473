"""Line dedup that can be undone: exact reference counts of lines, and a cuckoo filter per shard in front of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import Work, whole_row

#: Lines found in so many documents go.
MIN_DOCS = 10
#: Least shards of the index, and most lines for which a shard is meant; more lines get more shards, since one task holds
#: the digests of a whole shard. A shard's filter holds the frequent lines whose digest falls to it, 5 to 10 bytes for each.
SHARDS, SHARD_LINES = 64, 1 << 19
_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SLOTS, _KICKS = 4, 200


class CuckooFilter:
    """32-bit fingerprints in two possible buckets of four slots; what no longer fits opens a further, larger table.

    Keys are pairs of 64-bit numbers. A key that was added is always found; only keys that were added may be removed.
    """

    def __init__(self, buckets: int = 64):
        self.tables = [np.zeros((buckets, _SLOTS), np.uint32)]

    @staticmethod
    def _print(b: np.ndarray) -> np.ndarray:
        return (np.asarray(b).astype(np.uint64) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

    @staticmethod
    def _hop(prints: np.ndarray) -> np.ndarray:
        return (prints.astype(np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(7)

    def _places(self, table: np.ndarray, a: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(len(table) - 1)
        first = np.asarray(a).astype(np.uint64) & mask
        return first, first ^ (self._hop(prints) & mask)

    def contains(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        prints = self._print(b)
        found = np.zeros(len(prints), bool)
        for table in self.tables:
            for place in self._places(table, a, prints):
                found |= (table[place.astype(np.int64)] == prints[:, None]).any(axis=1)
        return found

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        prints = self._print(b)
        waiting = np.arange(len(prints))
        while True:
            table = self.tables[-1]
            first, second = self._places(table, a, prints)
            waiting = np.array([i for i in waiting if not self._put(table, int(first[i]), int(second[i]), prints[i])], int)
            if not len(waiting):
                return
            size = len(table) * 2
            while size * _SLOTS < 2 * len(waiting):
                size *= 2
            self.tables.append(np.zeros((size, _SLOTS), np.uint32))

    def _put(self, table: np.ndarray, first: int, second: int, mark: np.uint32) -> bool:
        for place in (first, second):
            free = np.flatnonzero(table[place] == 0)
            if len(free):
                table[place, free[0]] = mark
                return True
        path, place = [], second
        for kick in range(_KICKS):
            slot = (int(mark) + kick) % _SLOTS
            path.append((place, slot, table[place, slot]))
            table[place, slot], mark = mark, table[place, slot]
            place ^= int(self._hop(np.array([mark]))[0]) & (len(table) - 1)
            free = np.flatnonzero(table[place] == 0)
            if len(free):
                table[place, free[0]] = mark
                return True
        for place, slot, was in reversed(path):  # nothing that was stored may be lost
            table[place, slot] = was
        return False

    def remove(self, a: np.ndarray, b: np.ndarray) -> None:
        prints = self._print(b)
        spots = [self._places(t, a, prints) for t in self.tables]
        for i, mark in enumerate(prints):
            for table, places in zip(self.tables, spots, strict=True):
                hit = next(((int(p[i]), s) for p in places for s in np.flatnonzero(table[int(p[i])] == mark)), None)
                if hit:
                    table[hit] = 0
                    break

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.tables), *map(len, self.tables)], np.int64)
        return sizes.tobytes() + b"".join(t.tobytes() for t in self.tables)

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        out = cls(1)
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, n, 8)
        out.tables, at = [], 8 * (n + 1)
        for size in sizes:
            out.tables.append(np.frombuffer(data, np.uint32, size * _SLOTS, at).reshape(size, _SLOTS).copy())
            at += int(size) * _SLOTS * 4
        return out


def key_of(line: Column) -> Column:
    """White space off both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def occurrences(docs: DataFrame) -> DataFrame:
    """A row per line of docs (doc_id, text) whose key has a code point: row key (k1, k2), line_no, digest (a, b),
    and whether it is the row's first line with that key."""
    digest = F.transform(_lines(F.col("text")), lambda x, i: F.struct(
        F.xxhash64(key_of(x)).alias("a"), F.xxhash64(F.lit(1), key_of(x)).alias("b"), i.alias("i"), (F.length(key_of(x)) > 0).alias("some")))
    ordered = F.array_sort(F.filter(digest, lambda s: s["some"]))
    rows = docs.select(*_row_key(docs), ordered.alias("s"))
    marked = F.transform("s", lambda x, j: F.struct(
        x["a"].alias("a"), x["b"].alias("b"), x["i"].alias("line_no"),
        ((j == 0) | (F.get("s", j - 1)["a"] != x["a"]) | (F.get("s", j - 1)["b"] != x["b"])).alias("first")))
    return rows.select("k1", "k2", F.explode(marked).alias("l")).select("k1", "k2", "l.*")


def _row_key(docs: DataFrame) -> list[Column]:
    """Two 64-bit digests of doc_id and text: rows that share both have the same lines and the same fate."""
    return [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(7), "doc_id", "text").alias("k2")]


def shards_for(found: DataFrame) -> int:
    """Shards for an index of these occurrences. Lines are counted once per row, which is no less than the distinct ones."""
    return max(SHARDS, -(-found.where("first").count() // SHARD_LINES))


class LineIndex:
    """Which lines are frequent, kept up to date as documents come and go.

    counts: exact reference counts, one row per line digest of 128 bits, with the shard that the digest falls to.
    filters: one cuckoo filter per shard over the lines whose count has reached min_docs. A batch asks the filters
    first and confirms what they let through against counts, so the filters cost no exactness.
    Every row of a batch is a document. insert and delete take whole documents; delete undoes insert. The number of
    shards stays as it was given; `shards_for` tells how many a batch asks for.
    """

    def __init__(self, work: Work, min_docs: int = MIN_DOCS, shards: int = SHARDS):
        self.work, self.min_docs, self.shards = work, min_docs, shards
        self.counts = work.spark.createDataFrame([], "a long, b long, shard int, n_docs long")
        self.filters = work.spark.createDataFrame([], "shard int, filter binary")

    def _changed(self, found: DataFrame, sign: int) -> None:
        shard = F.pmod(F.col("b"), F.lit(self.shards)).cast("int").alias("shard")
        delta = found.where("first").groupBy("a", "b").agg((F.count("*") * sign).alias("n"))
        both = self.counts.select("a", "b", F.col("n_docs").alias("was"), F.lit(0).cast("long").alias("n")).unionByName(
            delta.select("a", "b", F.lit(0).cast("long").alias("was"), "n")
        )
        summed = both.groupBy("a", "b").agg(F.sum("was").alias("was"), F.sum("n").alias("n"))
        summed = self.work.keep(summed.select("a", "b", shard, "was", (F.col("was") + F.col("n")).alias("n_docs")), "counts")
        up = (F.col("was") < self.min_docs) & (F.col("n_docs") >= self.min_docs)
        down = (F.col("was") >= self.min_docs) & (F.col("n_docs") < self.min_docs)
        crossed = summed.where(up | down).select("shard", "a", "b", up.alias("up"))

        def update(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            held = CuckooFilter.from_bytes(old["filter"].iloc[0]) if len(old) else CuckooFilter()
            gone, new = keys[~keys["up"].astype(bool)], keys[keys["up"].astype(bool)]
            held.remove(gone["a"].to_numpy(), gone["b"].to_numpy())
            held.add(new["a"].to_numpy(), new["b"].to_numpy())
            shard = (old if len(old) else keys)["shard"].iloc[0]
            return pd.DataFrame({"shard": [shard], "filter": [held.to_bytes()]})

        grouped = self.filters.groupBy("shard").cogroup(crossed.groupBy("shard"))
        self.filters = self.work.keep(grouped.applyInPandas(update, "shard int, filter binary"), "filters")
        self.counts = summed.where("n_docs > 0").select("a", "b", "shard", "n_docs")

    def insert(self, found: DataFrame) -> None:
        """Add documents, given as their `occurrences`."""
        self._changed(found, 1)

    def delete(self, found: DataFrame) -> None:
        """Take documents out again."""
        self._changed(found, -1)

    def frequent(self, found: DataFrame) -> DataFrame:
        """The digests (a, b) among occurrences that min_docs documents of the index have."""
        asked = found.where("first").groupBy("a", "b").agg(F.count("*").alias("n"))
        asked = asked.select("a", "b", F.pmod(F.col("b"), F.lit(self.shards)).cast("int").alias("shard"))

        def probe(held: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            if not len(held) or not len(keys):
                return keys[["a", "b"]].iloc[:0]
            hit = CuckooFilter.from_bytes(held["filter"].iloc[0]).contains(keys["a"].to_numpy(), keys["b"].to_numpy())
            return keys.loc[hit, ["a", "b"]]

        maybe = self.filters.groupBy("shard").cogroup(asked.groupBy("shard")).applyInPandas(probe, "a long, b long")
        return maybe.join(self.counts.where(F.col("n_docs") >= self.min_docs).select("a", "b"), ["a", "b"])


def strip(docs: DataFrame, found: DataFrame, frequent: DataFrame) -> DataFrame:
    """docs with n_lines, n_dropped and kept, the text without its frequent lines, in a struct beside the row.

    Columns: doc (all columns of docs), n_lines, n_dropped, kept.
    """
    drops = found.join(frequent, ["a", "b"]).groupBy("k1", "k2").agg(F.collect_set("line_no").alias("drops"))
    rows = docs.select(*_row_key(docs), whole_row(docs).alias("doc")).join(drops, ["k1", "k2"], "left")
    rows = rows.withColumn("lines", _lines(F.col("doc.text"))).withColumn("n_lines", F.size("lines").cast("long"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    kept = F.when(F.col("drops").isNull(), F.coalesce(F.col("doc.text"), F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    )
    return rows.select("doc", "n_lines", F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


def line_dedup(work: Work, docs: DataFrame, min_docs: int = MIN_DOCS, shards: int | None = None) -> DataFrame:
    """`strip` of docs against an index that holds just docs.

    Null or empty text: one empty line, which stays. Repeated rows count as documents of their own and are treated
    alike. Null doc_id: a document like any other. A text whose lines all go is left empty. No rows: no rows.
    """
    found = work.keep(occurrences(docs), "lines")
    index = LineIndex(work, min_docs, shards or shards_for(found))
    index.insert(found)
    frequent = work.keep(index.frequent(found), "frequent")
    return strip(docs, found, frequent)
