"""The prefix trie of conversations: every distinct start of one is a node, with totals of what lies below it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import Work, split_join
from carelens.llm.mixing import word_count
from carelens.llm.order import numbered

#: Depths of a band: a node reaches no more ancestors at once, and the rounds are its logarithm of the greatest depth.
HEIGHT = 16
#: Turns of one conversation that a window sees at once.
STRETCH = 1 << 12
#: Bytes of decimal ids that one row carries to the hash of a node's ends.
ID_BYTES = 1 << 20


def turns(work: Work, conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, place, n, digest, words): place from 0 by turn (null first), turns that tie by digest; n turns a
    conversation; digest, 128 bits of role and text, null being empty; words of the text. Rows without a conv_id are of
    no conversation. Other columns take no part."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", digest.alias("digest"), word_count(text).alias("words"))
    out = numbered(work, work.keep(rows, "turns"), ["conv_id"], ["turn", "digest"], "ordered")
    return work.keep(out.select("conv_id", "place", "n", "digest", "words"), "placed")


def conversations_of(turns: DataFrame) -> DataFrame:
    """Conversations (conv_id, n)."""
    return turns.where("place = 0").select("conv_id", "n")


def share_starts(work: Work, turns: DataFrame, every: int = 20) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations after each conversation c got the start of c - c % every.

    c begins with the first h turns of that one (all if it has fewer, none if it is absent), h being the CRC-32 of c's
    decimal digits modulo 4, and goes on with its own turns after its first h, if any; it may be left without a turn.
    """
    id_ = F.col("conv_id")
    base = id_ - id_ % every
    wanted = F.when(id_ % every == 0, 0).otherwise(F.crc32(id_.cast("string")) % 4)
    found = conversations_of(turns).select("conv_id", F.col("n").alias("own"), base.alias("base"), wanted.alias("h"))
    given = found.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    found = found.join(given, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    found = work.keep(found.withColumn("n", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "rebuilt")
    starts = turns.where((id_ % every == 0) & (F.col("place") < 3)).select(F.col("conv_id").alias("base"), "place", "digest", "words")
    starts = found.where("taken > 0").select("conv_id", "base", "taken", "n").join(starts, "base").where("place < taken")
    own = split_join(turns.drop("n"), found.where("own > h").select("conv_id", "h", "taken", "n"), ["conv_id"]).where("place >= h")
    own = own.withColumn("place", F.col("place") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "place", "n", "digest", "words"]
    return own.select(columns).unionByName(starts.select(columns)), found.select("conv_id", "n")


def starts_of(work: Work, turns: DataFrame) -> DataFrame:
    """turns with depth, from 1, and a, b, which are equal for equal sequences of turns up to there.

    Both are exclusive ors of hashes of (depth, turn), so a long conversation is cut into stretches, of which each gets
    what the earlier ones come to; a window sees one stretch, or a row per stretch of a conversation.
    """
    depth = F.col("place") + 1
    rows = turns.select(
        "conv_id", depth.alias("depth"), "n", "words", F.xxhash64(depth, "digest").alias("a"), F.xxhash64(F.lit(1), "digest", depth).alias("b")
    ).withColumn("stretch", F.floor((F.col("depth") - 1) / STRETCH).cast("long"))
    inside = Window.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = work.keep(rows.withColumns({x: F.bit_xor(x).over(inside) for x in "ab"}), "starts")
    long = rows.where(F.col("n") > STRETCH)
    ends = long.groupBy("conv_id", "stretch").agg(F.max_by("a", "depth").alias("a"), F.max_by("b", "depth").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("conv_id", "stretch", *[F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)).alias(f"{x}0") for x in "ab"])
    long = long.join(carried, ["conv_id", "stretch"]).withColumns({x: F.col(x).bitwiseXOR(F.col(f"{x}0")) for x in "ab"})
    return rows.where(F.col("n") <= STRETCH).unionByName(long.select(rows.columns)).drop("stretch")


def paths(work: Work, turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every conversation's way from the root: conv_id, depth, n, node, the smallest member of the node there, which with
    the depth names it; where that is the conversation itself, also n_convs, leaves (1 if the node has no child) and
    saved (n_convs - 1 times the words of the node's last text)."""
    rows = starts_of(work, turns)
    found = rows.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.count_if(F.col("depth") == F.col("n")).alias("ends"), F.max("words").alias("words")
    )
    out = split_join(rows.drop("words"), work.keep(found, "nodes"), ["depth", "a", "b"]).drop("a", "b")
    first, n_convs, ends = conversations.agg(F.min("conv_id"), F.count("*"), F.count_if(F.col("n") == 0)).first()
    root = {"depth": 0, "node": first, "n_convs": n_convs, "ends": ends, "words": 0}
    root = conversations.withColumns({k: F.lit(v).cast("long") for k, v in root.items()})
    own = F.col("node") == F.col("conv_id")
    saved = (F.col("n_convs") - 1) * F.col("words")
    return work.keep(
        out.select(F.col("depth").cast("long").alias("depth"), *[c for c in out.columns if c != "depth"]).unionByName(root).select(
            "conv_id", "depth", "n", "node", F.when(own, F.col("n_convs")).alias("n_convs"),
            F.when(own & (F.col("n_convs") == F.col("ends")), 1).otherwise(0).cast("long").alias("leaves"),
            F.when(own, saved).otherwise(0).alias("saved"),
        ),
        "paths",
    )


def roll_up(work: Work, ways: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Per node (node, depth): leaves and saved, summed over the node and all below it, n_children and parent.

    ways (conv_id, depth, node, leaves, saved) are conversations' ways; leaves and saved stand where a node is its
    conversation's own. Depths are cut into bands. A conversation's own nodes are summed from below within a band, which
    gives what each ancestor in that band gets from them, one row per ancestor. What a band's topmost nodes come to is
    rolled up in the same way, their depths divided by the height; what that gives for the topmost node of the next band
    goes to the nodes above it in this band. So the rounds are a logarithm of the greatest depth, and in each a row meets
    no more than a band. Nodes of very many members are combined before the shuffle.
    """
    band = F.floor(F.col("depth") / height).cast("long")
    own = F.col("node") == F.col("conv_id")
    deepest = ways.agg(F.max("depth")).first()[0] or 0
    next_ = ways.where((F.col("depth") % height == 0) & (F.col("depth") > 0))  # the next band's top, seen from this one
    next_ = next_.withColumns({"leaves": F.lit(0).cast("long"), "saved": F.lit(0).cast("long"), "band": band - 1})
    rows = ways.withColumn("band", band).unionByName(next_).select("conv_id", "band", "depth", "node", "leaves", "saved", own.cast("long").alias("own"))
    below = Window.partitionBy("conv_id", "band").orderBy(F.desc("depth"))
    up_to = below.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(
        "conv_id", "band", "depth", "node", F.sum("leaves").over(up_to).alias("leaves"), F.sum("saved").over(up_to).alias("saved"),
        F.coalesce(F.lag("own").over(below), F.lit(0)).alias("n_children"), F.when(F.col("own") == 1, F.lead("node").over(below)).alias("parent"),
    )
    if deepest >= height:
        rows = work.keep(rows, "bands")
        tops = rows.where((F.col("depth") % height == 0) & (F.floor(F.col("depth") / height) == F.col("band")))
        sums = tops.groupBy("node", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        sums = sums.select(F.col("node").alias("conv_id"), "depth", "leaves", "saved")
        higher = tops.select("conv_id", "depth", "node").join(sums, ["conv_id", "depth"], "left")
        nothing = F.lit(0).cast("long")
        higher = higher.select("conv_id", band.alias("depth"), "node", F.coalesce("leaves", nothing).alias("leaves"), F.coalesce("saved", nothing).alias("saved"))
        totals = roll_up(work, work.keep(higher, "tops"), height)
        given = totals.select(F.col("node").alias("conv_id"), (F.col("depth") - 1).alias("band"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        rows = rows.join(given, ["conv_id", "band"], "left")
        # the next band's top itself has its total in its own band
        mine = F.floor(F.col("depth") / height) == F.col("band")
        rows = rows.withColumns({x: F.when(mine, F.col(x) + F.coalesce(y, nothing)).otherwise(nothing) for x, y in (("leaves", "l"), ("saved", "s"))})
    return rows.groupBy("node", "depth").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.sum("n_children").alias("n_children"), F.max("parent").alias("parent")
    )


def hash_ends(ways: DataFrame) -> DataFrame:
    """Nodes (node, depth) at which conversations end, with sha256, the hash of their decimal ids, ascending, with commas.

    Ids are joined where a range sort has put them, a megabyte a row at most, so that the one task that must hash a node's
    ids one after the other reads few rows and holds one of them.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, depth, ids = (batch.column(i).to_numpy() for i in range(3))
            if not len(ids):
                continue
            at = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (depth[1:] != depth[:-1])]))
            at = np.unique(np.concatenate([at, np.arange(0, len(ids), ID_BYTES // 24)]))  # an id has 20 characters at most
            text = list(map(str, ids.tolist()))
            parts = [",".join(text[i:j]) for i, j in zip(at, [*at[1:], len(ids)], strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array(x[at]) for x in (node, depth, ids)), pa.array(parts)], names=["node", "depth", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for key, ids in zip(zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True), batch.column(3), strict=True):
                if key != now:
                    if state:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*done, strict=True), kinds, strict=True)] if done else [pa.array([], t) for t in kinds], names=names)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*now, state.hexdigest()), kinds, strict=True)], names=names)

    names, kinds = ["node", "depth", "sha256"], [pa.int64(), pa.int64(), pa.string()]
    keys = ["node", "depth", "conv_id"]
    ends = ways.where("depth = n").select(keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    parts = ends.mapInArrow(joined, "node long, depth long, first long, ids string")
    return parts.repartition("node", "depth").sortWithinPartitions("node", "depth", "first").mapInArrow(hashed, "node long, depth long, sha256 string")


def trie(work: Work, turns: DataFrame, conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The nodes of the trie of all conversations, from the textless root: conv_id, the smallest member, depth,
    parent_conv_id (root: null), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns (conv_id, place, n, digest, words) come from `turns` or `share_starts`, conversations (conv_id, n) may have some
    without a turn, which are members of the root alone. A conversation or a start that a third of all rows have is cut
    or combined in every step. No conversations: no nodes, not even a root.
    """
    ways = paths(work, turns, conversations)
    totals = work.keep(roll_up(work, ways.select("conv_id", "depth", "node", "leaves", "saved"), height), "totals")
    members = ways.where("node = conv_id").select("node", "depth", "n_convs")
    out = members.join(totals, ["node", "depth"]).join(work.keep(hash_ends(ways), "ends"), ["node", "depth"], "left")
    return out.select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
