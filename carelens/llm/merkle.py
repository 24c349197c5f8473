"""A Merkle tree over the rows of a dataset: leaves per group, subroots, one root, and a proof for every row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import Work
from carelens.llm.order import numbered

#: The fields of a leaf, in order, and the one that tampering raises by 1.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_FIELD = "n_chars"
#: A window sees 2**BITS nodes of a level at most and climbs that many levels.
BITS = 10


def _field(value: Column) -> Column:
    body = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(body).cast("string"), F.lit(":"), body), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    """The hash of a row: every field is `-` or its UTF-8 byte count, a colon and its value, so no two rows run together."""
    return F.sha2(F.concat(*map(_field, fields.values())), 256)


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """Rows (doc_id, lang, leaf, shown): shown is the leaf of the row as it is after tampering where `tampered` holds."""
    fields = {c: F.col(c) for c in FIELDS}
    raised = fields | {TAMPERED_FIELD: (F.col(TAMPERED_FIELD).cast("decimal(20,0)") + 1).cast("decimal(21,0)")}
    touched = F.coalesce(tampered, F.lit(False)) & F.col(TAMPERED_FIELD).isNotNull()
    return docs.select("doc_id", "lang", leaf(fields).alias("leaf"), F.when(touched, leaf(raised)).alias("shown")).withColumn(
        "shown", F.coalesce("shown", "leaf")
    )


def _climb(rows: DataFrame, group: list[str], bits: int) -> DataFrame:
    """rows (*group, place, n, node, ...) with `block`, `top`, the block's node after `bits` levels, and `steps`,
    the siblings on every row's way there.

    The node of a run of 2**l rows stands at the run's first row. The other node of its parent's run is then exactly
    2**l rows away: a lag where its slot is 1, a lead where it is 0, and none where the run of nodes is shorter. First
    children hash the parent. A level is there only while its group has several nodes.
    """
    rows = rows.withColumn("block", F.shiftright("place", bits))
    block = Window.partitionBy(*group, "block").orderBy("place")
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place, n, node = F.col("place"), F.col("n"), F.col("node")
    columns = rows.columns
    for level in range(bits):
        width = 1 << level
        first, later = place % width == 0, F.shiftright(place, level) % 2 == 1
        several, full = n > width, place + width < n
        sibling = F.when(later, F.lag(node, width).over(block)).when(full, F.lead(node, width).over(block)).otherwise("")
        rows = rows.withColumn(f"_sibling{level}", F.when(first & several, sibling))
        parent = F.when(several, F.sha2(F.concat(node, F.col(f"_sibling{level}")), 256)).otherwise(node)
        rows = rows.withColumn(f"_node{level + 1}", F.when(place % (2 * width) == 0, parent))
        node = F.col(f"_node{level + 1}")
    steps = []
    for level in range(bits):  # every row takes over what its run's first row has found
        sibling = F.last(f"_sibling{level}", ignorenulls=True).over(so_far)
        later = F.shiftright(place, level) % 2 == 1
        steps.append(F.struct(F.when(later, sibling).otherwise("").alias("before"), F.when(later, "").otherwise(sibling).alias("after")))
    height = reduce(Column.__add__, [(n > (1 << level)).cast("int") for level in range(bits)])
    return rows.select(*columns, F.first(node).over(so_far).alias("top"), F.slice(F.array(*steps), F.lit(1), height).alias("steps"))


def proofs(work: Work, rows: DataFrame, bits: int = BITS) -> DataFrame:
    """rows (doc_id, lang, leaf, shown) with `place` and `n` in their lang, `steps`, the siblings from the leaf over the
    subroot to the root, `subroot` and `root`.

    Per lang, rows ascend by doc_id (null first), rows that repeat a doc_id by leaf. A level's runs are of two nodes, the
    last one may be of one. Subroots ascend by lang, null first. Windows see blocks of 2**bits nodes; the nodes of the
    blocks are the next rows to climb, so every pass leaves a 2**bits-th of the rows, however many a lang has. No rows:
    no rows.
    """
    lang = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("+"), "lang"))  # sorts as lang does, null first
    now = numbered(work, rows.withColumns({"_lang": lang, "node": F.col("leaf")}), ["_lang"], ["doc_id", "leaf"], "leaves")
    group, passes = ["_lang"], []
    while True:
        most = now.agg(F.max("n")).first()[0] or 1
        levels = min(bits, max(1, (most - 1).bit_length()))  # no more than the largest group has
        size = 1 << levels
        climbed = _climb(now, group, levels)
        passes.append(climbed)
        heads = climbed.where(F.col("place") % size == 0)
        if most > size:
            after = F.shiftright(F.col("n") + (size - 1), levels).alias("n")
            now = work.keep(heads.select(*group, F.col("block").alias("place"), after, F.col("top").alias("node")), "blocks")
        elif group:
            of_langs = len(passes)
            now = numbered(work, work.keep(heads.select("_lang", F.col("top").alias("node")), "subroots"), [], ["_lang"], "langs")
            group = []
        else:
            break
    found = passes.pop().withColumn("root", F.col("top"))
    while passes:
        climbed = passes.pop()
        if len(passes) + 1 > of_langs:  # blocks of langs
            key, above = ["block"], found.select(F.col("place").alias("block"), F.col("steps").alias("more"), "root")
        elif len(passes) + 1 == of_langs:  # a lang's last block, whose node is its subroot
            key, above = ["_lang"], found.select("_lang", F.col("steps").alias("more"), "root")
            climbed = climbed.withColumn("subroot", F.col("top"))
        else:
            key, above = ["_lang", "block"], found.select("_lang", F.col("place").alias("block"), F.col("steps").alias("more"), "root", "subroot")
        found = climbed.join(above, key).withColumn("steps", F.concat("steps", "more")).drop("more")
    return found.select(*rows.columns, "place", "n", "steps", "subroot", "root")


def proof_hash(steps: Column) -> Column:
    """The hash of all siblings in a row's steps."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def manifest(work: Work, docs: DataFrame, tampered: Column, bits: int = BITS) -> DataFrame:
    """Per row of docs: doc_id, lang, leaf, place and n within its lang, steps, subroot, root, proof_sha256, folded_root,
    and verified, whether the row as it is after tampering still folds to the root.

    `tampered`, a condition on docs (null: no), tells the rows whose n_chars is shown 1 higher than it was hashed; rows
    without n_chars stay as they are. Null fields hash as `-`, empty texts as `0:`. Rows that are equal in all fields are
    leaves of their own. Other columns of docs take no part, whatever their names. No rows: no rows.
    """
    found = proofs(work, leaves(docs, tampered), bits)
    found = found.withColumns({"proof_sha256": proof_hash(F.col("steps")), "folded_root": folded(F.col("shown"), F.col("steps"))})
    return found.drop("shown").withColumn("verified", F.col("folded_root") == F.col("root"))
