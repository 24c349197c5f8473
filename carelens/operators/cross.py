"""Checks across tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.functions.dates import lowest_day, or_lowest
from carelens.functions.formats import age_days
from carelens.sources.tables import Tables, union_all


def not_in_reference(df: DataFrame, reference: DataFrame, on: dict[str, str]) -> DataFrame:
    """Distinct keys of `df`, the first one filled, that `reference` lacks.

    Both sides shrink to distinct keys before they meet, so no key is hot in the join. Beyond the
    first key a missing value matches a missing value.
    """
    first = next(iter(on))
    ours = df.where(F.col(first).isNotNull()).select(*on).distinct()
    theirs = reference.select(*[F.col(c).alias(f"r_{c}") for c in on.values()]).distinct()
    cond = ours[first] == theirs[f"r_{on[first]}"]
    for a, b in list(on.items())[1:]:
        cond = cond & ours[a].eqNullSafe(theirs[f"r_{b}"])
    return ours.join(theirs, cond, "left_anti")


def rows_not_in_reference(df: DataFrame, reference: DataFrame, column: str, ref_column: str) -> DataFrame:
    """Rows whose filled id the reference lacks; a null id passes.

    The reference shrinks to distinct ids. The null-safe equality gives the join a shuffle of its
    own after that: AQE splits a hot id only where both sides come straight from a shuffle.
    """
    ids = reference.where(F.col(ref_column).isNotNull()).select(F.col(ref_column).alias("ref_id")).distinct()
    same = F.col(column).eqNullSafe(F.col("ref_id"))
    return df.where(F.col(column).isNotNull()).join(ids, same, "left_anti")


def id_file_status(df: DataFrame, id_file: DataFrame, keys: list[str]) -> DataFrame:
    """Ids only in the table (E) and ids only in the id file (N), their first key filled.

    Both sides are counted together, so equal ids, nulls included, meet in one aggregate.
    """

    def side(ids: DataFrame, here: bool) -> DataFrame:
        known = ids.where(F.col(keys[0]).isNotNull())
        return known.select(*keys, F.lit(here).alias("in_table"), F.lit(not here).alias("in_file"))

    both = side(df, True).unionByName(side(id_file, False)).groupBy(*keys).agg(
        F.max("in_table").alias("in_table"), F.max("in_file").alias("in_file")
    )
    status = F.when(F.col("in_table"), "E").otherwise("N")
    return both.where("in_table <> in_file").select(*keys, status.alias("idfilestatus"))


def declared_length_mismatch(
    contents1: DataFrame, contents2: DataFrame, var1: str, var2: str
) -> DataFrame:
    """Length of a column in one contents table against a column of another."""
    def side(c: DataFrame, var: str, n: int) -> DataFrame:
        other = 3 - n
        return c.where(F.upper("name") == var.upper()).select(
            F.col("tabid").alias(f"table{n}"),
            F.col("length").alias(f"length{n}"),
            F.lit(None).cast("string").alias(f"table{other}"),
            F.lit(None).cast("int").alias(f"length{other}"),
        )

    columns = ["table1", "table2", "length1", "length2"]
    both = side(contents1, var1, 1).unionByName(side(contents2, var2, 2))
    return (
        both.agg(*[F.max(c).alias(c) for c in columns])
        .where("length1 <> length2")
        .select(F.lit(var1).alias("variable1"), F.lit(var2).alias("variable2"), *columns)
    )


def compliance_lengths(comp: DataFrame, pairs: DataFrame) -> DataFrame:
    """Length of each (table1, table2, variable) pair, from the compliance table."""
    lengths = comp.select(
        F.lower("tabid").alias("t"), F.lower("var").alias("v"), F.col("dp_length").alias("len")
    )

    def side(n: int) -> tuple[DataFrame, Column]:
        s = lengths.select(*[F.col(c).alias(f"{c}{n}") for c in ("t", "v", "len")])
        return s, (F.lower(f"table{n}") == F.col(f"t{n}")) & (F.lower("variable") == F.col(f"v{n}"))

    one, on1 = side(1)
    two, on2 = side(2)
    return pairs.join(one, on1, "left").join(two, on2, "left").select(
        "table1", "table2", "variable", F.col("len1").alias("varlength1"), F.col("len2").alias("varlength2")
    )


def length_mismatch(lengths: DataFrame) -> DataFrame:
    """Pairs whose lengths differ; a length on one side only differs too."""
    return lengths.where(~F.col("varlength1").eqNullSafe(F.col("varlength2")))


def value_lengths(tables: Tables, variable: str) -> DataFrame:
    """Filled values by their length, per table."""
    return union_all(
        [
            df.where(F.col(variable).isNotNull())
            .groupBy(F.length(F.rtrim(F.col(variable))).alias("valuelength"))
            .agg(F.count("*").alias("count"))
            .select(F.lit(n.upper()).alias("tabid"), F.lit(variable).alias("variable"), "*")
            for n, df in tables.items()
        ]
    )


def _observed(table: str, variable: str) -> Column:
    return (F.col("tabid") == table.upper()) & (F.col("variable") == variable)


def value_length_differences(lengths: DataFrame, pairs: list[tuple[str, str]], variable: str) -> DataFrame:
    """Observed lengths that only one table of a pair has: the other side is null; and how many values have them.

    Compares the histograms that `value_lengths` gives, all pairs of tables in one aggregate with a row per length, so a
    pair has no more rows than there are lengths.
    """
    here = lengths.where(F.col("variable") == variable).groupBy("valuelength")
    counts = here.agg(F.map_from_entries(F.collect_list(F.struct("tabid", "count"))).alias("counts"))  # a table each
    each = F.array(*[F.struct(F.lit(a.upper()).alias("table1"), F.lit(b.upper()).alias("table2")) for a, b in pairs])
    both = counts.select("valuelength", "counts", F.explode(each).alias("pair")).select(
        "pair.*", "valuelength", *[F.try_element_at("counts", F.col(f"pair.table{n}")).alias(f"count{n}") for n in (1, 2)]
    )
    sides = [F.when(F.col(f"count{n}").isNotNull(), F.col("valuelength")).alias(f"length{n}") for n in (1, 2)]
    alone = F.col("count1").isNull() != F.col("count2").isNull()
    return both.where(alone).select("table1", "table2", F.lit(variable).alias("variable"), *sides, "count1", "count2")


def value_length_mismatch(lengths: DataFrame, table1: str, table2: str, variable: str) -> DataFrame:
    """Every pair of unequal observed lengths of two tables, for parity; `value_length_differences` tells which differ.

    As many rows as the product of both numbers of lengths, of which there are at most as many as the longest id has
    characters; a table without values has one missing length.
    """
    sets = lengths.agg(*[F.collect_set(F.when(_observed(t, variable), F.col("valuelength"))).alias(f"s{n}") for n, t in ((1, table1), (2, table2))])
    pairs = sets.select(F.explode_outer("s1").alias("length1"), "s2").select("length1", F.explode_outer("s2").alias("length2"))
    return pairs.where(~F.col("length1").eqNullSafe(F.col("length2"))).select(
        F.lit(table1.upper()).alias("table1"), F.lit(table2.upper()).alias("table2"), F.lit(variable).alias("variable"), "length1", "length2"
    )


def attribute_mismatch(
    df: DataFrame, other: DataFrame, on: tuple[str, str], columns: tuple[str, str],
    recode: Column | None = None,
) -> DataFrame:
    """Distinct filled values of a column that differ from the other table's under the same key.

    `other` shrinks to the smallest and largest value (and whether one is missing) per key: a value
    differs from some value there exactly if it differs from one of the two. Missing keys match.
    """
    theirs = F.col(columns[1]) if recode is None else recode
    bounds = other.groupBy(F.col(on[1]).alias("o_key")).agg(
        F.min(theirs).alias("o_min"),
        F.max(theirs).alias("o_max"),
        F.max(theirs.isNull()).alias("o_null"),
    )
    ours = df.where(F.col(columns[0]).isNotNull()).select(
        F.col(on[0]).alias("key"), F.col(columns[0]).alias("value")
    ).distinct()
    differs = (F.col("value") != F.col("o_min")) | (F.col("value") != F.col("o_max")) | F.col("o_null")
    return (
        ours.join(bounds, F.col("key").eqNullSafe(F.col("o_key")))
        .where(differs)
        .select(F.lit(columns[0]).alias("variable"), "value")
        .distinct()
    )


def date_order_pairs(
    one: DataFrame, two: DataFrame, date1: str, date2: str, later: bool, drop_null2: bool = True,
    key: str = "patid",
) -> DataFrame:
    """Per patient: pairs of rows whose date in the first table is later (or earlier).

    A table without the patient counts as one row with a missing date, which is below all dates.
    Pairs are counted through running sums over a patient's days, not formed.
    """
    long0, long1 = F.lit(0).cast("long"), F.lit(1).cast("long")
    a = one.where(F.col(date1).isNotNull()).select(
        F.col(key), F.col(date1).alias("day"), long1.alias("n1"), long0.alias("n2")
    )
    b = two.where(F.col(date2).isNotNull()) if drop_null2 else two
    b = b.select(F.col(key), or_lowest(F.col(date2)).alias("day"), long0.alias("n1"), long1.alias("n2"))
    daily = a.unionByName(b).groupBy(key, "day").agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2"))
    before = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    counted, below = ("n1", "n2") if later else ("n2", "n1")
    pairs = F.col(counted) * F.coalesce(F.sum(below).over(before), F.lit(0))
    by_key = daily.withColumn("pairs", pairs).groupBy(key).agg(
        F.sum("pairs").alias("pairs"),
        # against a table without the patient, every row with a date is higher
        F.sum(F.when(F.col("day") > lowest_day(), F.col(counted))).alias("dated"),
        F.sum(below).alias("below"),
    )
    n = F.when(F.col("below") == 0, F.col("dated")).otherwise(F.col("pairs"))
    return by_key.select(key, n.cast("long").alias("n_pairs")).where("n_pairs > 0")


def presence_matrix(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct filled ids counted by the pattern of tables that have them ('1' or '0' each)."""
    flags = list(tables)
    marked = union_all(
        [
            df.where(F.col(column).isNotNull()).select(
                F.col(column).alias("id"), *[F.lit(1 if t == name else 0).alias(t) for t in flags]
            )
            for name, (df, column) in tables.items()
        ]
    )
    per_id = marked.groupBy("id").agg(*[F.max(t).alias(t) for t in flags])
    return per_id.groupBy(*[F.col(t).cast("string").alias(t) for t in flags]).agg(
        F.count("*").alias("count")
    )


def value_matrix(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per filled value and table, side by side; 0 where a table lacks the value."""
    return union_all(
        [
            df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("value"))
            .agg(F.count("*").alias("n"))
            .select("value", *[(F.col("n") if t == name else F.lit(0).cast("long")).alias(t) for t in tables])
            for name, (df, column) in tables.items()
        ]
    ).groupBy("value").agg(*[F.sum(t).alias(t) for t in tables])


def _pair_counts(matrix: DataFrame, counts: dict[tuple[str, str], Column]) -> DataFrame:
    """One row per (table1, table2) from one aggregate over the matrix."""
    named = {pair: f"c{i}" for i, pair in enumerate(counts)}
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("table1"), F.lit(b).alias("table2"), F.col(c).alias("count"))
            for (a, b), c in named.items()
        ]
    )
    return matrix.agg(*[counts[p].alias(c) for p, c in named.items()]).select(F.inline(rows))


def pattern_counts(matrix: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Ids that the first table of a pair has and the second has not, from the presence matrix."""

    def ids(a: str, b: str) -> Column:
        hit = (F.col(a) == "1") & (F.col(b) == "0")
        return F.coalesce(F.sum(F.when(hit, F.col("count"))), F.lit(0))

    return _pair_counts(matrix, {(a, b): ids(a, b) for a, b in pairs})


def value_pattern_counts(matrix: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Values that rows of the first table have and rows of the second have not."""
    return _pair_counts(
        matrix, {(a, b): F.count_if((F.col(a) > 0) & (F.col(b) == 0)) for a, b in pairs}
    )


def days_to_enrollment(mil: DataFrame) -> DataFrame:
    """Infants by birth year and bucketed days from birth to first enrollment."""
    days = F.datediff("cenr_start", "cbirth_date")
    return (
        mil.where("cpatid is not null")
        .groupBy(F.year("cbirth_date").alias("year_cbirth_date"), age_days(days).alias("agedays_group"))
        .agg(F.countDistinct("cpatid").alias("count"))
    )
