"""Metadata consistency, comparison of result tables and of two loads."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.sources import work

# Fields that must agree, and the one that is only reported.
STRICT = ["flagid", "flag_descr", "flag_type", "abort_yn"]
INFORMATIONAL = ["message"]
HOUR = 3600  # fixed value: a shift of exactly one hour is a clock change

# Fixed values in the functions below: test groups, grades, sources and result texts of the published consistency report.


def unsplit(name: Column) -> Column:
    """Table name in lower case without the number of a split table."""
    return F.lower(F.regexp_replace(F.trim(name), r"\d+$", ""))


def table_names(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Grade each expected (variable, value) table name by whether such a table is present."""
    want = expected.select(F.col("variable").alias("table"), F.lower("value").alias("expected"))
    have = actual.select(unsplit(F.col("memname")).alias("actual")).distinct()
    both = want.join(have, F.col("expected") == F.col("actual"), "left")
    found = F.col("actual").isNotNull()
    ok = F.concat(F.lit("Expected and actual names match for "), "table", F.lit(": "), "actual", F.lit("."))
    bad = F.concat(F.lit("Expected name for "), "table", F.lit(" is "), "expected", F.lit(" but  was found."))
    return both.select(
        F.lit("SCDM TABLE NAMES").alias("test_group"),
        F.when(found, "PASS").otherwise("FAIL").alias("grade"),
        F.lit("Check if SCDM table names match between QA results and actual tables").alias("details"),
        F.when(found, ok).otherwise(bad).alias("results"),
    )


def _sides(a: DataFrame, b: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """Both tables side by side: attributes a_x and b_x, and which side has the key."""
    def named(df: DataFrame, side: str) -> DataFrame:
        cols = [F.col(c).alias(f"{side}_{c}") for c in attributes]
        return df.select(*keys, *cols, F.lit(1).alias(f"in_{side}"))

    source = (
        F.when(F.col("in_a").isNotNull() & F.col("in_b").isNotNull(), "SCDM and QA")
        .when(F.col("in_a").isNotNull(), "SCDM Only")
        .otherwise("QA Only")
    )
    return named(a, "a").join(named(b, "b"), keys, "full_outer").withColumn("sources", source)


def _attribute(name: str, differs: Column) -> Column:
    return F.when(
        differs,
        F.struct(
            F.lit(name).alias("variable"),
            F.col(f"a_{name}").cast("string").alias("scdm_value"),
            F.col(f"b_{name}").cast("string").alias("qa_value"),
        ),
    )


def header_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Tables of one side only, and differing type, creation or change time of common tables.

    Takes (memname, memtype, nobs, crdate, modate), one row per table. The row count of a common
    table is not compared.
    """
    attributes = ["memtype", "nobs", "crdate", "modate"]
    both = _sides(a, b, ["memname"], attributes)
    common = F.col("sources") == "SCDM and QA"

    def differs(c: str) -> Column:
        return ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))

    def moved(c: str) -> Column:
        shift = F.abs(F.unix_timestamp(F.col(f"a_{c}").cast("timestamp")) - F.unix_timestamp(F.col(f"b_{c}").cast("timestamp")))
        return differs(c) & ~F.coalesce(shift == HOUR, F.lit(False))

    hits = F.array(
        _attribute("memtype", ~common | differs("memtype")),
        _attribute("nobs", ~common),
        _attribute("crdate", ~common | moved("crdate")),
        _attribute("modate", ~common | moved("modate")),
    )
    return (
        both.select("sources", "memname", F.explode(hits).alias("h"))
        .where("h is not null")
        .select("sources", "memname", "h.*")
    )


def detail_differences(
    a: DataFrame, b: DataFrame, header: DataFrame, attributes: list[str]
) -> DataFrame:
    """Differing column attributes of tables that both sides have."""
    one_sided = header.where("sources <> 'SCDM and QA'").select("memname").distinct()
    both = _sides(a, b, ["memname", "name"], attributes).join(one_sided, "memname", "left_anti")
    hits = F.array(
        *[_attribute(c, ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))) for c in attributes]
    )
    return (
        both.select("sources", "memname", "name", F.explode(hits).alias("h"))
        .where("h is not null")
        .select("sources", "memname", "name", "h.*")
    )


def overall_grade(header: DataFrame, detail: DataFrame) -> DataFrame:
    """One row: PASS without differences, else FAIL with the names of the tables."""
    names = header.select("memname").unionByName(detail.select("memname")).distinct()
    failed = F.array_join(F.array_sort(F.collect_set("memname")), " ")
    bad = F.concat(
        F.lit("Data dictionary tables between SCDM and QA do NOT match for these tables: "), "failed"
    )
    return names.agg(failed.alias("failed")).select(
        F.when(F.col("failed") == "", "PASS").otherwise("FAIL").alias("grade"),
        F.when(F.col("failed") == "", "Data dictionary tables between SCDM and QA match.")
        .otherwise(bad)
        .alias("results"),
    )


def label_check(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Table labels of two sources graded per table, in lower case."""
    a = actual.select(unsplit(F.col("memname")).alias("memname"), F.lower("memlabel").alias("actual")).distinct()
    e = expected.select(unsplit(F.col("memname")).alias("memname"), F.lower("memlabel").alias("expected")).distinct()
    same = F.col("actual").eqNullSafe(F.col("expected"))
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("actual", "expected")]
    return (
        e.join(a, "memname", "full_outer")
        .select("memname", same.alias("same"), *blank)
        .select(
            "memname",
            F.when(F.col("same"), "PASS").otherwise("FAIL").alias("grade"),
            F.when(F.col("same"), F.concat(F.lit("Expected and actual labels match: "), "actual"))
            .otherwise(F.concat(F.lit("Expected label is "), "expected", F.lit(" but "), "actual", F.lit(" was found.")))
            .alias("results"),
        )
    )


# --- comparison of result tables ------------------------------------------------------------


def snake_case(name: str) -> str:
    """FlagType becomes flag_type, MPatID becomes m_pat_id."""
    word_starts = r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Za-z0-9])(?=[A-Z][a-z])"
    return re.sub(word_starts, "_", name).lower()


COPIES = 100_000  # equal rows that one sort key may stand for


def canonical(df: DataFrame, dates: list[str] | None = None) -> DataFrame:
    """Snake-case names, date columns as ISO text, rows in a stable order.

    Equal rows are sorted as counted chunks and written out after the sort, so that a row with very
    many copies is spread over tasks.
    """
    named = df.select(*[F.col(c).alias(snake_case(c)) for c in df.columns])
    wanted = [c for c in named.columns if "date" in c] if dates is None else dates
    iso = {c: F.date_format(F.col(c).try_cast("date"), "yyyy-MM-dd") for c in wanted if c in named.columns}
    out = named.withColumns(iso) if iso else named
    columns = out.columns
    last = F.floor((F.col("_n") - 1) / COPIES)
    chunks = out.groupBy(*columns).agg(F.count("*").alias("_n")).select(
        *columns, "_n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_chunk")
    )
    size = F.least(F.lit(COPIES).cast("long"), F.col("_n") - F.col("_chunk") * COPIES)
    return (
        chunks.orderBy(*columns, "_chunk")
        .select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("_copy"))
        .drop("_copy")
    )


def result_differences(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """How often rows stand on one side more than on the other, by key, field by field, and by flag id.

    Both sides are counted together, one row per distinct row: equal rows meet in the aggregate, however
    often a key repeats, and a null equals a null only. These counts are written once (`work.cut`), so each
    side is computed once; all that follows reads them. kind is missing or unexpected (a key of one
    side), rows (a common key with differing numbers of rows), strict or message (a value of a common
    key's field, with its counts on both sides), flagid_expected_only or flagid_actual_only.
    """
    common = [c for c in expected.columns if c in actual.columns]
    fields = {c: "strict" for c in common if c in STRICT and c not in keys}
    fields |= {c: "message" for c in common if c in INFORMATIONAL and c not in keys}
    columns = [*keys, *fields]

    def side(df: DataFrame, e: int, a: int) -> DataFrame:
        return df.select(*[F.col(c).cast("string").alias(c) for c in columns], F.lit(e).alias("e"), F.lit(a).alias("a"))

    sums = [F.sum("e").cast("long").alias("e"), F.sum("a").cast("long").alias("a")]
    rows = work.cut(side(expected, 1, 0).unionByName(side(actual, 0, 1)).groupBy(*columns).agg(*sums))

    # Every count that is told is a sum over one grouping of these rows: by key, by key and a field's value, by flag id.
    def entry(kind: str, key: bool, field: str | None = None, value: Column | None = None) -> Column:
        nothing = F.lit(None).cast("string")
        named = [(F.col(k) if key else nothing).alias(k) for k in keys]
        return F.struct(F.lit(kind).alias("kind"), *named, F.lit(field).cast("string").alias("field"), (nothing if value is None else value).alias("value"))

    entries = [entry("key", True)]
    # Rows that stand equally often on both sides cannot make a value differ.
    entries += [F.when(F.col("e") != F.col("a"), entry(kind, True, c, F.col(c))) for c, kind in fields.items()]
    if "flagid" in columns:
        entries.append(F.when(F.col("flagid").isNotNull(), entry("flagid", False, "flagid", F.col("flagid"))))
    told = rows.select(F.explode(F.array(*entries)).alias("t"), "e", "a").where("t is not null")
    told = work.cut(told.groupBy("t").agg(*sums).select("t.*", "e", "a").where("e <> a or kind = 'key'"))

    key_text = F.concat_ws("|", *[F.coalesce(k, F.lit("(null)")) for k in keys])
    side_only = F.when(F.col("a") == 0, "expected").when(F.col("e") == 0, "actual")
    kind = (
        F.when((F.col("kind") == "key") & (side_only == "expected"), "missing")
        .when((F.col("kind") == "key") & (side_only == "actual"), "unexpected")
        .when(F.col("kind") == "key", "rows")
        .when(F.col("kind") == "flagid", F.concat(F.lit("flagid_"), side_only, F.lit("_only")))
    )
    first = F.col("kind").isin("key", "flagid")
    whole = told.where(first & (F.col("e") != F.col("a"))).select(
        kind.alias("kind"), F.when(F.col("kind") == "flagid", F.col("value")).otherwise(key_text).alias("key"), F.coalesce("field", F.lit("")).alias("field"), "value", "e", "a"
    )
    out = whole.where("kind is not null")
    if fields:
        # A field is told for keys of both sides only.
        matched = told.where("kind = 'key' and e > 0 and a > 0").select(*[F.col(k).alias(f"m_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"m_{k}")) for k in keys]
        differing = told.where(~first).join(matched, same, "left_semi")
        out = out.unionByName(differing.select("kind", key_text.alias("key"), "field", "value", "e", "a"))
    return out.withColumnsRenamed({"e": "n_expected", "a": "n_actual"})


def is_match(differences: DataFrame) -> DataFrame:
    """Counts per kind and whether the tables agree; message differences do not matter."""
    return differences.agg(
        (F.count_if(F.col("kind") != "message") == 0).alias("is_match"),
        *[F.count_if(F.col("kind") == k).alias(k) for k in ("missing", "unexpected", "rows", "strict", "message")],
        F.count_if(F.col("kind").startswith("flagid")).alias("flagid"),
    )


def load_comparison(new: DataFrame, old: DataFrame) -> DataFrame:
    """Flag counts of two loads side by side with difference and percent change.

    Takes (flagid, abort_yn, flag_type, flag_descr, count), and dp where both have it; a flag only
    the old load has keeps the old attributes.
    """
    attributes = ["abort_yn", "flag_type", "flag_descr"]
    if "dp" in new.columns and "dp" in old.columns:
        attributes = ["dp", *attributes]
    n = new.select("flagid", *attributes, F.col("count").alias("count_new"), F.lit(1).alias("is_new"))
    o = old.select("flagid", *[F.col(c).alias(f"o_{c}") for c in attributes], F.col("count").alias("count_old"))
    diff = F.col("count_new") - F.col("count_old")
    return n.join(o, "flagid", "full_outer").select(
        "flagid",
        *[F.when(F.col("is_new").isNull(), F.col(f"o_{c}")).otherwise(F.col(c)).alias(c) for c in attributes],
        "count_old",
        "count_new",
        diff.alias("diff_count"),
        (diff / F.nullif("count_old", F.lit(0)) * 100).alias("pctchg_count"),
        F.lit(None).cast("string").alias("sign_off"),
        F.lit(None).cast("string").alias("comment"),
    )
