"""Structure and value profiling (level 1).

Counters of one table come from one aggregate over one scan, whatever the number of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.functions.rulesets import (
    AGE_BOUNDS,
    WHOLE_MARK,
    Flag,
    VariableRule,
    flag,
)
from carelens.sources.tables import Tables, union_all

_DECLARED = "__CHAR_VARCHAR_TYPE_STRING"  # where Spark keeps char(n) / varchar(n) of a column


def row_counts(tables: Tables) -> DataFrame:
    """Rows per table."""
    return union_all(
        [
            df.agg(F.count("*").alias("count_obs")).select(F.lit(n.upper()).alias("tabid"), "count_obs")
            for n, df in tables.items()
        ]
    )


def missing_tables(spark: SparkSession, expected: list[str], counts: DataFrame) -> DataFrame:
    """One abort row per expected table that is not among the counted tables."""
    rule = flag("100")
    want = spark.createDataFrame([(t.upper(),) for t in expected], "tabid string")
    return want.join(counts.select("tabid"), "tabid", "left_anti").select(
        F.concat("tabid", F.lit("_1_00_00-0_100")).alias("flagid"),
        F.lit(rule.descr).alias("flag_descr"),
        F.lit(rule.flag_type).alias("flag_type"),
        F.lit(rule.abort_yn).alias("abort_yn"),
        F.lit(WHOLE_MARK).cast("long").alias("count"),
        F.lit(True).alias("whole"),
    )


def empty_tables(counts: DataFrame) -> DataFrame:
    """One abort row per table without rows."""
    rule = flag("101")
    return counts.where("count_obs = 0").select(
        F.concat("tabid", F.lit("_1_00_00-0_101")).alias("flagid"),
        F.lit(rule.descr).alias("flag_descr"),
        F.lit(rule.flag_type).alias("flag_type"),
        F.lit(rule.abort_yn).alias("abort_yn"),
        F.lit(WHOLE_MARK).cast("long").alias("count"),
        F.lit(True).alias("whole"),
    )


def type_class(dtype: T.DataType) -> str:
    """C for text, N for numbers, dates and timestamps."""
    return "C" if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)) else "N"


def declared_length(field: T.StructField) -> int | None:
    """n of char(n) or varchar(n); None for plain strings."""
    text = field.metadata.get(_DECLARED, "")
    return int(text[text.index("(") + 1 : -1]) if "(" in text else None


def _content_counters(schema: T.StructType) -> list[Column]:
    found = [F.count("*").alias("nobs")]
    for i, f in enumerate(schema.fields):
        if type_class(f.dataType) == "C" and declared_length(f) is None:
            found.append(F.max(F.length(f.name)).alias(f"len_{i}"))
    return found


def contents_of(counters: DataFrame, schema: T.StructType, tabid: str) -> DataFrame:
    """`contents` from the row of counters of a table with this schema."""
    rows = []
    for i, f in enumerate(schema.fields):
        known = declared_length(f)
        if type_class(f.dataType) == "N":
            length = F.lit(8)
        elif known is not None:
            length = F.lit(known)
        else:
            length = F.coalesce(F.col(f"len_{i}"), F.lit(0))
        rows.append(
            F.struct(
                F.lit(f.name).alias("name"),
                F.lit(i + 1).alias("varnum"),
                F.lit(type_class(f.dataType)).alias("type"),
                length.cast("int").alias("length"),
            )
        )
    return counters.select(F.lit(tabid.upper()).alias("tabid"), "nobs", F.inline(F.array(*rows)))


def contents(df: DataFrame, tabid: str) -> DataFrame:
    """One row per column: name, position, type class, length and the table's row count.

    The length is the declared one, else the longest value for text, else 8.
    """
    return contents_of(df.agg(*_content_counters(df.schema)), df.schema, tabid)


def table_size(spark: SparkSession, paths: str | list[str], tabid: str) -> DataFrame:
    """Bytes and files behind a file-based table, from the file listing alone: no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "length")
    return files.agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("filesize"), F.count("*").cast("long").alias("nfiles")
    ).select(F.lit(tabid.upper()).alias("tabid"), "filesize", "nfiles")


def compliance(found: DataFrame, rules: DataFrame) -> DataFrame:
    """Expected against present columns, types and lengths; both sides are column metadata."""
    e, a = rules.alias("e"), found.alias("a")
    return e.join(
        a,
        (F.upper("e.variable") == F.upper("a.name")) & (F.upper("e.tabid") == F.upper("a.tabid")),
        "full_outer",
    ).select(
        F.coalesce(F.upper("e.tabid"), F.col("a.tabid")).alias("tabid"),
        F.coalesce("e.variable", "a.name").alias("var"),
        F.col("e.varid").alias("varid"),
        F.when(F.col("e.variable").isNotNull(), "Y").otherwise("N").alias("ms_var"),
        F.when(F.col("a.name").isNotNull(), "Y").otherwise("N").alias("dp_var"),
        F.col("e.vartype").alias("ms_type"),
        F.col("a.type").alias("dp_type"),
        F.col("e.varlength").alias("ms_length"),
        F.col("a.length").alias("dp_length"),
        F.col("e.valid_value_type").alias("valid_value_type"),
    )


def structure_flags(comp: DataFrame) -> DataFrame:
    """Missing column (110), wrong type class (112), wrong declared length (113)."""
    present = F.col("dp_var") == "Y"

    def hit(check: str, cond: Column, value: Column, count: int) -> Column:
        return F.when(
            cond,
            F.struct(
                F.concat("tabid", F.lit("_1_"), "varid", F.lit(f"_00-0_{check}")).alias("flagid"),
                F.col("var").alias("variable"),
                value.cast("string").alias("value"),
                F.lit(count).cast("long").alias("count"),
                F.lit(count == WHOLE_MARK).alias("whole"),
            ),
        )

    hits = F.array(
        hit("110", ~present, F.lit("NA"), WHOLE_MARK),
        hit("112", present & (F.col("ms_type") != F.col("dp_type")), F.col("dp_type"), 1),
        hit(
            "113",
            present & (F.col("ms_length") != 0) & (F.col("ms_length") != F.col("dp_length")),
            F.col("dp_length"),
            WHOLE_MARK,
        ),
    )
    expected = comp.where("ms_var = 'Y'")
    return expected.select(F.explode(hits).alias("h")).where("h is not null").select("h.*")


def _ruled(columns: list[str], rules: list[VariableRule]) -> list[VariableRule]:
    have = {c.lower() for c in columns}
    return [r for r in rules if r.variable.lower() in have]


def _value_counters(columns: list[str], rules: list[VariableRule]) -> list[Column]:
    have = {c.lower() for c in columns}
    found = [F.count("*").alias("nobs")]
    for r in _ruled(columns, rules):
        name = r.variable.lower()
        found.append(F.count(name).alias(f"full_{r.varid}"))
        special = (
            F.count_if(F.col(name).isNull() & F.col(f"{name}__miss").isNotNull())
            if f"{name}__miss" in have and r.valid_value_type == "special_missing"
            else F.lit(0).cast("long")
        )
        found.append(special.alias(f"special_{r.varid}"))
    return found


def value_counts_of(counters: DataFrame, columns: list[str], rules: list[VariableRule], tabid: str) -> DataFrame:
    """`value_counts` from the row of counters of a table with these columns."""
    here = _ruled(columns, rules)
    if not here:
        shape = "tabid string, varid string, variable string, count_obs long, count_nomiss long,"
        return counters.sparkSession.createDataFrame([], f"{shape} count_spmiss long, count_null long")
    rows = [
        F.struct(
            F.lit(r.varid).alias("varid"),
            F.lit(r.variable).alias("variable"),
            F.col("nobs").alias("count_obs"),
            F.col(f"full_{r.varid}").alias("count_nomiss"),
            F.col(f"special_{r.varid}").alias("count_spmiss"),
            (F.col("nobs") - F.col(f"full_{r.varid}") - F.col(f"special_{r.varid}")).alias("count_null"),
        )
        for r in here
    ]
    return counters.select(F.lit(tabid.upper()).alias("tabid"), F.inline(F.array(*rows)))


def value_counts(df: DataFrame, rules: list[VariableRule], tabid: str = "MIL") -> DataFrame:
    """Non-missing, special-missing and null values of every rule's column, from one aggregate.

    A source that keeps special missing codes has them in `<column>__miss`.
    """
    return value_counts_of(df.agg(*_value_counters(df.columns, rules)), df.columns, rules, tabid)


def counters(df: DataFrame, rules: list[VariableRule]) -> DataFrame:
    """One row with all that `contents` and `value_counts` need, from one scan."""
    return df.agg(*_content_counters(df.schema), *_value_counters(df.columns, rules)[1:])


def population_flags(counts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Column without any value (111), or with some nulls (120); 111 takes the place of 120."""
    flags = lookup.where("checkid in ('111', '120')").groupBy("tableid", "variable1").agg(
        F.max(F.when(F.col("checkid") == "111", F.col("flagid"))).alias("f111"),
        F.max(F.when(F.col("checkid") == "120", F.col("flagid"))).alias("f120"),
    )
    c = counts.where("count_null > 0").join(
        flags,
        (F.upper("tabid") == F.upper("tableid")) & (F.lower("variable") == F.lower("variable1")),
    )
    unpopulated = F.col("f111").isNotNull() & (F.col("count_nomiss") + F.col("count_spmiss") == 0)
    return c.select(
        F.when(unpopulated, F.col("f111")).otherwise(F.col("f120")).alias("flagid"),
        "variable",
        F.lit("_null_").alias("value"),
        F.when(unpopulated, F.lit(WHOLE_MARK)).otherwise(F.col("count_null")).cast("long").alias("count"),
        unpopulated.alias("whole"),
    ).where("flagid is not null")


def unpopulated(counts: DataFrame) -> DataFrame:
    """Columns without any value."""
    return counts.where("count_nomiss + count_spmiss = 0")


def _found(cond: Column, varid: str, variable: str, value: Column) -> Column:
    return F.when(
        cond,
        F.struct(
            F.lit(varid).alias("varid"),
            F.lit(variable).alias("variable"),
            value.cast("string").alias("value"),
        ),
    )


def _per_variable(df: DataFrame, cases: list[tuple[VariableRule, Column]], keep: list[str]) -> DataFrame:
    """One row per row and variable for which the case holds, from one scan."""
    never = F.lit(False)
    any_holds, hits = never, [_found(never, "", "", F.lit(""))]
    for r, c in cases:
        any_holds = any_holds | c
        hits.append(_found(c, r.varid, r.variable, F.col(r.variable.lower())))
    return (
        df.where(any_holds)
        .select(F.explode(F.array(*hits)).alias("h"), *keep)
        .where("h is not null")
        .select("h.*", *keep)
    )


def null_rows(df: DataFrame, rules: list[VariableRule], keep: list[str]) -> DataFrame:
    """Rows with a null in a ruled column, one output row per null (120, row form)."""
    have = {c.lower() for c in df.columns}
    cases = [(r, F.col(r.variable.lower()).isNull()) for r in rules if r.variable.lower() in have]
    return _per_variable(df, cases, keep).drop("value")


def too_long(df: DataFrame, rules: list[VariableRule], keep: list[str]) -> DataFrame:
    """Text values longer than expected (113, observed); numeric columns are skipped."""
    text = {f.name.lower() for f in df.schema.fields if type_class(f.dataType) == "C"}
    cases = [
        (r, F.coalesce(F.length(r.variable.lower()) > r.varlength, F.lit(False)))
        for r in rules
        if r.variable.lower() in text and r.varlength > 0
    ]
    return _per_variable(df, cases, keep)


def gate(comp: DataFrame, counts: DataFrame) -> DataFrame:
    """Which checks a column still gets.

    y1: absent or wrong type, no value checks at all; y2: wrong length; n: fine. The value rules
    (121 and up) run only for 'n' with at least one value.
    """
    verdict = (
        F.when((F.col("dp_var") == "N") | (F.col("ms_type") != F.col("dp_type")), "y1")
        .when((F.col("ms_length") != 0) & (F.col("ms_length") != F.col("dp_length")), "y2")
        .otherwise("n")
    )
    cols = comp.where("ms_var = 'Y'").select("tabid", "var", "varid", verdict.alias("exclude"))
    n = counts.select(
        "tabid", "varid", (F.col("count_nomiss") + F.col("count_spmiss")).alias("populated")
    )
    return cols.join(n, ["tabid", "varid"], "left").select(
        "tabid",
        "var",
        "varid",
        "exclude",
        F.when((F.col("exclude") == "n") & (F.coalesce("populated", F.lit(0)) > 0), "Y")
        .otherwise("N")
        .alias("value_rules"),
    )


def name_rule(value: Column, strict: bool = False) -> Column:
    """A name with other signs than letters; hyphen and apostrophe pass unless strict."""
    return F.trim(value).rlike("[^A-Za-z]" if strict else "[^A-Za-z'-]")


def leading_blank(value: Column) -> Column:
    return value.startswith(" ")


def outside_age(value: Column) -> Column:
    low, high = AGE_BOUNDS
    return (value < low) | (value > high)


def value_rules(
    df: DataFrame,
    flags: list[Flag],
    rules: list[VariableRule],
    mindate: Column | None = None,
    maxdate: Column | None = None,
    strict_names: bool = False,
) -> DataFrame:
    """All value rules of a table in one scan: 121, 122, 126, 131 and 133.

    Condition hits (121) are counted row by row; the others count once per value and id. A
    variable of the mother carries only her id, one of the infant only the infant's.
    """
    types = {f.name.lower(): type_class(f.dataType) for f in df.schema.fields}
    conditions = {r.variable.lower(): r.condition for r in rules}
    # a column that is absent, or of another type than its rule says, gets no value check
    wrong = {r.variable.lower() for r in rules if types.get(r.variable.lower()) != r.vartype}

    def hit(test: Column, flagid: str, variable: str, value: Column, mother: bool, infant: bool, rowwise: bool) -> Column:
        none = F.lit(None).cast("string")
        return F.when(
            test,
            F.struct(
                F.lit(flagid).alias("flagid"),
                F.lit(variable).alias("variable"),
                value.cast("string").alias("value"),
                (F.col("mpatid") if mother else none).alias("mpatid"),
                (F.col("cpatid") if infant else none).alias("cpatid"),
                F.lit(rowwise).alias("rowwise"),
            ),
        )

    # a case that never holds gives the result its shape even where no rule applies
    tests = [F.lit(False)]
    hits = [hit(tests[0], "", "", F.lit(""), False, False, False)]
    for f in flags:
        name = f.variable1.lower()
        if name not in types or name in wrong:
            continue
        col = F.col(name)
        if f.check == "121":
            if not conditions.get(name):
                continue
            test, value = F.expr(conditions[name]), col
        elif f.check == "122":
            test, value = leading_blank(col), col
        elif f.check == "126":
            test, value = outside_age(col), col
        elif f.check == "131":
            if mindate is None or maxdate is None:
                continue
            test, value = (col < mindate) | (col > maxdate), F.date_format(col, "MM/dd/yyyy")
        elif f.check == "133":
            test, value = name_rule(col, strict_names), col
        else:
            continue
        test = F.coalesce(col.isNotNull() & test, F.lit(False))
        rowwise = f.check == "121"
        mother = not rowwise and (not name.startswith("c"))
        infant = not rowwise and (not name.startswith("m") or name == "matchmethod")
        hits.append(hit(test, f.flagid, f.variable1, value, mother, infant, rowwise))
        tests.append(test)
    any_hit = tests[0]
    for t in tests[1:]:
        any_hit = any_hit | t
    rows = df.where(any_hit).select(F.explode(F.array(*hits)).alias("h")).where("h is not null")
    return rows.groupBy("h.flagid", "h.variable", "h.value", "h.mpatid", "h.cpatid").agg(
        F.when(F.max("h.rowwise"), F.count("*")).otherwise(1).cast("long").alias("count")
    )


def date_range(df: DataFrame, column: str) -> DataFrame:
    """First and last date."""
    return df.agg(F.min(column).alias("mindate"), F.max(column).alias("maxdate"))
