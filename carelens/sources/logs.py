"""Program logs: numbered lines of a directory of text files, and their classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Texts that make a note worth reporting.
NOTES = [
    "stopped", "converted", "uninitialized", "division", "invalid", "missing values", "w.d format",
    "repeats of by values", "merge statement", "mathematical", "character values have", "disabled",
    "groups are not", "will be overwritten", "limit set by errors= option reached",
]
HARMLESS = "data step stopped due to looping"
LINES_PER_GROUP = 100_000


def read_lines(spark: SparkSession, directory: str) -> DataFrame:
    """(path, logname, logline_number, logline) of every text file, each file split over many tasks.

    A line's number is its position within its file block plus the lines of the earlier blocks. A
    file whose compression cannot be split is one block. Files of one name in different folders
    differ by path.
    """
    lines = spark.read.text(directory).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("logline"),
    )
    # a block is at most one input split, and a file has one block row per split
    sizes = lines.groupBy("path", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("path", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("path", "block").orderBy("seq"))
    return (
        lines.withColumn("nth", within)
        .join(starts, ["path", "block"])
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("logname"),
            (F.col("before") + F.col("nth")).alias("logline_number"),
            "logline",
        )
    )


def fill_forward(df: DataFrame, key: str, line: str, columns: list[str]) -> DataFrame:
    """Each column's latest non-null value up to the line, per log.

    A log is cut into groups of consecutive lines; only the last values of each group are combined
    per log, so no task holds a whole log.
    """
    grouped = df.withColumn("g", F.floor(F.col(line) / LINES_PER_GROUP))
    ends = grouped.groupBy(key, "g").agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(line))).alias(f"end_{c}")
            for c in columns
        ]
    )
    earlier = Window.partitionBy(key).orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        key, "g", *[F.last(f"end_{c}", ignorenulls=True).over(earlier).alias(f"from_{c}") for c in columns]
    )
    w = Window.partitionBy(key, "g").orderBy(line)
    filled = grouped.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    return (
        filled.join(carried, [key, "g"])
        .withColumns({c: F.coalesce(c, f"from_{c}") for c in columns})
        .drop("g", *[f"from_{c}" for c in columns])
    )


def classify_lines(lines: DataFrame, tag: str = "package", notes: list[str] = NOTES) -> DataFrame:
    """Errors, warnings and notable notes among log lines, with the macro they came from.

    Levels: 1 error, 2 error raised by the package itself (its second word holds `tag`), 3 warning,
    4 warning by the package, 5 note with one of the listed texts. The macro is the last one a line
    named; a macro line also keeps the last description. A log is known by its path where lines have
    one, else by its name.
    """
    log = "path" if "path" in lines.columns else "logname"
    words = F.split(F.trim("logline"), " +")
    word1, word2 = F.lower(words[0]), F.lower(F.coalesce(F.get(words, F.lit(1)), F.lit("")))
    told = lines.select(*dict.fromkeys([log, "logname"]), "logline_number", "logline", word1.alias("w1"), word2.alias("w2")).where(
        F.left("w1", F.lit(4)).isin("note", "erro", "warn", "mpri")
    )
    macro = F.when(
        F.col("w1").startswith("mprint"), F.expr("substring(w1, 8, greatest(length(w1) - 9, 0))")
    )
    ours = F.col("w2").contains(tag.lower())
    title = tag.capitalize()
    own_warning = F.col("w1").contains("warning") & ours
    own_error = F.col("w1").contains("error") & ours
    error, warning = F.col("w1").rlike(r"\berror\b"), F.col("w1").rlike(r"\bwarning\b")
    description = (
        F.when(own_warning, f"{title} Warning")
        .when(own_error, f"{title} Error")
        .when(error, "SAS Error")
        .when(warning, "SAS Warning")
        .when(F.col("w1").rlike(r"\bnote\b"), "SAS Note")
    )
    level = F.when(own_warning, 4).when(own_error, 2).when(error, 1).when(warning, 3)
    marked = told.select(
        *dict.fromkeys([log, "logname"]), "logline_number", "logline",
        macro.alias("macro"), description.alias("description"), level.alias("level"),
    )
    filled = fill_forward(marked, log, "logline_number", ["macro", "description"])
    notable = (F.col("description") == "SAS Note") & _mentions(F.lower("logline"), notes)
    return filled.withColumn(
        "level", F.when(notable, 5).otherwise(F.col("level"))
    ).where("level is not null").select(
        "level", "description", *dict.fromkeys([log, "logname"]), "logline_number", "logline", "macro"
    )


def _mentions(text: Column, notes: list[str]) -> Column:
    quoted = text.contains("'invalid'") | text.contains('"invalid"') | text.contains("(invalid)")
    any_note = F.lit(False)
    for note in notes:
        hit = text.contains(note)
        any_note = any_note | ((hit & ~quoted) if note == "invalid" else hit)
    return any_note & ~text.contains(HARMLESS)
