"""Parsing of edit announcements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The announcement format, its flag letters and title prefixes.
EDIT_LINE = r"\[\[(.*)\]\]\s(.*)\s(.*)\s\*\s(.*)\s\*\s\(\+?(.\d*)\)\s(.*)"
FLAG_NEW, FLAG_MINOR, FLAG_UNPATROLLED, FLAG_BOT = "N", "M", "!", "B"
SPECIAL_PREFIX, TALK_PREFIX = "Special:", "Talk:"


def wiki_parse(df: DataFrame, line: str) -> DataFrame:
    """Ten typed fields per announcement; lines of another form are dropped."""
    # The expression runs once per line: its groups are joined by a separator and split again,
    # and a line without a match stays in one piece.
    groups = "\u0001".join(f"${g}" for g in range(1, 7))
    joined = F.regexp_replace(line, f"^.*?{EDIT_LINE}$", groups)
    pieces = F.filter(F.array(F.split(joined, "\u0001")), lambda p: F.size(p) == 6)
    title, flags = F.col("title"), F.col("_p")[1]
    return (
        df.withColumn("_p", F.explode(pieces))
        .withColumn("title", F.col("_p")[0])
        .withColumn("diff_url", F.col("_p")[2])
        .withColumn("user", F.col("_p")[3])
        .withColumn("byte_diff", F.col("_p")[4].try_cast("int"))
        .withColumn("summary", F.col("_p")[5])
        .filter(F.col("byte_diff").isNotNull())
        .withColumn("is_new", flags.contains(FLAG_NEW))
        .withColumn("is_minor", flags.contains(FLAG_MINOR))
        .withColumn("is_unpatrolled", flags.contains(FLAG_UNPATROLLED))
        .withColumn("is_bot", flags.contains(FLAG_BOT))
        .withColumn(
            "type",
            F.when(title.startswith(SPECIAL_PREFIX), "SPECIAL")
            .when(title.startswith(TALK_PREFIX), "TALK")
            .otherwise("EDIT"),
        )
        .drop("_p")
    )


def wiki_edits_by_user(df: DataFrame, line: str) -> DataFrame:
    """Plain page edits counted per user."""
    edits = wiki_parse(df, line).filter(F.col("type") == "EDIT")
    return edits.groupBy("user").agg(F.count(F.lit(1)).alias("cnt"))
