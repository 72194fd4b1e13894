"""Quality rules and summary figures."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill import fixed_values as V
from playbill.functions import in_range_or_null, percent_of


def title_rules(as_of_year: int) -> dict[str, Column]:
    """Violation conditions for rows of the wide table."""
    last_year = as_of_year + V.YEARS_AHEAD
    return {
        "key_not_null": F.col("tconst").isNull(),
        "rating_in_range": ~in_range_or_null("average_rating", V.LOWEST_RATING, V.HIGHEST_RATING),
        "year_in_range": ~in_range_or_null("start_year", V.FIRST_YEAR, last_year),
        "genres_not_null": F.col("genres").isNull(),
    }


def quality_report(
    df: DataFrame, rules: Mapping[str, Column], unique_key: str | None = "tconst"
) -> DataFrame:
    """(rule, violations), one row per rule, from one pass over the frame.

    Rules are counted per key first, so the uniqueness rule (rows beyond the first of a key)
    needs no second scan and a hot key is summed in the map tasks.
    """
    broken = [F.count_if(condition).alias(name) for name, condition in rules.items()]
    names = list(rules)
    if unique_key is None:
        totals = df.agg(*broken)
    else:
        per_key = df.groupBy(unique_key).agg(F.count(F.lit(1)).alias("key_unique"), *broken)
        extra = F.col("key_unique") - 1
        totals = per_key.agg(
            F.coalesce(F.sum(extra), F.lit(0)).alias("key_unique"),
            *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
        )
        names = [*names, "key_unique"]
    return totals.unpivot([], names, "rule", "violations")


def _summaries():
    return [
        F.count(F.lit(1)).alias("total"),
        F.min("start_year").alias("min_year"),
        F.max("start_year").alias("max_year"),
        F.count("average_rating").alias("rated"),
        F.count("parent_tconst").alias("with_parent"),
    ]


def summary(df: DataFrame) -> DataFrame:
    """Row count, year range, and how many rows are rated or have a parent, in one pass."""
    return df.agg(*_summaries()).select(
        "total",
        "min_year",
        "max_year",
        "rated",
        percent_of("rated", "total").alias("rated_pct"),
        "with_parent",
        percent_of("with_parent", "total").alias("with_parent_pct"),
    )


def type_summary(df: DataFrame) -> DataFrame:
    """Rows per title type with their percentage, most frequent first."""
    counted = df.groupBy("title_type").count()
    # One scan: the total is summed over the counts, a row for each type.
    total = F.sum("count").over(Window.partitionBy())
    return counted.withColumn("pct", percent_of("count", total)).orderBy(
        F.desc("count"), "title_type"
    )
