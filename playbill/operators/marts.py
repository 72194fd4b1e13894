"""Derived tables and views over the wide table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill import fixed_values as V
from playbill.functions import list_items
from playbill.schemas import ROLLUP_STATE, TITLES_BY_GENRE, TOP_RATED
from playbill.sources.tables import years_between


def rollup_state(df: DataFrame) -> DataFrame:
    """Sums and counts of the rated titles per type and year (0 = year unknown)."""
    return (
        df.filter(F.col("average_rating").isNotNull())
        .groupBy("title_type", F.coalesce("start_year", F.lit(0)).alias("start_year"))
        .agg(
            F.sum(F.col("average_rating").cast("double")).alias("rating_sum"),
            F.coalesce(F.sum("num_votes"), F.lit(0)).cast("long").alias("total_votes"),
            F.count(F.lit(1)).alias("title_count"),
        )
        .select(ROLLUP_STATE.fieldNames())
    )


def merge_rollup(*states: DataFrame) -> DataFrame:
    """Add rollup states up, e.g. the stored one and that of newly arrived titles."""
    merged = states[0]
    for state in states[1:]:
        merged = merged.unionByName(state)
    sums = [F.sum(c).alias(c) for c in ("rating_sum", "total_votes", "title_count")]
    return merged.groupBy("title_type", "start_year").agg(*sums)


def rollup_view(state: DataFrame) -> DataFrame:
    """The rollup as read: averages are derived here, never stored."""
    return state.select(
        "title_type",
        "start_year",
        (F.col("rating_sum") / F.col("title_count")).alias("avg_rating"),
        "total_votes",
        "title_count",
    )


def ratings_rollup(df: DataFrame) -> DataFrame:
    """Average rating, votes and titles per type and year."""
    return rollup_view(rollup_state(df))


def top_rated(df: DataFrame, min_votes: int = 50000) -> DataFrame:
    """Rated titles with enough votes, for leaderboards."""
    return df.filter(
        F.col("average_rating").isNotNull() & (F.col("num_votes") >= min_votes)
    ).select(TOP_RATED.fieldNames())


def titles_by_genre(df: DataFrame) -> DataFrame:
    """One row per title and genre."""
    exploded = df.withColumn("genre", list_items("genres", V.GENRE_SEPARATOR))
    return exploded.select(TITLES_BY_GENRE.fieldNames())


def movies(df: DataFrame) -> DataFrame:
    return df.filter(F.col("title_type") == "movie")


def tv_series(df: DataFrame) -> DataFrame:
    return df.filter(F.col("title_type") == "tvSeries")


def recent_popular(df: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Titles of the last years with more than a handful of votes; by default as of today."""
    this_year = F.year(F.current_date()) if as_of_year is None else F.lit(as_of_year)
    recent = years_between(df, first=this_year - V.RECENT_YEARS)
    return recent.filter(F.col("num_votes") > V.RECENT_MIN_VOTES)


def register_views(
    df: DataFrame, as_of_year: int | None = None, prefix: str = ""
) -> list[str]:
    """Register the wide table and its three views for SQL; returns the view names."""
    views = {
        "titles": df,
        "v_movies": movies(df),
        "v_tv_series": tv_series(df),
        "v_recent_popular": recent_popular(df, as_of_year),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]
