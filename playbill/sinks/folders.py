"""Parquet folders and their layouts.

Rows are brought together with a ``rebalance`` hint: like a repartition by the folder columns,
but adaptive execution splits a folder that holds a large share of all rows over many tasks
and puts small ones together. Each task then writes sorted rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill import fixed_values as V
from playbill.functions import decade
from playbill.operators.cleaning import serving_nulls
from playbill.schemas import ENRICHED
from playbill.session import bounded_tasks

PLACE = "_place"


def _write(df, path, partitions=(), refresh="full", options=None):
    if refresh not in ("full", "partitions"):
        raise ValueError(f"refresh must be 'full' or 'partitions', not {refresh!r}")
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if refresh == "partitions":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if options:
        writer = writer.options(**options)
    if partitions:
        writer = writer.partitionBy(*partitions)
    with bounded_tasks(df.sparkSession):
        writer.parquet(path)


def lake_layout(df: DataFrame) -> DataFrame:
    """Rows of the lake, those of a folder together."""
    return df.hint("rebalance", *V.LAKE_PARTITIONS)


def write_lake(df: DataFrame, path: str, refresh: str = "full") -> None:
    """The lake: folders by type and year. ``refresh='partitions'`` replaces only those given.

    Such rows must be all rows of their folders, and no key may have come from another folder,
    where its old row would stay.
    """
    _write(lake_layout(df), path, V.LAKE_PARTITIONS, refresh)


def with_decade(df: DataFrame) -> DataFrame:
    """Add the serving partition; titles without a year go to decade 0."""
    return df.withColumn("decade", decade(F.coalesce("start_year", F.lit(0))))


def serving_rows(df: DataFrame) -> DataFrame:
    """Rows as the serving table holds them: no null texts, with their decade."""
    return with_decade(serving_nulls(df.select(ENRICHED.fieldNames())))


def serving_layout(rows: DataFrame) -> DataFrame:
    """Rows spread by decade, type and year and sorted for row-group skipping."""
    return rows.hint("rebalance", "decade", "title_type", "start_year").sortWithinPartitions(
        "decade", "title_type", F.coalesce("start_year", F.lit(0)), "tconst"
    )


def interleaved(*numbers: Column, bits: int = 8) -> Column:
    """One number from the bits of several, the highest of each first.

    Sorted by it, rows near to each other are near in each of the numbers (a Z-order).
    """
    made, at = F.lit(0), 0
    for bit in range(bits):
        for number in reversed(numbers):
            own = F.shiftright(number, bit).bitwiseAND(F.lit(1))
            made = made.bitwiseOR(F.shiftleft(own, at))
            at += 1
    return made


def ranking_order() -> Column:
    """Votes (eighths of a doubling) and rating (25ths) as one number of 16 bits; no rating: 0."""
    votes = F.floor(8 * F.log2(F.coalesce("num_votes", F.lit(0)) + 1)).cast("int")
    rating = F.floor(F.coalesce("average_rating", F.lit(0.0)) * 25).cast("int")
    within = [F.least(F.greatest(n, F.lit(0)), F.lit(255)) for n in (votes, rating)]
    return interleaved(*within)


def ranking_layout(rows: DataFrame) -> DataFrame:
    """Rows spread by decade, sorted by votes and rating together.

    A row group then holds a narrow range of both, so that a filter by either, or by both, skips
    most of them; ``serving_layout`` is for filters by type and year. The number is a column while
    the rows are sorted, as a sort computes an expression again for both rows of each comparison.
    """
    numbered = rows.hint("rebalance", "decade").withColumn(PLACE, ranking_order())
    placed = numbered.sortWithinPartitions("decade", PLACE, "title_type", "tconst")
    return placed.drop(PLACE)


LAYOUTS = {"years": serving_layout, "ranking": ranking_layout}


def bloom_options(columns: tuple[str, ...]) -> dict[str, str]:
    """Writer options for whole-value Bloom filters, which hold back row groups without a value."""
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}


def write_serving(
    df: DataFrame, path: str, bloom_columns: tuple[str, ...] = (), layout: str = "years"
) -> None:
    """The serving table: decade folders, rows sorted by type, year and key (layout ``years``) or
    by votes and rating together (``ranking``).

    Sorting gives narrow min/max ranges per row group; ``bloom_columns`` adds whole-value bloom
    filters, e.g. for key look-ups.
    """
    rows = LAYOUTS[layout](serving_rows(df))
    _write(rows, path, ("decade",), options=bloom_options(bloom_columns))


def write_rollup(state: DataFrame, path: str) -> None:
    """A rollup state; write merged ones to a new folder, as the old one is being read."""
    _write(state, path)


def leaderboard_layout(top: DataFrame) -> DataFrame:
    """Leaderboard rows in global order, so one type's best rows are next to each other."""
    return top.orderBy("title_type", F.desc("average_rating"), F.desc("num_votes"), "tconst")


def genre_layout(titles: DataFrame) -> DataFrame:
    """Title-genre rows spread by genre, type and year, sorted by type and year."""
    spread = titles.hint("rebalance", "genre", "title_type", "start_year")
    return spread.sortWithinPartitions(
        "genre", "title_type", F.coalesce("start_year", F.lit(0)), "tconst"
    )


def write_leaderboard(top: DataFrame, path: str) -> None:
    """The leaderboard in its layout."""
    _write(leaderboard_layout(top), path)


def write_by_genre(titles: DataFrame, path: str) -> None:
    """Title-genre rows in their layout: genre folders."""
    _write(genre_layout(titles), path, ("genre",))
