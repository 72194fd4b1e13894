"""What a batch of changed and removed titles means for a stored table and its marts.

All work is on the changes: old rows are taken back, new rows are added. Nothing here scans more
of a table than the folders that hold a changed title, but for one pass over its keys.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.operators.cleaning import dedupe_by_key, require_key
from playbill.operators.marts import rollup_state
from playbill.schemas import ROLLUP_STATE, TOP_RATED

KEY = "tconst"


def unique_changes(changed: DataFrame) -> DataFrame:
    """One row for each key of a batch: the smallest one, as in cleaning; rows without key go."""
    return dedupe_by_key(require_key(changed))


def changed_keys(arriving: DataFrame, removed: DataFrame | None) -> DataFrame:
    """The keys of a batch. A title that arrives and is removed in one batch arrives."""
    keys = arriving.select(KEY)
    if removed is not None:
        keys = keys.union(require_key(removed).select(KEY))
    return keys.distinct()


@dataclass(frozen=True)
class Replacement:
    """Rows that are taken back, rows that take their place, and the keys of both."""

    old: DataFrame
    new: DataFrame
    keys: DataFrame


def real_changes(arriving: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new rows, keys to leave alone): arriving rows that equal the stored ones change nothing."""
    rest = [c for c in old.columns if c != KEY]
    stored = old.select(KEY, F.struct(*rest).alias("__old"), F.lit(True).alias("__there"))
    both = arriving.select(KEY, *rest, F.struct(*rest).alias("__new")).join(stored, KEY, "left")
    same = F.coalesce(F.col("__there") & F.col("__new").eqNullSafe(F.col("__old")), F.lit(False))
    return both.filter(~same).select(KEY, *rest), both.filter(same).select(KEY)


def rollup_delta(change: Replacement) -> DataFrame:
    """Signed sums and counts per type and year: old rows subtracted, new rows added."""
    sums = ("rating_sum", "total_votes", "title_count")
    back = rollup_state(change.old).withColumns({c: -F.col(c) for c in sums})
    return back.unionByName(rollup_state(change.new)).select(ROLLUP_STATE.fieldNames())


def rollup_with(state: DataFrame, delta: DataFrame) -> DataFrame:
    """A rollup state with a signed delta; groups without titles go."""
    sums = [F.sum(c).alias(c) for c in ("rating_sum", "total_votes", "title_count")]
    both = state.unionByName(delta).groupBy("title_type", "start_year").agg(*sums)
    return both.filter("title_count <> 0")


def with_changes(rows: DataFrame, keys: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of a table, or of the touched part of it, after a change."""
    return rows.join(keys, KEY, "left_anti").unionByName(new.select(rows.columns))


def board_order() -> list[Column]:
    return [F.desc("average_rating"), F.desc("num_votes"), F.asc(KEY)]


def _best(rows: DataFrame, most: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("title_type").orderBy(*board_order()))
    return rows.withColumn("place", place).filter(F.col("place") <= most)


def board_with_reserve(top: DataFrame, k: int, reserve: int) -> DataFrame:
    """The ``k`` best rows of each type and ``reserve`` more, with their places from 1.

    ``whole`` tells that the type has no further rows.
    """
    placed = _best(top.select(TOP_RATED.fieldNames()), k + reserve + 1)
    count = F.count(F.lit(1)).over(Window.partitionBy("title_type"))
    rows = placed.withColumn("whole", count <= k + reserve)
    return rows.filter(F.col("place") <= k + reserve)


def board_after(
    board: DataFrame, change: Replacement, new_top: DataFrame, k: int, reserve: int
) -> tuple[DataFrame, DataFrame]:
    """(board, types to fill again) after a change.

    A new row counts where it is above the lowest row the board had before, or where the board had
    all rows of its type; below that, rows that the board does not know may come first. A type with
    fewer than ``k`` rows left that are known to be the best has to be filled from the table.
    """
    names = TOP_RATED.fieldNames()
    rank = F.struct(F.col("average_rating"), F.col("num_votes"))
    floor = board.groupBy("title_type").agg(
        F.min(rank).alias("__rank"),
        F.max_by(KEY, "place").alias("__key"),
        F.first("whole").alias("__whole"),
    )
    left = board.select(names).join(change.keys, KEY, "left_anti")
    known = new_top.select(names).join(floor, "title_type", "left")
    above = (rank > F.col("__rank")) | (
        (rank == F.col("__rank")) & (F.col(KEY) <= F.col("__key"))
    )
    # A type the board has no row of has none in the table either.
    enters = F.col("__rank").isNull() | F.col("__whole") | above
    merged = left.unionByName(known.filter(enters).select(names))
    placed = _best(merged, k + reserve + 1)
    whole = floor.select("title_type", F.col("__whole").alias("whole"))
    count = F.count(F.lit(1)).over(Window.partitionBy("title_type"))
    after = placed.withColumn("__count", count).join(whole, "title_type", "left").withColumn(
        "whole",
        F.coalesce("whole", F.lit(True)) & (F.col("__count") <= k + reserve),
    )
    after = after.filter(F.col("place") <= k + reserve)
    counts = after.groupBy("title_type").agg(F.max("place").alias("places"))
    short = whole.join(counts, "title_type", "left").filter(
        ~F.col("whole") & (F.coalesce("places", F.lit(0)) < k)
    )
    return after.select(*names, "place", "whole"), short.select("title_type")
