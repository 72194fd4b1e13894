"""The two batch jobs: raw files to lake, lake to serving table and rollup."""

from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playbill import fixed_values as V
from playbill.operators.cleaning import (
    clean_episodes,
    clean_ratings,
    clean_titles,
    enrich,
    valid_episodes,
    valid_ratings,
    valid_titles,
)
from playbill.operators.ledger import (
    FILE,
    input_ledger,
    ledger_rows,
    output_ledger,
    step_totals,
    with_file,
)
from playbill.operators.marts import rollup_state, rollup_view
from playbill.operators.quality import summary, type_summary
from playbill.plans.reports import report
from playbill.schemas import ENRICHED, LEDGER, ROLLUP_STATE
from playbill.sinks.folders import (
    LAYOUTS,
    bloom_options,
    lake_layout,
    serving_rows,
)
from playbill.sources import partition_summary, read_lake, read_raw, read_serving
from playbill.versions import Store, table_rows


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows in the pass that uses them; read ``observation.get['rows']`` after the action.

    A figure for logs: where Spark repeats a shuffle stage after losing an executor, rows of
    the repeated tasks count again.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _rows_of(seen: Observation, df: DataFrame) -> int:
    """The observed rows. Where one input has no rows, adaptive execution drops the other side
    of its join together with the count; then the rows are counted by themselves."""
    try:
        return seen.get["rows"]
    except (Py4JError, KeyError, AssertionError):
        return df.count()


def _cleaned(titles, ratings, episodes, as_of_year):
    return (
        clean_titles(titles, as_of_year, keep_hash=True),
        clean_ratings(ratings, keep_hash=True),
        clean_episodes(episodes, keep_hash=True),
    )


def wide_table(
    titles: DataFrame, ratings: DataFrame, episodes: DataFrame, as_of_year: int
) -> DataFrame:
    """Raw frames to the wide table: clean each, join all. Lazy."""
    return enrich(*_cleaned(titles, ratings, episodes, as_of_year))


def _lake_ledger(spark, raw_folder, suffix, as_of_year, version, written):
    """The counts of a lake run, by file and step, from the input and the written rows."""
    titles, ratings, episodes = map(with_file, read_raw(spark, raw_folder, suffix))
    return ledger_rows(
        version,
        input_ledger("titles", titles, valid_titles(titles, as_of_year, FILE)),
        input_ledger("ratings", ratings, valid_ratings(ratings, FILE)),
        input_ledger("episodes", episodes, valid_episodes(episodes, FILE)),
        output_ledger("lake", written),
    )


def read_ledger(spark: SparkSession, lake: str) -> DataFrame:
    """The counts of all loads of a lake that kept a ledger, as they were committed."""
    store = Store(spark, lake)
    found = store.snapshot()
    folders = found.tables.get("ledger", ()) if found else ()
    return store.read("ledger", LEDGER, folders=folders)


@dataclass(frozen=True)
class LakeOutcome:
    """What a lake run saw; ``summary`` and ``types`` are lazy frames over the written lake."""

    rows_read: dict[str, int]
    rows_kept: dict[str, int]
    rows: int
    summary: DataFrame
    types: DataFrame


def build_lake(
    spark: SparkSession,
    raw_folder: str,
    lake: str,
    as_of_year: int,
    suffix: str = "",
    spread: bool = False,
    ledger: bool = False,
) -> LakeOutcome:
    """Read, clean, join and write in one pass over the input, without caching.

    ``spread`` shares the rows of few big files (``.gz`` ones cannot be split) out over the
    cluster. ``lake`` is a store: the rows of the load before are what readers see until all new
    ones are written, and stay so if the job fails.

    ``ledger`` counts the rows of each file and step in further passes over the input, which
    repeated stages do not change, and adds them to the store's ledger in the same switch.
    """
    names = ("titles", "ratings", "episodes")
    plain = read_raw(spark, raw_folder, suffix, spread)
    raw, read = zip(*[counted(df, f"{n} read") for df, n in zip(plain, names)])
    cleaned = _cleaned(*raw, as_of_year)
    cleaned, kept = zip(*[counted(df, f"{n} kept") for df, n in zip(cleaned, names)])
    store = Store(spark, lake)
    base = store.snapshot()
    folders = store.stage("lake", lake_layout(enrich(*cleaned)), V.LAKE_PARTITIONS)
    tables = {"lake": folders}
    if ledger:
        version = base.version + 1 if base else 0
        staged = store.read("lake", ENRICHED, folders=folders)
        counts = _lake_ledger(spark, raw_folder, suffix, as_of_year, version, staged)
        before = base.tables.get("ledger", ()) if base else ()
        tables["ledger"] = before + store.stage("ledger", counts.coalesce(1))
    store.commit(base, tables)
    if ledger:
        counts = read_ledger(spark, lake).filter(F.col("load_version") == version)
        return _outcome_of(counts, read_lake(spark, lake))
    plain_kept = _cleaned(*plain, as_of_year)
    written = read_lake(spark, lake)
    return LakeOutcome(
        rows_read={n: _rows_of(o, df) for n, o, df in zip(names, read, plain)},
        rows_kept={n: _rows_of(o, df) for n, o, df in zip(names, kept, plain_kept)},
        rows=written.count(),
        summary=summary(written),
        types=type_summary(written),
    )


def _outcome_of(ledger, written):
    """The totals of one load; a dozen rows."""
    totals = {(r["input"], r["step"]): r["rows"] for r in step_totals(ledger).collect()}
    read, kept = (
        {n: totals.get((n, step), 0) for n in ("titles", "ratings", "episodes")}
        for step in ("read", "kept")
    )
    return LakeOutcome(
        rows_read=read,
        rows_kept=kept,
        rows=totals[("lake", "written")],
        summary=summary(written),
        types=type_summary(written),
    )


@dataclass(frozen=True)
class LoadOutcome:
    """What a load wrote; the checks are lazy frames over the serving table."""

    rows: int
    types: DataFrame
    partitions: DataFrame
    recent: DataFrame
    best_movies: DataFrame


def load_serving(
    spark: SparkSession,
    lake: str,
    serving: str,
    rollup: str | None = None,
    bloom_columns: tuple[str, ...] = ("tconst",),
    layout: str = "years",
) -> LoadOutcome:
    """Lake to serving table, and the rollup from the serving table.

    Both are stores, whose rows of the load before stay readable until the new ones are written.
    The table is written whole; ``refresh.apply_changes`` loads changes alone. ``layout`` is
    ``years`` or ``ranking``, for skipping by year or by votes and rating.

    Titles without a year are loaded too, into decade 0. A failing file fails the load.
    """
    store = Store(spark, serving)
    base = store.snapshot()
    rows = LAYOUTS[layout](serving_rows(read_lake(spark, lake)))
    folders = store.stage("titles", rows, ("decade",), **bloom_options(bloom_columns))
    store.commit(base, {"titles": folders})
    table = read_serving(spark, serving)
    if rollup:
        sums = Store(spark, rollup)
        before = sums.snapshot()
        sums.commit(before, {"rollup": sums.stage("rollup", rollup_state(table))})
    return LoadOutcome(
        rows=table.count(),
        types=report("l2", table),
        partitions=partition_summary(table),
        recent=report("l3", table),
        best_movies=report("l4", table),
    )


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The stored rollup with its averages, from a store or a plain folder."""
    return rollup_view(table_rows(spark, path, "rollup", ROLLUP_STATE))
