"""The serving store: the wide table and its marts, loaded whole or by changes, seen as one.

A store holds ``titles`` (the serving table, by decade), ``rollup`` (sums per type and year),
``by_genre`` (title-genre rows by genre and decade), ``top_rated`` and ``board`` (the best titles
of each type with a reserve), and ``sketches`` (mergeable medians and distinct counts per type
and year, by decade). Every load switches all of them at once.
"""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playbill.operators import changes, marts
from playbill.operators.sketches import merge_sketches, sketch_estimates, sketch_state
from playbill.schemas import (
    ENRICHED,
    ROLLUP_STATE,
    SERVING,
    SKETCHES,
    TITLES_BY_GENRE,
    TOP_RATED,
)
from playbill.session import fresh_path, released_shuffles
from playbill.sinks.folders import LAYOUTS, bloom_options, serving_rows, with_decade
from playbill.sources.tables import years_between
from playbill.versions import Snapshot, Store, partition_values

MIN_VOTES = 50000
BOARD, RESERVE = 100, 100
#: A batch of more keys is great: it is taken to touch all folders, and its keys are hashed.
MANY_KEYS = 500_000
_DECADE = T.StructField("decade", T.IntegerType())
GENRES = T.StructType([*TITLES_BY_GENRE.fields, _DECADE])
BOARD_ROWS = T.StructType(
    [*TOP_RATED.fields, T.StructField("place", T.IntegerType()), T.StructField("whole", T.BooleanType())]
)


def _kept(df: DataFrame, label: str) -> DataFrame:
    """Write a small table of a job to the shared folder and read it again."""
    path = fresh_path(df.sparkSession, label)
    with released_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _genre_rows(titles: DataFrame) -> DataFrame:
    return with_decade(marts.titles_by_genre(titles)).select(GENRES.fieldNames())


def _stage_titles(store, rows, layout, bloom_columns):
    return store.stage("titles", LAYOUTS[layout](rows), ("decade",), **bloom_options(bloom_columns))


def _stage_genres(store, rows):
    spread = rows.hint("rebalance", "genre", "decade").sortWithinPartitions(
        "genre", "decade", "title_type", F.coalesce("start_year", F.lit(0)), "tconst"
    )
    return store.stage("by_genre", spread, ("genre", "decade"))


def _stage_sketches(store, titles):
    states = sketch_state(titles).hint("rebalance", "decade")
    return store.stage("sketches", states.sortWithinPartitions("decade", "title_type"), ("decade",))


def _stage_top(store, top):
    return store.stage("top_rated", top.orderBy("title_type", *changes.board_order()))


def publish(
    spark: SparkSession,
    root: str,
    wide: DataFrame,
    batch: str | None = None,
    layout: str = "years",
    bloom_columns: tuple[str, ...] = (),
    min_votes: int = MIN_VOTES,
    k: int = BOARD,
    reserve: int = RESERVE,
) -> Snapshot:
    """Load the whole table and its marts; readers keep the rows before until all is written."""
    store = Store(spark, root)
    base = store.snapshot()
    if batch is not None and store.applied(batch):
        return base
    folders = _stage_titles(store, serving_rows(wide), layout, bloom_columns)
    titles = store.read("titles", SERVING, folders=folders)
    made = {"rollup": store.stage("rollup", marts.rollup_state(titles))}
    made["top_rated"] = _stage_top(store, marts.top_rated(titles, min_votes))
    top = store.read("top_rated", TOP_RATED, folders=made["top_rated"])
    made["board"] = store.stage("board", changes.board_with_reserve(top, k, reserve))
    made["by_genre"] = _stage_genres(store, _genre_rows(titles))
    made["sketches"] = _stage_sketches(store, titles)
    return store.commit(base, {"titles": folders, **made}, batch)


def read_mart(spark: SparkSession, root: str, name: str, k: int | None = None) -> DataFrame:
    """A mart of the newest load: ``rollup``, ``by_genre``, ``top_rated`` or ``board``.

    The board has its ``k`` best rows of each type, by default all that are stored.
    """
    store = Store(spark, root)
    if name == "rollup":
        return marts.rollup_view(store.read("rollup", ROLLUP_STATE))
    if name == "by_genre":
        rows = store.read("by_genre", GENRES).select(TITLES_BY_GENRE.fieldNames())
        return rows.withColumn("genre", F.coalesce("genre", F.lit("")))
    if name == "board":
        board = store.read("board", BOARD_ROWS).drop("whole")
        return board if k is None else board.filter(F.col("place") <= k)
    return store.read("top_rated", TOP_RATED)


def read_summary(
    spark: SparkSession,
    root: str,
    by: Sequence[str] = ("title_type",),
    first_year: int | None = None,
    last_year: int | None = None,
    quantiles: Sequence[float] = (0.5,),
) -> DataFrame:
    """Rating quantiles and distinct titles and genres of any years, from the stored sketches.

    No title is read, only the sketches of the years' decades; ``by`` names ``title_type``,
    ``start_year`` or ``decade``, or nothing for one row. Errors are those of
    ``sketch_estimates``.
    """
    states = Store(spark, root).read("sketches", SKETCHES)
    picked = years_between(states, first_year, last_year)
    return sketch_estimates(merge_sketches(picked, by), quantiles, by)


def _texts(rows: DataFrame, *columns: str) -> set[tuple[str | None, ...]]:
    """The partition values of rows, as folders' names give them; as many as folders at most."""
    texts = [F.when(F.col(c).cast("string") != "", F.col(c).cast("string")) for c in columns]
    with released_shuffles(rows.sparkSession):
        return {tuple(r) for r in rows.select(*texts).distinct().collect()}


def _split(folders, touched):
    """(touched folders, the others)."""
    inside = [f for f in folders if partition_values(f) in touched]
    return tuple(inside), tuple(f for f in folders if f not in set(inside))


def _for_lookup(keys, many):
    """Keys that whole rows are held against. Those of a great batch go into one hash table for
    each part, so that the rows are dealt out by key but not sorted by it."""
    return keys.hint("shuffle_hash") if many else keys


def _in_genre_folders(rows, touched):
    """Title-genre rows of these (genre, decade) folders, whose names have texts."""
    genres: dict[int, list[str]] = {}
    for genre, decade in touched:
        genres.setdefault(int(decade), []).append(genre or "")
    own = [(F.col("decade") == d) & F.col("genre").isin(found) for d, found in genres.items()]
    return rows.filter(reduce(or_, own, F.lit(False)))


def apply_changes(
    spark: SparkSession,
    root: str,
    changed: DataFrame,
    removed: DataFrame | None = None,
    batch: str | None = None,
    layout: str = "years",
    bloom_columns: tuple[str, ...] = (),
    min_votes: int = MIN_VOTES,
    k: int = BOARD,
    reserve: int = RESERVE,
) -> Snapshot:
    """Load new and changed wide rows, and take out the titles whose keys are ``removed``.

    Only the folders that hold an old or a new row of a real change are written again; the files
    of all others stay. Their old rows are found by key once; the marts of a touched folder are
    made from its new files, without looking for a key again. Keys that arrive twice in a batch count once, rows that equal the stored
    ones not at all, and a batch whose name was applied before is ignored. Use the settings the
    store was published with.
    """
    store = Store(spark, root)
    base = store.snapshot()
    if base is None:
        raise FileNotFoundError(f"publish {root} before changing it")
    if batch is not None and store.applied(batch):
        return base
    titles = store.read("titles", SERVING, base)
    arriving = changes.unique_changes(changed.select(ENRICHED.fieldNames()))
    arriving = _kept(serving_rows(arriving).select(SERVING.fieldNames()), "arriving")
    keys = _kept(changes.changed_keys(arriving, removed), "changed-keys")
    many = keys.count() > MANY_KEYS
    if many:  # they lie in most folders
        stored = titles
    else:
        # Two columns of all rows tell where the old rows are; whole rows come from there alone.
        places = titles.select("tconst", "decade").join(keys, "tconst", "left_semi")
        held, _ = _split(base.tables["titles"], _texts(places, "decade"))
        stored = store.read("titles", SERVING, folders=held)
    old = _kept(stored.join(_for_lookup(keys, many), "tconst", "left_semi"), "old-rows")
    new, same = changes.real_changes(arriving, old)
    same = _kept(same, "equal-rows")
    new = _kept(new.select(SERVING.fieldNames()), "new-rows")
    change = changes.Replacement(
        old=old.join(same, "tconst", "left_anti"),
        new=new,
        keys=keys.join(same, "tconst", "left_anti"),
    )
    touched = _texts(change.old, "decade") | _texts(new, "decade")
    if not touched:
        return store.commit(base, {}, batch)
    inside, others = _split(base.tables["titles"], touched)
    rows = store.read("titles", SERVING, folders=inside)
    rows = changes.with_changes(rows, _for_lookup(change.keys, many), new)
    staged = _stage_titles(store, rows, layout, bloom_columns)
    tables = {"titles": others + staged}
    remade = store.read("titles", SERVING, folders=staged)
    if "sketches" in base.tables:
        _, others = _split(base.tables["sketches"], touched)
        states = _stage_sketches(store, remade)
    else:  # published before there were sketches
        others = ()
        states = _stage_sketches(store, store.read("titles", SERVING, folders=tables["titles"]))
    tables["sketches"] = others + states

    genres_old, genres_new = _genre_rows(change.old), _genre_rows(new)
    folders = _texts(genres_old, "genre", "decade") | _texts(genres_new, "genre", "decade")
    _, others = _split(base.tables["by_genre"], folders)
    rows = _in_genre_folders(_genre_rows(remade), folders)
    tables["by_genre"] = others + _stage_genres(store, rows)

    top = with_decade(store.read("top_rated", TOP_RATED, base))
    top = top.filter(~F.col("decade").isin([int(d) for (d,) in touched])).drop("decade")
    tables["top_rated"] = _stage_top(store, top.unionByName(marts.top_rated(remade, min_votes)))
    top = store.read("top_rated", TOP_RATED, folders=tables["top_rated"])
    state = changes.rollup_with(
        store.read("rollup", ROLLUP_STATE, base), changes.rollup_delta(change)
    )
    tables["rollup"] = store.stage("rollup", state)
    board, short = changes.board_after(
        store.read("board", BOARD_ROWS, base), change, marts.top_rated(new, min_votes), k, reserve
    )
    # A join here would bring all rows of a type together; the types are few and mostly none.
    if kinds := [r[0] for r in short.collect()]:
        again = changes.board_with_reserve(top.filter(F.col("title_type").isin(kinds)), k, reserve)
        board = board.filter(~F.col("title_type").isin(kinds)).unionByName(again)
    tables["board"] = store.stage("board", board)
    return store.commit(base, tables, batch)
