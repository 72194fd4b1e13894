"""Raw text rows to typed, checked rows that are unique on their key."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill import fixed_values as V
from playbill.functions import in_range_or_null, lenient_float, lenient_int, positive_or_null
from playbill.schemas import ENRICHED

KEY_HASH = "_key_hash"


def typed_titles(raw: DataFrame, *carried: str) -> DataFrame:
    """Rename and cast the title columns and keep those ``carried``; nothing is filtered."""
    return raw.select(
        *carried,
        "tconst",
        F.col("titleType").alias("title_type"),
        F.col("primaryTitle").alias("primary_title"),
        F.col("originalTitle").alias("original_title"),
        lenient_int("isAdult").alias("is_adult"),
        lenient_int("startYear").alias("start_year"),
        lenient_int("endYear").alias("end_year"),
        lenient_int("runtimeMinutes").alias("runtime_minutes"),
        "genres",
    )


def typed_ratings(raw: DataFrame, *carried: str) -> DataFrame:
    """Rename and cast the rating columns and keep those ``carried``; nothing is filtered."""
    return raw.select(
        *carried,
        "tconst",
        lenient_float("averageRating").alias("average_rating"),
        lenient_int("numVotes").alias("num_votes"),
    )


def typed_episodes(raw: DataFrame, *carried: str) -> DataFrame:
    """Rename and cast the episode columns and keep those ``carried``; nothing is filtered."""
    return raw.select(
        *carried,
        "tconst",
        F.col("parentTconst").alias("parent_tconst"),
        lenient_int("seasonNumber").alias("season_number"),
        lenient_int("episodeNumber").alias("episode_number"),
    )


def require_key(df: DataFrame, key: str = "tconst", prefix: str | None = None) -> DataFrame:
    """Drop rows without a key, or with a key that does not start with ``prefix``."""
    df = df.filter(F.col(key).isNotNull())
    return df.filter(F.col(key).startswith(prefix)) if prefix else df


def keep_in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Drop rows whose value is given but out of range."""
    return df.filter(in_range_or_null(column, low, high))


def fill_default(df: DataFrame, column: str, default) -> DataFrame:
    """Replace nulls of one column."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def dedupe_by_key(df: DataFrame, key: str = "tconst", keep_hash: bool = False) -> DataFrame:
    """One row per key: the smallest one by all other columns in order, nulls first.

    ``dropDuplicates`` would keep whichever row arrives first and so change from run to run.
    As an aggregate the choice is fixed, and copies of a hot key collapse in the map tasks
    before the shuffle. Grouping by the key's hash as well lets the sorts below the aggregate
    compare numbers instead of texts; ``keep_hash`` passes it on to joins.
    """
    rest = [c for c in df.columns if c != key]
    chosen = df.groupBy(F.xxhash64(key).alias(KEY_HASH), key).agg(
        F.min(F.struct(*rest)).alias("row")
    )
    unpacked = chosen.select(KEY_HASH, key, "row.*")
    return unpacked.select([KEY_HASH, *df.columns] if keep_hash else df.columns)


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, for filters on computed columns of which most rows and columns are used.

    Spark moves a filter below the projection that computes its columns, and so computes them
    again for each mention in the filter. It does not move one below a generator, which has one
    row here for each row; columns that are not used are computed too.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _titles_within(typed, as_of_year):
    rows = require_key(typed, prefix=V.KEY_PREFIX)
    return keep_in_range(rows, "start_year", V.FIRST_YEAR, as_of_year + V.YEARS_AHEAD)


def _ratings_within(typed):
    rows = require_key(typed)
    rows = keep_in_range(rows, "average_rating", V.LOWEST_RATING, V.HIGHEST_RATING)
    return rows.filter(positive_or_null("num_votes"))


def valid_titles(raw: DataFrame, as_of_year: int, *carried: str) -> DataFrame:
    """Typed titles with a valid key and year."""
    return _titles_within(typed_titles(raw, *carried), as_of_year)


def valid_ratings(raw: DataFrame, *carried: str) -> DataFrame:
    """Typed ratings within bounds and with votes."""
    return _ratings_within(typed_ratings(raw, *carried))


def valid_episodes(raw: DataFrame, *carried: str) -> DataFrame:
    """Typed episodes with a key."""
    return require_key(typed_episodes(raw, *carried))


def clean_titles(raw: DataFrame, as_of_year: int, keep_hash: bool = False) -> DataFrame:
    """Typed titles with a valid key and year, unique, genres never null."""
    valid = _titles_within(computed_once(typed_titles(raw)), as_of_year)
    unique = dedupe_by_key(valid, keep_hash=keep_hash)
    return fill_default(unique, "genres", V.UNKNOWN_GENRE)


def clean_ratings(raw: DataFrame, keep_hash: bool = False) -> DataFrame:
    """Typed ratings within bounds and with votes, unique."""
    valid = _ratings_within(computed_once(typed_ratings(raw)))
    return dedupe_by_key(valid, keep_hash=keep_hash)


def clean_episodes(raw: DataFrame, keep_hash: bool = False) -> DataFrame:
    """Typed episodes, unique."""
    return dedupe_by_key(valid_episodes(raw), keep_hash=keep_hash)


def conform(df: DataFrame, schema=ENRICHED) -> DataFrame:
    """Exactly the columns of ``schema``, in its order; missing ones become null."""
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def serving_nulls(df: DataFrame) -> DataFrame:
    """Text columns of the serving table hold no null; empty genres count as unknown."""
    texts = ["title_type", "primary_title", "original_title", "genres"]
    filled = df.na.fill("", subset=texts)
    return filled.withColumn(
        "genres",
        F.when(F.col("genres") == "", F.lit(V.UNKNOWN_GENRE)).otherwise(F.col("genres")),
    )


def left_join_all(left: DataFrame, *others: DataFrame, key: str = "tconst") -> DataFrame:
    """Left-join frames that are unique on ``key``; the left row count is kept.

    Where all frames carry the hash of their dedupe, it joins too: they are then already
    partitioned and sorted as the joins need them, and nothing is shuffled again.
    """
    hashed = all(KEY_HASH in df.columns for df in (left, *others))
    on = [KEY_HASH, key] if hashed else [key]
    joined = reduce(lambda acc, other: acc.join(other, on, "left"), others, left)
    return joined.drop(KEY_HASH)


def enrich(titles: DataFrame, ratings: DataFrame, episodes: DataFrame) -> DataFrame:
    """The wide table: one row per title with its rating and episode data.

    Pass frames cleaned with ``keep_hash`` to spare two shuffles; the result is the same.
    """
    return left_join_all(titles, ratings, episodes).select(ENRICHED.fieldNames())
