"""Explicit schemas. Nothing is inferred at ingest."""

from pyspark.sql import types as T


def _strings(*names):
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Column names and their order in the three input files.
RAW_TITLES = _strings(
    "tconst",
    "titleType",
    "primaryTitle",
    "originalTitle",
    "isAdult",
    "startYear",
    "endYear",
    "runtimeMinutes",
    "genres",
)
RAW_RATINGS = _strings("tconst", "averageRating", "numVotes")
RAW_EPISODES = _strings("tconst", "parentTconst", "seasonNumber", "episodeNumber")

# The wide table, in column order.
ENRICHED = T.StructType(
    [
        T.StructField("tconst", T.StringType()),
        T.StructField("title_type", T.StringType()),
        T.StructField("primary_title", T.StringType()),
        T.StructField("original_title", T.StringType()),
        T.StructField("is_adult", T.IntegerType()),
        T.StructField("start_year", T.IntegerType()),
        T.StructField("end_year", T.IntegerType()),
        T.StructField("runtime_minutes", T.IntegerType()),
        T.StructField("genres", T.StringType()),
        T.StructField("average_rating", T.FloatType()),
        T.StructField("num_votes", T.IntegerType()),
        T.StructField("parent_tconst", T.StringType()),
        T.StructField("season_number", T.IntegerType()),
        T.StructField("episode_number", T.IntegerType()),
    ]
)

# The serving table adds its partition column.
SERVING = T.StructType(ENRICHED.fields + [T.StructField("decade", T.IntegerType())])

# Mergeable state of the type x year rollup: sums and counts, never an average.
ROLLUP_STATE = T.StructType(
    [
        T.StructField("title_type", T.StringType()),
        T.StructField("start_year", T.IntegerType()),
        T.StructField("rating_sum", T.DoubleType()),
        T.StructField("total_votes", T.LongType()),
        T.StructField("title_count", T.LongType()),
    ]
)

# Mergeable sketches per decade, type and year: of ratings, title keys and genres.
SKETCHES = T.StructType(
    [
        T.StructField("title_type", T.StringType()),
        T.StructField("start_year", T.IntegerType()),
        T.StructField("rated", T.LongType()),
        T.StructField("rating_sketch", T.BinaryType()),
        T.StructField("title_sketch", T.BinaryType()),
        T.StructField("genre_sketch", T.BinaryType()),
        T.StructField("decade", T.IntegerType()),
    ]
)

# What a job counted: rows of each input file by step, and rows written; one set for each load.
LEDGER = T.StructType(
    [
        T.StructField("load_version", T.IntegerType()),
        T.StructField("input", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)


def _fields(*names):
    return [ENRICHED[name] for name in names]


# Columns of the marts.
TOP_RATED = T.StructType(
    _fields(
        "tconst",
        "title_type",
        "primary_title",
        "start_year",
        "genres",
        "average_rating",
        "num_votes",
    )
)
TITLES_BY_GENRE = T.StructType(
    _fields("tconst", "title_type", "primary_title", "start_year")
    + [T.StructField("genre", T.StringType())]
    + _fields("average_rating", "num_votes", "runtime_minutes")
)
RATINGS_BY_TYPE_YEAR = T.StructType(
    [
        T.StructField("title_type", T.StringType()),
        T.StructField("start_year", T.IntegerType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("total_votes", T.LongType()),
        T.StructField("title_count", T.LongType()),
    ]
)
