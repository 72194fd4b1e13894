"""Tab-separated input files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from playbill import fixed_values as V
from playbill.schemas import RAW_EPISODES, RAW_RATINGS, RAW_TITLES


def read_delimited(
    spark: SparkSession, path: str, schema: StructType, spread: bool = False
) -> DataFrame:
    r"""Scan a header-led, tab-separated file or folder; ``\N`` is null, quotes are literal.

    ``.gz`` files are opened as they are. Such a file cannot be split, so one file is one
    task: give the input as many files, and set ``spread`` to share the parsed rows of a few
    big ones out over the cluster before further work.
    """
    rows = (
        spark.read.options(header=True, sep="\t", nullValue=V.NULL_MARKER, quote="")
        .schema(schema)
        .csv(path)
    )
    return rows.hint("rebalance") if spread else rows


def read_raw(spark: SparkSession, folder: str, suffix: str = "", spread: bool = False):
    """The three raw frames (titles, ratings, episodes) of a folder; ``suffix`` may be '.gz'."""
    files = (
        (V.TITLES_FILE, RAW_TITLES),
        (V.RATINGS_FILE, RAW_RATINGS),
        (V.EPISODES_FILE, RAW_EPISODES),
    )
    return tuple(
        read_delimited(spark, f"{folder}/{name}{suffix}", schema, spread) for name, schema in files
    )
