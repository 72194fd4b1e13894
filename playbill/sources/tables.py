"""The stored tables: lake, serving table and what lies in their folders."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.functions import decade, readable_size
from playbill.schemas import ENRICHED, SERVING, TITLES_BY_GENRE
from playbill.versions import table_rows


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The lake, with partition values typed by the schema instead of guessed from folders.

    ``path`` is a store, whose newest load is read, or a plain folder.
    """
    return table_rows(spark, path, "lake", ENRICHED).select(ENRICHED.fieldNames())


def read_serving(
    spark: SparkSession, path: str, first_year: int | None = None, last_year: int | None = None
) -> DataFrame:
    """The serving table of a store or a plain folder; a year range also prunes decade folders."""
    table = table_rows(spark, path, "titles", SERVING)
    return years_between(table, first_year, last_year)


def read_by_genre(spark: SparkSession, path: str) -> DataFrame:
    """Title-genre rows; an empty genre has no folder name of its own and is restored here."""
    rows = spark.read.schema(TITLES_BY_GENRE).parquet(path)
    return rows.withColumn("genre", F.coalesce("genre", F.lit("")))


def years_between(
    df: DataFrame, first: int | Column | None = None, last: int | Column | None = None
) -> DataFrame:
    """Keep the years ``first..last`` (either may be open, or a constant expression).

    Where the frame has a ``decade`` column the matching decade predicate is added, because
    Spark cannot derive it from the year predicate and would open every decade folder.
    """
    if first is not None:
        df = df.filter(F.col("start_year") >= first)
    if last is not None:
        df = df.filter(F.col("start_year") <= last)
    if "decade" in df.columns:
        if first is not None:
            df = df.filter(F.col("decade") >= decade(F.lit(first)))
        if last is not None:
            df = df.filter(F.col("decade") <= decade(F.lit(last)))
    return df


def partition_summary(df: DataFrame, partition: str = "decade") -> DataFrame:
    """Files, rows and bytes per partition of a file-backed frame.

    Only the file metadata and the partition value are read, no data column.
    """
    files = (
        df.groupBy(
            F.col(partition).alias("partition"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("bytes"),
        )
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return (
        files.groupBy("partition")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("rows").alias("rows"),
            F.sum("bytes").alias("bytes"),
        )
        .withColumn("size", readable_size("bytes"))
        .orderBy("partition")
    )
