"""Catalog tables for SQL users."""

from pyspark.sql import DataFrame, SparkSession

from playbill.schemas import (
    ENRICHED,
    RATINGS_BY_TYPE_YEAR,
    SERVING,
    TITLES_BY_GENRE,
    TOP_RATED,
)
from playbill.session import bounded_tasks
from playbill.sinks.folders import (
    genre_layout,
    leaderboard_layout,
    serving_layout,
    serving_rows,
)

# Table names and what they are partitioned by.
TABLES = {
    "titles_enriched": (SERVING, "decade"),
    "ratings_by_type_year": (RATINGS_BY_TYPE_YEAR, None),
    "top_rated": (TOP_RATED, None),
    "titles_by_genre": (TITLES_BY_GENRE, "genre"),
}


def ensure_tables(spark: SparkSession, database: str, location: str) -> list[str]:
    """Create the database and its tables where they do not exist; returns the table names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    names = []
    for table, (schema, partition) in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        by = f" PARTITIONED BY ({partition})" if partition else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet"
            f"{by} LOCATION '{location}/{table}'"
        )
        names.append(f"{database}.{table}")
    return names


def load_table(df: DataFrame, table: str) -> None:
    """Replace a table's rows; columns are matched by name."""
    spark = df.sparkSession
    rows = df.select(spark.table(table).columns)
    with bounded_tasks(spark):
        rows.write.mode("overwrite").insertInto(table)


def load_titles(df: DataFrame, table: str) -> None:
    """Replace the rows of a serving table in the catalog, in the serving layout."""
    load_table(serving_layout(serving_rows(df.select(ENRICHED.fieldNames()))), table)


def load_leaderboard(top: DataFrame, table: str) -> None:
    """Replace the rows of a leaderboard table, in the leaderboard's order."""
    load_table(leaderboard_layout(top), table)


def load_by_genre(titles: DataFrame, table: str) -> None:
    """Replace the title-genre rows of a table, in their layout."""
    load_table(genre_layout(titles), table)
