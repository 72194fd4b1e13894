"""What a job counted, by input file and step, as rows that are stored with its output.

Observed counts come for free with the pass that writes, but count the rows of a repeated stage
again. The ledger's counts are results of aggregates, to which each task's rows are added once
however often it ran, so they hold when executors are lost. They cost passes of their own over the
input: one that parses no column, and two that read what the checks need.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.schemas import LEDGER

FILE = "__file"
KEY = "tconst"


def with_file(raw: DataFrame) -> DataFrame:
    """Rows of a scan with the name of their file; before any shuffle, which forgets it."""
    return raw.withColumn(FILE, F.col("_metadata.file_name"))


def _counts(rows: DataFrame, step: str) -> DataFrame:
    counted = rows.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select("file", F.lit(step).alias("step"), "rows")


def input_ledger(name: str, raw: DataFrame, valid: DataFrame) -> DataFrame:
    """Rows ``read`` from each file, of them ``valid`` ones, and of these the ``kept`` ones.

    Both frames have the column of ``with_file``. A key that lies in several files is kept once
    and counts for the first of them by name, so the files' counts add up to those of the input.
    A file without rows has no entry, one of which nothing is valid has only what was read.
    """
    first = valid.groupBy(F.xxhash64(KEY), KEY).agg(F.min(FILE).alias(FILE))
    steps = [_counts(raw, "read"), _counts(valid, "valid"), _counts(first, "kept")]
    return reduce(DataFrame.unionByName, steps).withColumn("input", F.lit(name))


def output_ledger(name: str, written: DataFrame) -> DataFrame:
    """Rows of a written table, from the written files."""
    counted = written.agg(F.count(F.lit(1)).alias("rows"))
    nothing = F.lit(None).cast("string").alias("file")
    return counted.select(nothing, F.lit("written").alias("step"), "rows", F.lit(name).alias("input"))


def ledger_rows(version: int, *parts: DataFrame) -> DataFrame:
    """The entries of one load; a few for each input file."""
    whole = reduce(DataFrame.unionByName, parts)
    return whole.withColumn("load_version", F.lit(version)).select(LEDGER.fieldNames())


def step_totals(ledger: DataFrame) -> DataFrame:
    """Rows by load, input and step, added up over files."""
    return ledger.groupBy("load_version", "input", "step").agg(F.sum("rows").alias("rows"))
