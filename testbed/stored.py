"""Tables the checks share: each is built once per session and input folder, by the library."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from playbill.plans.pipeline import wide_table
from playbill.plans.refresh import apply_changes, publish
from playbill.schemas import ENRICHED
from playbill.session import fresh_path
from playbill.sinks import write_serving
from playbill.sources import read_serving
from playbill.versions import is_store
from testbed.catalog_fixture import AS_OF_YEAR, raw_frames

_paths: dict[tuple[str, ...], str] = {}


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table, computed from the input whenever it is used."""
    return wide_table(*raw_frames(spark, sf_dir), AS_OF_YEAR)


def serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving table over the whole input, written to the shared folder on first use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _paths:
        try:
            return read_serving(spark, _paths[key])
        except AnalysisException:
            del _paths[key]
    path = fresh_path(spark, "serving")
    write_serving(enriched(spark, sf_dir), path)
    _paths[key] = path
    return read_serving(spark, path)


def changed_titles(titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(changed rows, keys of removed ones): a fortieth of all titles each, by their numbers.

    Doubled votes that the column does not hold are null, as votes in the input are.
    """
    number = F.substring("tconst", 4, 20).cast("long")
    changed = titles.filter(number % 40 == 0).withColumns(
        {
            "start_year": (F.coalesce("start_year", F.lit(1950)) + 10).cast("int"),
            "num_votes": F.try_multiply("num_votes", F.lit(2)),
            "genres": F.lit("Drama,Moved"),
        }
    )
    return changed.select(ENRICHED.fieldNames()), titles.filter(number % 40 == 7).select("tconst")


def changed_store(spark: SparkSession, sf_dir: str) -> str:
    """A store of all titles after a batch of changes that is delivered twice.

    The second delivery brings the rows as they were, under the same name: it is to be ignored.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "changed")
    if key not in _paths or not is_store(spark, _paths[key]):
        titles, path = serving(spark, sf_dir), fresh_path(spark, "store")
        publish(spark, path, titles.select(ENRICHED.fieldNames()))
        changed, removed = changed_titles(titles)
        apply_changes(spark, path, changed, removed, batch="moves")
        apply_changes(spark, path, titles.select(ENRICHED.fieldNames()), batch="moves")
        _paths[key] = path
    return _paths[key]
