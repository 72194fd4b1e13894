"""The corpus pipeline: documents to packed sequences, in stages that are stored between.

Each stage takes the rows that the one before kept, with all columns of documents, and its
decisions take effect: what it rejects is gone, what it rewrites stays rewritten.
"""

from pyspark.sql import DataFrame, SparkSession

from playbill.llm import fingerprints, packing, quality_model, rule_cascade, surrogates
from playbill.llm.registered import BYTE_BPE, SURROGATE_KEY
from playbill.llm.support import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on the labels, predicts good."""
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def within_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return rule_cascade.keep_good(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id."""
    return fingerprints.one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in the place of personal data."""
    return surrogates.replace_entities(docs, SURROGATE_KEY)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens as pieces of sequences."""
    return packing.pack_documents(docs, BYTE_BPE)


STAGES = [
    ("quality classifier", good_quality),
    ("quality rules", within_rules),
    ("SimHash near-dedup", without_near_duplicates),
    ("PII surrogates", without_personal_data),
    ("packing", packed),
]
#: The classifier, fingerprints and tokens are beyond SQL; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
