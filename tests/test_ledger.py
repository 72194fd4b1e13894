"""The job ledger: counts by file and step that repeated work does not change."""

import os

import pytest
from pyspark.sql import functions as F

from playbill import fixed_values as V
from playbill.operators.cleaning import valid_ratings
from playbill.operators.ledger import FILE, input_ledger, step_totals, with_file
from playbill.plans import pipeline
from playbill.plans.pipeline import build_lake, read_ledger
from playbill.schemas import RAW_EPISODES, RAW_RATINGS, RAW_TITLES
from playbill.sources import read_delimited
from playbill.versions import Store


def write_files(folder, name, schema, files):
    os.makedirs(f"{folder}/{name}", exist_ok=True)
    for file, lines in files.items():
        with open(f"{folder}/{name}/{file}", "w") as out:
            out.write("\n".join(["\t".join(schema.fieldNames()), *lines]) + "\n")


def title(key, year="1990"):
    return f"{key}\tmovie\ta\ta\t0\t{year}\t\\N\t90\tX"


def make_input(folder):
    """Copies within and across files, rows that are not valid, and a file without rows."""
    titles = {
        "a.tsv": [title("tt1"), title("tt1"), title("tt2"), title("k3"), title("\\N")],
        "b.tsv": [title("tt1"), title("tt3"), title("tt4", "1200")],
        "c.tsv": [],
    }
    ratings = {"a.tsv": ["tt1\t5.0\t9", "tt2\t99.0\t9", "tt3\t5.0\t0"], "b.tsv": ["tt9\t1.0\t1"]}
    write_files(folder, V.TITLES_FILE, RAW_TITLES, titles)
    write_files(folder, V.RATINGS_FILE, RAW_RATINGS, ratings)
    write_files(folder, V.EPISODES_FILE, RAW_EPISODES, {"a.tsv": ["tt1\ttt2\t1\t1"]})


EXPECTED = {
    ("titles", "a.tsv", "read", 5),
    ("titles", "b.tsv", "read", 3),
    ("titles", "a.tsv", "valid", 3),
    ("titles", "b.tsv", "valid", 2),
    ("titles", "a.tsv", "kept", 2),
    ("titles", "b.tsv", "kept", 1),
    ("ratings", "a.tsv", "read", 3),
    ("ratings", "b.tsv", "read", 1),
    ("ratings", "a.tsv", "valid", 1),
    ("ratings", "b.tsv", "valid", 1),
    ("ratings", "a.tsv", "kept", 1),
    ("ratings", "b.tsv", "kept", 1),
    ("episodes", "a.tsv", "read", 1),
    ("episodes", "a.tsv", "valid", 1),
    ("episodes", "a.tsv", "kept", 1),
    ("lake", None, "written", 3),
}


def entries(ledger, version):
    rows = ledger.filter(F.col("load_version") == version).drop("load_version")
    return [tuple(r) for r in rows.collect()]


def test_each_load_adds_its_counts_by_file_and_step(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    make_input(raw)
    outcome = build_lake(spark, raw, lake, 2026, ledger=True)
    found = entries(read_ledger(spark, lake), 0)
    assert len(found) == len(EXPECTED) and set(found) == EXPECTED
    assert outcome.rows_read == {"titles": 8, "ratings": 4, "episodes": 1}
    assert outcome.rows_kept == {"titles": 3, "ratings": 2, "episodes": 1}
    assert outcome.rows == 3 == outcome.summary.first()["total"]

    build_lake(spark, raw, lake, 2026)  # keeps no ledger, and that of the load before
    write_files(raw, V.TITLES_FILE, RAW_TITLES, {"d.tsv": [title("tt8")]})
    build_lake(spark, raw, lake, 2026, spread=True, ledger=True)
    ledger = read_ledger(spark, lake)
    assert set(entries(ledger, 0)) == EXPECTED and not entries(ledger, 1)
    assert ("titles", "d.tsv", "kept", 1) in entries(ledger, 2)
    totals = {tuple(r) for r in step_totals(ledger).collect()}
    assert (0, "titles", "kept", 3) in totals and (2, "lake", "written", 4) in totals


def test_a_load_that_fails_leaves_no_counts(spark, tmp_path, monkeypatch):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    make_input(raw)
    build_lake(spark, raw, lake, 2026, ledger=True)
    before = Store(spark, lake).snapshot()
    monkeypatch.setattr(pipeline, "output_ledger", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build_lake(spark, raw, lake, 2026, ledger=True)
    assert Store(spark, lake).snapshot() == before
    assert set(entries(read_ledger(spark, lake), 0)) == EXPECTED


def test_a_lake_without_a_ledger_or_rows(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    make_input(raw)
    build_lake(spark, raw, lake, 2026)
    assert read_ledger(spark, lake).count() == 0
    for name, schema in ((V.TITLES_FILE, RAW_TITLES), (V.RATINGS_FILE, RAW_RATINGS),
                         (V.EPISODES_FILE, RAW_EPISODES)):
        write_files(str(tmp_path / "none"), name, schema, {"a.tsv": []})
    outcome = build_lake(spark, str(tmp_path / "none"), str(tmp_path / "empty"), 2026, ledger=True)
    assert outcome.rows == 0 and set(outcome.rows_read.values()) == {0}
    assert entries(read_ledger(spark, str(tmp_path / "empty")), 0) == [("lake", None, "written", 0)]


def test_counts_are_the_same_after_a_stage_has_run_twice(spark, tmp_path):
    """The outputs of the map tasks are lost between two runs, so their stages are run again."""
    raw = str(tmp_path / "raw")
    make_input(raw)
    ratings = with_file(read_delimited(spark, f"{raw}/{V.RATINGS_FILE}", RAW_RATINGS))
    context = spark.sparkContext
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = input_ledger("ratings", ratings, valid_ratings(ratings, FILE)).rdd
        first = sorted(map(tuple, rows.collect()))
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = disk.getAllFiles()
        for at in range(files.size()):
            path = files.apply(at).getPath()
            if os.path.basename(path).startswith("shuffle_"):
                os.remove(path)
        context.setJobGroup("again", "lost outputs")
        second = sorted(map(tuple, rows.collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("again") for s in tracker.getJobInfo(j).stageIds]
    infos = [i for i in map(tracker.getStageInfo, stages) if i]
    assert any(i.currentAttemptId > 0 for i in infos)
    assert first == second and len(first) == 6
