"""Steps of jobs leave no shuffle files. They run in a process of their own: local mode's only block
manager is lost to the session for good once another test has taken map outputs away."""

import os
import subprocess
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    disk = spark._jsc.sc().env().blockManager().diskBlockManager()
    found = disk.getAllFiles().mkString("\n").split("\n")
    return {f for f in found if os.path.basename(f).startswith("shuffle_")}


def steps(spark, titles, path):
    from playbill.plans import refresh
    from playbill.sinks import ensure_tables, load_titles, write_serving
    from playbill.sinks.folders import serving_layout
    from playbill.versions import Store

    ensure_tables(spark, "released_db", f"{path}/db")
    rows = serving_layout(titles)
    return {
        "folder": lambda: write_serving(titles, f"{path}/folder"),
        "store": lambda: Store(spark, f"{path}/store").stage("titles", rows, ("decade",)),
        "table": lambda: load_titles(titles, "released_db.titles_enriched"),
        "kept": lambda: refresh._kept(titles.groupBy("start_year").count(), "years"),
        "folders": lambda: refresh._texts(titles, "decade"),
    }


def main(path):
    from pyspark.sql import SparkSession
    from test_storage import wide_rows

    from playbill.sinks.folders import serving_rows

    conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": f"{path}/warehouse", "spark.local.dir": f"{path}/local"}
    spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
    rows = [(f"tt{i}", "movie", 1980 + i % 40, "A", 5.0, i) for i in range(200)]
    titles = serving_rows(wide_rows(spark, rows))
    for name, run in steps(spark, titles, path).items():
        before = shuffle_files(spark)
        run()
        for _ in range(50):  # they go in another thread
            if not (left := shuffle_files(spark) - before):
                break
            time.sleep(0.1)
        print("step", name, len(left), spark.conf.get(RELEASE))
    before = shuffle_files(spark)
    titles.groupBy("start_year").count().collect()
    print("step", "other", len(shuffle_files(spark) - before) > 0, spark.conf.get(RELEASE))
    spark.stop()


@pytest.fixture(scope="module")
def said(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("released"))
    run = subprocess.run(
        [sys.executable, __file__, path], capture_output=True, text=True, timeout=300, cwd=path
    )
    assert run.returncode == 0, run.stderr[-2000:]
    return dict(line.split()[1:3] for line in run.stdout.splitlines() if line.startswith("step")), run


@pytest.mark.parametrize("name", ["folder", "store", "table", "kept", "folders"])
def test_steps_of_jobs_leave_no_shuffle_files(said, name):
    assert said[0][name] == "0"


def test_the_setting_of_the_session_stays(said):
    lines = [x for x in said[1].stdout.splitlines() if x.startswith("step")]
    assert {x.split()[3] for x in lines} == {"false"} and said[0]["other"] == "True"


if __name__ == "__main__":
    main(sys.argv[1])
