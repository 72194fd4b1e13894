import gzip
import os
from types import SimpleNamespace

import pytest
from conftest import (
    AS_OF_YEAR,
    CHILD,
    EPISODE_ROWS,
    KEPT_EPISODES,
    KEPT_RATINGS,
    KEPT_TITLES,
    RATING_ROWS,
    SERIES,
    TITLE_ROWS,
)
from pyspark.sql import functions as F

from playbill import fixed_values as V
from playbill import session
from playbill.__main__ import show_rows
from playbill.operators import marts
from playbill.operators.cleaning import conform
from playbill.plans.pipeline import build_lake, counted, load_serving, read_rollup
from playbill.schemas import ENRICHED, RAW_EPISODES, RAW_RATINGS, RAW_TITLES
from playbill.session import clear_intermediates, fresh_path, shared_folder, size_shuffles
from playbill.sinks.folders import serving_layout, serving_rows
from playbill.sinks import (
    ensure_tables,
    load_table,
    load_titles,
    write_by_genre,
    write_lake,
    write_leaderboard,
    write_rollup,
    write_serving,
)
from playbill.sources import (
    partition_summary,
    read_by_genre,
    read_delimited,
    read_lake,
    read_raw,
    read_serving,
    years_between,
)
from playbill.versions import Store
from testbed.catalog_fixture import write_delimited


def tsv(schema, rows):
    lines = ["\t".join(schema.fieldNames())]
    lines += ["\t".join("\\N" if v is None else v for v in row) for row in rows]
    return "\n".join(lines) + "\n"


INPUT = {
    "title.basics.tsv": tsv(RAW_TITLES, [r for r in TITLE_ROWS if r[0]]),
    "title.ratings.tsv": tsv(RAW_RATINGS, [r for r in RATING_ROWS if r[0]]),
    "title.episode.tsv": tsv(RAW_EPISODES, [r for r in EPISODE_ROWS if r[0]]),
}


def write_input(folder, zipped=False):
    for name, text in INPUT.items():
        if zipped:
            with gzip.open(os.path.join(folder, name + ".gz"), "wt") as out:
                out.write(text)
        else:
            with open(os.path.join(folder, name), "w") as out:
                out.write(text)
    return str(folder)


def wide_rows(spark, rows):
    names = ["tconst", "title_type", "start_year", "genres", "average_rating", "num_votes"]
    return conform(
        spark.createDataFrame(
            rows,
            "tconst string, title_type string, start_year int, genres string,"
            " average_rating float, num_votes int",
        ).toDF(*names)
    )


def folders(path):
    return sorted(d for d in os.listdir(path) if "=" in d)


def parquet_files(path):
    return [
        os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")
    ]


def test_quotes_backslashes_and_nulls_are_read_as_they_are(spark, tmp_path):
    path = tmp_path / "r.tsv"
    path.write_text('tconst\taverageRating\tnumVotes\n"tt1"\t"8\t\\N\ntt2\ta\\b\t\n')
    rows = [tuple(r) for r in read_delimited(spark, str(path), RAW_RATINGS).collect()]
    assert rows == [('"tt1"', '"8', None), ("tt2", "a\\b", None)]


def test_gzip_input_equals_plain_input(spark, tmp_path):
    plain, zipped = tmp_path / "plain", tmp_path / "zipped"
    plain.mkdir()
    zipped.mkdir()
    left = read_raw(spark, write_input(plain))
    right = read_raw(spark, write_input(zipped, zipped=True), suffix=".gz", spread=True)
    for a, b in zip(left, right):
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0


def test_jobs_end_to_end(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_input(raw)
    lake, serving, rollup = (str(tmp_path / n) for n in ("lake", "serving", "rollup"))

    outcome = build_lake(spark, str(raw), lake, AS_OF_YEAR)
    given = {"titles": TITLE_ROWS, "ratings": RATING_ROWS, "episodes": EPISODE_ROWS}
    kept = {"titles": KEPT_TITLES, "ratings": KEPT_RATINGS, "episodes": KEPT_EPISODES}
    count = len(KEPT_TITLES)
    rated = {r[0] for r in RATING_ROWS if r[1] != "text"} & set(KEPT_RATINGS) & set(KEPT_TITLES)
    assert outcome.rows_read == {n: sum(bool(r[0]) for r in rows) for n, rows in given.items()}
    assert outcome.rows_kept == {n: len(keys) for n, keys in kept.items()}
    assert outcome.rows == count
    summary = outcome.summary.first()
    assert (summary["min_year"], summary["max_year"]) == (1874, AS_OF_YEAR + 5)
    assert (summary["rated"], summary["with_parent"]) == (len(rated), 1)
    assert outcome.types.first()["title_type"] == "movie"

    loaded = load_serving(spark, lake, serving, rollup)
    assert loaded.rows == count
    assert sum(r["rows"] for r in loaded.partitions.collect()) == count
    assert {r["title_type"]: r["cnt"] for r in loaded.types.collect()}["movie"] == count - 2
    assert read_rollup(spark, rollup).agg(F.sum("title_count")).first()[0] == len(rated)


def test_load_fails_on_a_broken_file(spark, tmp_path, enriched):
    lake = str(tmp_path / "lake")
    write_lake(enriched, lake)
    with open(parquet_files(lake)[0], "r+b") as broken:
        broken.truncate(20)
    for crc in (f for d, _, fs in os.walk(lake) for f in [os.path.join(d, x) for x in fs]):
        if crc.endswith(".crc"):
            os.remove(crc)
    with pytest.raises(Exception):
        load_serving(spark, lake, str(tmp_path / "serving"))


def test_lake_layout_and_types(spark, tmp_path, enriched):
    path = str(tmp_path / "lake")
    write_lake(enriched, path)
    assert folders(path) == [
        "title_type=movie",
        "title_type=tvEpisode",
        "title_type=tvSeries",
    ]
    assert folders(f"{path}/title_type=tvSeries") == ["start_year=1950"]
    assert all(f.endswith(".snappy.parquet") for f in parquet_files(path))
    back = read_lake(spark, path)
    assert back.schema == ENRICHED
    assert back.exceptAll(enriched).count() == 0 and back.count() == len(KEPT_TITLES)


def test_titles_without_year_or_type_reach_the_serving_table(spark, tmp_path):
    df = wide_rows(
        spark,
        [
            ("tt1", "movie", None, "Drama", 5.0, 10),
            ("tt2", None, 1994, None, 6.0, 20),
            ("tt3", "007", 1999, "Action", None, None),
        ],
    )
    lake, serving = str(tmp_path / "lake"), str(tmp_path / "serving")
    write_lake(df, lake)
    assert load_serving(spark, lake, serving).rows == 3
    rows = {r["tconst"]: r for r in read_serving(spark, serving).collect()}
    assert rows["tt1"]["start_year"] is None and rows["tt1"]["decade"] == 0
    assert rows["tt2"]["title_type"] == "" and rows["tt2"]["genres"] == "Unknown"
    assert rows["tt3"]["title_type"] == "007" and rows["tt3"]["decade"] == 1990


def test_partition_refresh_replaces_only_the_given_folders(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = [("tt1", "movie", 1990, "A", 5.0, 1), ("tt2", "short", 1990, "A", 5.0, 1)]
    write_lake(wide_rows(spark, rows), path)
    write_lake(wide_rows(spark, [("tt9", "movie", 1990, "B", 1.0, 1)]), path, refresh="partitions")
    assert sorted(r["tconst"] for r in read_lake(spark, path).collect()) == ["tt2", "tt9"]
    write_lake(wide_rows(spark, [("tt9", "movie", 1990, "B", 1.0, 1)]), path)
    assert [r["tconst"] for r in read_lake(spark, path).collect()] == ["tt9"]
    with pytest.raises(ValueError):
        write_lake(wide_rows(spark, rows), path, refresh="some")


def test_serving_rows_are_sorted_and_years_prune_folders(spark, tmp_path):
    rows = [
        (f"tt{i:04d}", ["movie", "short"][i % 2], 1950 + i % 70, "A,B", 5.0, i) for i in range(500)
    ]
    path = str(tmp_path / "serving")
    write_serving(wide_rows(spark, rows), path, bloom_columns=("tconst",))
    for file in parquet_files(path):
        keys = [
            tuple(r)
            for r in spark.read.parquet(file).select("title_type", "start_year", "tconst").collect()
        ]
        assert keys == sorted(keys)

    some = years_between(read_serving(spark, path), 1991, 2004)
    assert some.count() == len([r for r in rows if 1991 <= r[2] <= 2004])
    scan = some._jdf.queryExecution().executedPlan().toString()
    pruned = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 1990" in pruned and "<= 2000" in pruned
    assert len(some.inputFiles()) > 0
    assert read_serving(spark, path, first_year=2000).filter("start_year < 2000").count() == 0


def test_serving_write_sorts_once(spark, tmp_path):
    from playbill.sinks.folders import serving_layout, serving_rows

    path = str(tmp_path / "serving")
    df = wide_rows(spark, [("tt1", "movie", 1990, "A", 5.0, 1)])
    laid_out = serving_layout(serving_rows(df))
    laid_out.createOrReplaceTempView("laid_out")
    plan = spark.sql("explain select * from laid_out").first()[0]
    assert plan.count("Sort [") == 1 and "REBALANCE_PARTITIONS_BY_COL" in plan
    write_serving(df, path)
    assert read_serving(spark, path).count() == 1


def test_a_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("tt"), F.col("id")).alias("tconst"),
        F.lit("tvEpisode").alias("title_type"),
        F.lit(1999).alias("start_year"),
        F.sha2(F.col("id").cast("string"), 256).alias("primary_title"),
    )
    path = str(tmp_path / "lake")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(256 * 1024))
    try:
        write_lake(conform(rows), path)
    finally:
        spark.conf.set(name, before)
    assert len(parquet_files(path)) > 3
    assert read_lake(spark, path).count() == 60000


@pytest.mark.parametrize("how", ["folder", "store", "table"])
def test_tasks_of_a_write_are_bounded(spark, tmp_path, monkeypatch, how):
    """Whatever sizes the session has; its own settings are back afterwards, and smaller ones stay."""
    sizes = {
        "spark.sql.files.maxPartitionBytes": 128 * 1024,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": 256 * 1024,
    }
    monkeypatch.setattr(session, "TASK_BYTES", sizes, raising=False)
    before = {name: spark.conf.get(name) for name in sizes}
    title = F.sha2(F.col("id").cast("string"), 256)
    key = F.concat(F.lit("tt"), F.col("id")).alias("tconst")
    rows = spark.range(0, 60000, 1, 8).select(
        key, F.lit("tvEpisode").alias("title_type"), F.lit(1999).alias("start_year"),
        title.alias("primary_title"),
    )
    conform(rows).coalesce(1).write.option("parquet.block.size", 256 * 1024).parquet(str(tmp_path / "in"))
    rows = spark.read.schema(ENRICHED).parquet(str(tmp_path / "in"))
    path = str(tmp_path / "out")
    if how == "folder":
        write_lake(rows, path)
    elif how == "store":
        Store(spark, path).stage("titles", serving_layout(serving_rows(rows)), ("decade",))
    else:
        ensure_tables(spark, "bounded_db", path)
        load_titles(rows, "bounded_db.titles_enriched")
        files = spark.table("bounded_db.titles_enriched").inputFiles()
        spark.sql("DROP DATABASE bounded_db CASCADE")
    assert {name: spark.conf.get(name) for name in sizes} == before
    assert len(files if how == "table" else parquet_files(path)) > 3
    with session.bounded_tasks(spark):
        assert {name: spark.conf.get(name) for name in sizes} == {n: str(x) for n, x in sizes.items()}
    name = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(name, "64k")
    try:
        with session.bounded_tasks(spark):
            assert spark.conf.get(name) == "64k"
    finally:
        spark.conf.set(name, before[name])


def test_compressed_raw_text_in_bounded_files_gives_the_same_rows(spark, tmp_path, titles_raw):
    path = str(tmp_path / "raw")
    write_delimited(titles_raw.coalesce(1), path, "gzip", 3)
    files = [f for f in os.listdir(path) if f.endswith(".csv.gz")]
    assert len(files) == -(-titles_raw.count() // 3) > 1
    found = read_delimited(spark, path, RAW_TITLES)
    assert sorted(map(str, found.collect())) == sorted(map(str, titles_raw.collect()))


def test_partition_summary_matches_the_files(spark, tmp_path):
    rows = [(f"tt{i}", "movie", 1980 + i % 40, "A", 5.0, i) for i in range(200)]
    path = str(tmp_path / "serving")
    write_serving(wide_rows(spark, rows), path)
    found = {r["partition"]: r for r in partition_summary(read_serving(spark, path)).collect()}
    assert sorted(found) == [1980, 1990, 2000, 2010]
    assert sum(r["rows"] for r in found.values()) == 200
    for decade, row in found.items():
        files = parquet_files(f"{path}/decade={decade}")
        assert row["files"] == len(files)
        assert row["bytes"] == sum(os.path.getsize(f) for f in files)
        assert row["size"].endswith(" MiB")


def test_marts_round_trip(spark, tmp_path):
    rows = [(f"tt{i}", "movie", 1990, "Drama,,Crime", i % 10 + 0.5, i * 1000) for i in range(100)]
    df = wide_rows(spark, rows)

    board = str(tmp_path / "board")
    write_leaderboard(marts.top_rated(df, min_votes=50000), board)
    top = spark.read.parquet(board).collect()
    assert len(top) == len([r for r in rows if r[4] is not None and r[5] >= 50000])
    for file in parquet_files(board):
        ratings = [r[0] for r in spark.read.parquet(file).select("average_rating").collect()]
        assert ratings == sorted(ratings, reverse=True)

    genres = str(tmp_path / "genres")
    write_by_genre(marts.titles_by_genre(df), genres)
    back = read_by_genre(spark, genres)
    counts = {r["genre"]: r["count"] for r in back.groupBy("genre").count().collect()}
    assert counts == {"Drama": 100, "": 100, "Crime": 100}


def test_rollup_merge_equals_recomputation(spark, tmp_path):
    rows = [
        (f"tt{i}", ["movie", "short"][i % 2], None if i % 9 == 0 else 1990 + i % 5, "A",
         None if i % 7 == 0 else (i % 90) / 10, None if i % 5 == 0 else i)
        for i in range(400)
    ]
    old, new = wide_rows(spark, rows[:250]), wide_rows(spark, rows[250:])
    path = str(tmp_path / "state")
    write_rollup(marts.rollup_state(old), path)
    merged = marts.merge_rollup(spark.read.parquet(path), marts.rollup_state(new))
    found = {tuple(r)[:2]: tuple(r)[2:] for r in marts.rollup_view(merged).collect()}
    full = marts.ratings_rollup(wide_rows(spark, rows))
    expected = {tuple(r)[:2]: tuple(r)[2:] for r in full.collect()}
    assert found.keys() == expected.keys()
    for key, (rating, votes, count) in expected.items():
        assert found[key][0] == pytest.approx(rating) and found[key][1:] == (votes, count)
    assert ("movie", 0) in expected


def test_catalog_tables(spark, tmp_path):
    location = str(tmp_path / "db")
    names = ensure_tables(spark, "playbill_test", location)
    assert ensure_tables(spark, "playbill_test", location) == names and len(names) == 4
    df = wide_rows(spark, [("tt1", "movie", 1994, "A,B", 9.0, 60000), ("tt2", "m", None, None, 1.0, 1)])
    for _ in range(2):
        load_titles(df, "playbill_test.titles_enriched")
        load_table(marts.ratings_rollup(df), "playbill_test.ratings_by_type_year")
        load_table(marts.top_rated(df), "playbill_test.top_rated")
        load_table(marts.titles_by_genre(df), "playbill_test.titles_by_genre")
    counts = [spark.table(n).count() for n in names]
    assert counts == [2, 2, 1, 2]
    years = "select tconst from playbill_test.titles_enriched where decade = 1990"
    assert [r[0] for r in spark.sql(years).collect()] == ["tt1"]


def test_views(spark, enriched):
    names = marts.register_views(enriched, AS_OF_YEAR, prefix="t_")
    counts = [spark.sql(f"select * from {n}").count() for n in names]
    assert counts == [len(KEPT_TITLES), len(KEPT_TITLES) - 2, 1, 0]
    many = enriched.withColumn("num_votes", F.lit(V.RECENT_MIN_VOTES + 1))
    recent = marts.recent_popular(many, as_of_year=1954)
    assert {SERIES, CHILD} <= {r["tconst"] for r in recent.collect()}
    few = many.withColumn("num_votes", F.lit(V.RECENT_MIN_VOTES))
    assert marts.recent_popular(few, as_of_year=1954).count() == 0


def test_row_counts_come_with_the_pass(spark, enriched):
    df, seen = counted(enriched, "enriched rows")
    df.collect()
    assert seen.get == {"rows": len(KEPT_TITLES)}


def test_intermediates_go_to_the_shared_folder_and_are_cleared(spark, tmp_path):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(folder)
    path = fresh_path(spark, "x")
    assert path.startswith(folder) and path != fresh_path(spark, "x")
    spark.range(3).write.parquet(path)
    clear_intermediates(spark)
    assert not os.path.exists(path)


def test_without_a_shared_folder_the_warehouse_is_used():
    settings = {"spark.sql.warehouse.dir": "hdfs://warehouse/"}
    bare = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)),
        sparkContext=SimpleNamespace(applicationId="app-1"),
    )
    assert shared_folder(bare) == "hdfs://warehouse/playbill/app-1"


@pytest.mark.parametrize("empty", ["titles", "ratings", "episodes"])
@pytest.mark.parametrize("how", ["header only", "all filtered out"])
def test_lake_job_on_an_input_without_rows(spark, tmp_path, empty, how):
    title = "\t".join(("k", "movie", "a", "a", "0", "1990", "\\N", "90", "X"))
    body = {
        "titles": [title.replace("k", "tt1", 1)],
        "ratings": ["tt1\t5.0\t9"],
        "episodes": ["tt1\ttt2\t1\t1"],
    }
    bad = {"titles": [title], "ratings": ["tt1\t99.0\t9"], "episodes": ["\\N\ttt2\t1\t1"]}
    body[empty] = [] if how == "header only" else bad[empty]
    schemas = {"titles": RAW_TITLES, "ratings": RAW_RATINGS, "episodes": RAW_EPISODES}
    files = {"titles": V.TITLES_FILE, "ratings": V.RATINGS_FILE, "episodes": V.EPISODES_FILE}
    for name, schema in schemas.items():
        lines = ["\t".join(schema.fieldNames()), *body[name]]
        (tmp_path / files[name]).write_text("\n".join(lines) + "\n")
    outcome = build_lake(spark, str(tmp_path), str(tmp_path / "lake"), 2026)
    assert outcome.rows_read == {n: len(rows) for n, rows in body.items()}
    assert outcome.rows_kept == {n: 0 if n == empty else 1 for n in body}
    assert outcome.rows == (0 if empty == "titles" else 1) == outcome.summary.first()["total"]


def test_all_rows_of_a_report_are_printed(spark, capsys):
    assert show_rows(spark.range(257).toDF("n")) == 257
    assert len(capsys.readouterr().out.splitlines()) == 258
    assert show_rows(spark.range(257), most=5) == 257
    assert capsys.readouterr().out.splitlines()[-1] == "(5 of 257 rows)"


def test_shuffles_are_sized_by_the_input(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 1000)
    (tmp_path / "folder").mkdir()
    with open(tmp_path / "folder" / "b", "wb") as sparse:
        sparse.truncate(100 * 128 * 1024 * 1024 - 999)
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        small = spark.sparkContext.defaultParallelism
        assert size_shuffles(spark, str(tmp_path / "a")) == small
        assert spark.conf.get(name) == str(small)
        assert size_shuffles(spark, str(tmp_path)) == 101
    finally:
        spark.conf.set(name, before)
