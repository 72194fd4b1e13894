"""Versioned tables: refreshes that fail or compete, and loads of changes against whole loads."""

import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_storage import parquet_files, wide_rows

from playbill.operators import changes, marts
from playbill.operators.cleaning import conform
from playbill.plans import refresh
from playbill.plans.pipeline import load_serving, read_rollup
from playbill.plans.refresh import apply_changes, publish, read_mart
from playbill.schemas import ENRICHED, SERVING
from playbill.sinks import write_lake, write_serving
from playbill.sinks.folders import interleaved, ranking_layout, ranking_order, serving_rows
from playbill.sources import read_lake, read_serving
from playbill.versions import LoadConflict, Store, partition_values
from testbed.stored import changed_titles

GENRES = ["Drama", "Crime,Drama", "Comedy", "Drama,,Crime", "A/B%c", None, "Sci-Fi,Sci-Fi"]
SMALL = {"min_votes": 300, "k": 3, "reserve": 2}


def made_titles(rng, keys):
    return [
        (f"tt{i:04d}", rng.choice(["movie", "short", "tvSeries"]),
         rng.choice([None, *range(1950, 2020, 7)]), rng.choice(GENRES),
         rng.choice([None, *(x / 2 for x in range(20))]), rng.choice([None, *range(0, 1000, 50)]))
        for i in keys
    ]


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def check_against_whole_load(spark, root, rows, settings=SMALL):
    """The store equals one that is computed from all rows at once."""
    titles = serving_rows(wide_rows(spark, rows))
    assert rows_of(read_serving(spark, root)) == rows_of(titles)
    top = marts.top_rated(titles, settings["min_votes"])
    assert rows_of(read_mart(spark, root, "top_rated")) == rows_of(top)
    assert rows_of(read_mart(spark, root, "by_genre")) == rows_of(marts.titles_by_genre(titles))
    found = {tuple(r)[:2]: tuple(r)[2:] for r in read_mart(spark, root, "rollup").collect()}
    whole = {tuple(r)[:2]: tuple(r)[2:] for r in marts.ratings_rollup(titles).collect()}
    assert found == whole  # halves add up exactly
    best = changes.board_with_reserve(top, settings["k"], 0).drop("whole")
    assert rows_of(read_mart(spark, root, "board", settings["k"])) == rows_of(best)


def test_a_refresh_that_fails_leaves_the_old_rows(spark, tmp_path, enriched):
    root = str(tmp_path / "store")
    first = publish(spark, root, enriched)
    before = rows_of(read_serving(spark, root))
    broken = enriched.withColumn(
        "num_votes",
        F.when(F.col("start_year") == 1874, F.raise_error(F.lit("broken"))).otherwise(1).cast("int"),
    )
    with pytest.raises(Exception, match="broken"):
        publish(spark, root, broken)
    with pytest.raises(Exception, match="broken"):
        apply_changes(spark, root, broken)
    assert Store(spark, root).snapshot() == first
    assert rows_of(read_serving(spark, root)) == before
    # What the failed load left is removed when asked for, the live rows are not.
    Store(spark, root).vacuum()
    assert rows_of(read_serving(spark, root)) == before
    loads = {f.split("load=")[1].split("/")[0] for f in parquet_files(f"{root}/titles")}
    assert len(loads) == 1


def test_a_lake_stays_readable_while_the_next_one_is_written(spark, tmp_path):
    root = str(tmp_path / "lake")
    store = Store(spark, root)
    old = wide_rows(spark, [("tt1", "movie", 1990, "A", 5.0, 1)])
    new = wide_rows(spark, [("tt2", "short", 1991, "A", 5.0, 1)])
    parts = ("title_type", "start_year")
    base = store.commit(None, {"lake": store.stage("lake", old, parts)})
    reader = read_lake(spark, root)
    folders = store.stage("lake", new, parts)  # written, not switched
    assert [r.tconst for r in read_lake(spark, root).collect()] == ["tt1"]
    store.commit(base, {"lake": folders})
    assert [r.tconst for r in read_lake(spark, root).collect()] == ["tt2"]
    assert [r.tconst for r in reader.collect()] == ["tt1"]  # began before the switch
    with pytest.raises(LoadConflict):
        store.commit(base, {"lake": folders})
    assert store.vacuum(keep=2) == [] and len(store.vacuum(keep=1)) == 1
    assert read_lake(spark, root).schema == ENRICHED


def test_an_entry_that_is_being_written_is_not_read(spark, tmp_path):
    root = str(tmp_path / "store")
    store = Store(spark, root)
    df = wide_rows(spark, [("tt1", "movie", 1990, "A", 5.0, 1)])
    first = store.commit(None, {"lake": store.stage("lake", df, ("title_type", "start_year"))})
    for text in ("", '{"version": 1, "batch"'):
        with open(f"{root}/_log/{1:012d}.json", "w") as half:
            half.write(text)
        for crc in [f for f in os.listdir(f"{root}/_log") if f.endswith(".crc")]:
            os.remove(f"{root}/_log/{crc}")
        assert store.snapshot() == first
        assert read_lake(spark, root).count() == 1


def test_folder_names_give_partition_values():
    assert partition_values("t/load=3-a/decade=1990") == ("1990",)
    assert partition_values("t/load=3-a/genre=A%2FB%25c/decade=0") == ("A/B%c", "0")
    assert partition_values("t/load=3-a/genre=__HIVE_DEFAULT_PARTITION__/decade=0") == (None, "0")
    assert partition_values("t/load=3-a") == ()


def test_changes_equal_a_whole_load(spark, tmp_path):
    rng = random.Random(31)
    root = str(tmp_path / "store")
    rows = {r[0]: r for r in made_titles(rng, range(150))}
    publish(spark, root, wide_rows(spark, list(rows.values())), **SMALL)
    check_against_whole_load(spark, root, rows.values())
    for turn in range(3):
        moved = made_titles(rng, rng.sample(range(200), 12))
        gone = [f"tt{i:04d}" for i in rng.sample(range(150), 9)]
        # The best title of each type goes too, so that the board has to fall back on its reserve.
        for kind in ("movie", "short", "tvSeries"):
            own = [r for r in rows.values() if r[1] == kind and r[4] and (r[5] or 0) >= 300]
            own.sort(key=lambda r: (-r[4], -r[5], r[0]))
            gone += [r[0] for r in own[: 2 * turn]]
        gone = [g for g in gone if g not in {m[0] for m in moved}]
        same = next(r for k, r in rows.items() if k not in gone and k not in {m[0] for m in moved})
        arriving = wide_rows(spark, [*moved, moved[0], same])
        removed = spark.createDataFrame([(g,) for g in [*gone, "tt9999", None]], "tconst string")
        apply_changes(spark, root, arriving, removed, **SMALL)
        rows |= {m[0]: m for m in moved}
        rows = {k: r for k, r in rows.items() if k not in gone}
        check_against_whole_load(spark, root, rows.values())


def test_untouched_folders_keep_their_files(spark, tmp_path):
    rng = random.Random(32)
    root = str(tmp_path / "store")
    rows = {r[0]: r for r in made_titles(rng, range(120))}
    publish(spark, root, wide_rows(spark, list(rows.values())), **SMALL)
    before = set(read_serving(spark, root).inputFiles())
    genres_before = set(Store(spark, root).snapshot().tables["by_genre"])
    key, row = next((k, r) for k, r in rows.items() if r[2] == 1957)
    moved = (key, "movie", 1985, "Comedy", 9.5, 900)
    apply_changes(spark, root, wide_rows(spark, [moved]), **SMALL)
    after = set(read_serving(spark, root).inputFiles())
    decades = {f.split("decade=")[1].split("/")[0] for f in before ^ after}
    assert decades == {"1950", "1980"} and before & after
    changed = {partition_values(f)[1] for f in genres_before ^ set(Store(spark, root).snapshot().tables["by_genre"])}
    assert changed <= {"1950", "1980"}
    check_against_whole_load(spark, root, (rows | {key: moved}).values())
    # The same rows again touch nothing.
    apply_changes(spark, root, wide_rows(spark, [moved]), **SMALL)
    assert set(read_serving(spark, root).inputFiles()) == after


def test_marts_of_touched_folders_are_made_from_the_new_titles(spark, tmp_path):
    rng = random.Random(33)
    root = str(tmp_path / "store")
    rows = {r[0]: r for r in made_titles(rng, range(120))}
    publish(spark, root, wide_rows(spark, list(rows.values())), **SMALL)
    # All rows of these genres change or have changed: nothing of their folders is looked up.
    touched = [f for f in Store(spark, root).snapshot().tables["by_genre"]
               if partition_values(f)[0] in ("Drama", "Comedy", None)]
    for folder in touched:
        for file in parquet_files(f"{root}/{folder}"):
            os.truncate(file, 1)
    every = [(k, *r[1:3], "Comedy,,Drama", *r[4:]) for k, r in rows.items()]
    apply_changes(spark, root, wide_rows(spark, every), **SMALL)
    check_against_whole_load(spark, root, every)


@pytest.mark.parametrize("most", [0, 10_000])
def test_great_batches_equal_a_whole_load(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(refresh, "MANY_KEYS", most)
    rng = random.Random(34)
    root = str(tmp_path / "store")
    rows = {r[0]: r for r in made_titles(rng, range(150))}
    publish(spark, root, wide_rows(spark, list(rows.values())), **SMALL)
    moved = {r[0]: r for r in made_titles(rng, range(100, 200))}
    gone = [f"tt{i:04d}" for i in range(40)]
    removed = spark.createDataFrame([(g,) for g in gone], "tconst string")
    apply_changes(spark, root, wide_rows(spark, [*moved.values(), rows["tt0050"]]), removed, **SMALL)
    check_against_whole_load(
        spark, root, [r for k, r in (rows | moved).items() if k not in gone]
    )


def test_rows_held_against_a_great_batch_are_not_sorted(spark):
    rows, keys = (spark.range(n).select(F.col("id").cast("string").alias("tconst")) for n in (999, 9))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for many in (True, False):
            found = changes.with_changes(rows, refresh._for_lookup(keys, many), keys.limit(0))
            plan = found._jdf.queryExecution().sparkPlan().toString()
            assert ("ShuffledHashJoin" in plan) == many != ("SortMergeJoin" in plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_batch_is_applied_once(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = [("tt1", "movie", 1990, "A", 5.0, 500), ("tt2", "movie", 1990, "A", 6.0, 500)]
    publish(spark, root, wide_rows(spark, rows), batch="first", **SMALL)
    update = wide_rows(spark, [("tt1", "movie", 2001, "B", 7.0, 600)])
    done = apply_changes(spark, root, update, batch="monday", **SMALL)
    back = wide_rows(spark, [rows[0]])
    apply_changes(spark, root, back, batch="tuesday", **SMALL)
    last = Store(spark, root).snapshot()
    assert (done.version, last.version) == (1, 2)
    # A repeated delivery of an older batch must not undo the newer one.
    assert apply_changes(spark, root, update, batch="monday", **SMALL) == last
    assert publish(spark, root, update, batch="first", **SMALL) == last
    check_against_whole_load(spark, root, rows)


def test_changes_to_and_from_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = [("tt1", "movie", None, None, 5.0, 500), ("tt2", None, 1990, "", None, None)]
    frame = wide_rows(spark, rows)
    with pytest.raises(FileNotFoundError):
        apply_changes(spark, root, frame)
    publish(spark, root, frame.limit(0), **SMALL)
    assert read_serving(spark, root).count() == 0
    apply_changes(spark, root, frame, **SMALL)
    check_against_whole_load(spark, root, rows)
    apply_changes(spark, root, frame.limit(0), frame.select("tconst"), **SMALL)
    for name in ("rollup", "by_genre", "top_rated", "board"):
        assert read_mart(spark, root, name).count() == 0
    assert read_serving(spark, root).schema == SERVING and read_serving(spark, root).count() == 0


def test_a_board_is_filled_again_when_its_reserve_is_used_up(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = [(f"tt{i:02d}", "movie", 1990, "A", i / 4, 500) for i in range(20)]
    publish(spark, root, wide_rows(spark, rows), **SMALL)
    gone = [r[0] for r in rows[-4:]]  # of three places and a reserve of two, one row is left
    removed = spark.createDataFrame([(g,) for g in gone], "tconst string")
    apply_changes(spark, root, wide_rows(spark, rows[:1]), removed, **SMALL)
    check_against_whole_load(spark, root, rows[:-4])
    assert read_mart(spark, root, "board").count() == 5


def test_repeated_loads_of_a_serving_store(spark, tmp_path, enriched):
    lake, serving, rollup = (str(tmp_path / n) for n in ("lake", "serving", "rollup"))
    write_lake(enriched, lake)
    for layout in ("years", "ranking"):
        load_serving(spark, lake, serving, rollup, layout=layout)
        assert read_serving(spark, serving).count() == enriched.count()
        assert read_rollup(spark, rollup).count() > 0
    assert len(Store(spark, serving).versions()) == 2


def test_interleaved_bits(spark):
    rows = spark.range(256).select(F.col("id").cast("int").alias("a"), (255 - F.col("id")).cast("int").alias("b"))
    for r in rows.select("a", "b", interleaved(F.col("a"), F.col("b")).alias("z")).collect():
        bits = "".join(x + y for x, y in zip(f"{r.a:08b}", f"{r.b:08b}"))
        assert r.z == int(bits, 2)


def ranked_rows(spark, count):
    number = F.col("id")
    return conform(spark.range(0, count, 1, 4).select(
        F.concat(F.lit("tt"), F.lpad(number.cast("string"), 7, "0")).alias("tconst"),
        F.lit("movie").alias("title_type"),
        (1990 + number % 10).cast("int").alias("start_year"),
        F.sha2(number.cast("string"), 256).alias("primary_title"),
        (F.pmod(F.xxhash64(number), F.lit(101)) / 10).cast("float").alias("average_rating"),
        F.pow(F.lit(10.0), F.pmod(F.hash(number), F.lit(6000)) / 1000).cast("int").alias("num_votes"),
    ))


def test_the_ranking_layout_sorts_by_a_computed_column(spark, tmp_path):
    """An expression among the sort's keys is computed for both rows of each comparison."""
    rows = serving_rows(ranked_rows(spark, 2_000)).withColumn(
        "average_rating", F.when(F.col("num_votes") % 3 > 0, F.col("average_rating"))
    )
    layout = ranking_layout(rows)
    assert layout.columns == rows.columns
    plan = layout._jdf.queryExecution().optimizedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert len(sorts) == 1 and "shift" not in sorts[0]

    write_serving(rows, str(tmp_path / "ranked"), layout="ranking")
    files = parquet_files(tmp_path / "ranked")
    assert files
    for file in files:
        assert "_place" not in pq.ParquetFile(file).schema_arrow.names
        place = [ranking_order().alias("place"), "title_type", "tconst"]
        found = [tuple(r) for r in spark.read.parquet(str(file)).coalesce(1).select(place).collect()]
        assert found == sorted(found)


def rows_to_read(path, column, least):
    """Rows in row groups that may hold a value of at least ``least``, by their statistics."""
    total = 0
    for file in parquet_files(path):
        whole = pq.ParquetFile(file).metadata
        for g in range(whole.num_row_groups):
            group = whole.row_group(g)
            at = next(i for i in range(group.num_columns) if group.column(i).path_in_schema == column)
            stats = group.column(at).statistics
            total += group.num_rows if stats.max >= least else 0
    return total


def scanned(df):
    """Rows that the scan of a frame put out, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan.metrics().apply("numOutputRows").value()


def test_the_ranking_layout_skips_rows_by_votes_and_by_rating(spark, tmp_path):
    rows = ranked_rows(spark, 60_000)
    name = "spark.sql.adaptive.enabled"
    sizes = {"parquet.block.size": 65536, "parquet.block.size.row.check.min": 500,
             "parquet.block.size.row.check.max": 500, "parquet.page.size.row.check.min": 500,
             "parquet.page.size.row.check.max": 500, "parquet.page.size": 8192}
    conf = spark._jsc.hadoopConfiguration()
    for key, value in sizes.items():
        conf.set(key, str(value))
    try:
        paths = {}
        for layout in ("years", "ranking"):
            paths[layout] = str(tmp_path / layout)
            write_serving(rows, paths[layout], ("tconst",), layout=layout)
    finally:
        for key in sizes:
            conf.unset(key)
    for column, least, share in (("num_votes", 100_001, 0.5), ("average_rating", 9.0, 0.5)):
        plain, ranked = (rows_to_read(paths[x], column, least) for x in ("years", "ranking"))
        assert plain > 59_000 and ranked < share * plain
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        found = {}
        for layout, path in paths.items():
            table = read_serving(spark, path).filter("num_votes > 100000")
            found[layout] = (scanned(table), table.count())
        assert found["years"][1] == found["ranking"][1] > 0
        assert found["ranking"][0] < 0.5 * found["years"][0]
        # Keys lie within the ranges of the row groups, so only the Bloom filter can skip them.
        def look_up(key):
            return read_serving(spark, paths["ranking"]).filter(F.col("tconst") == key)

        assert look_up("tt0030000").count() == 1
        assert scanned(look_up("tt0030000x")) < 0.1 * 60_000
        spark.conf.set("parquet.filter.bloom.enabled", "false")
        assert scanned(look_up("tt0030000x")) > 0.5 * 60_000
    finally:
        spark.conf.set(name, before)
        spark.conf.unset("parquet.filter.bloom.enabled")


def test_a_batch_of_doubled_votes_that_the_column_does_not_hold(spark, tmp_path):
    root = str(tmp_path / "store")
    votes = {"tt2000000040": 2**30 - 1, "tt2000000080": 2**30, "tt2000000120": 1_800_000_000,
             "tt2000000160": None, "tt2000000161": 1_800_000_000, "tt2000000007": 5}
    titles = wide_rows(spark, [(k, "tvSeries", 1990, "Drama", 5.0, v) for k, v in votes.items()])
    publish(spark, root, titles)
    apply_changes(spark, root, *changed_titles(titles))
    found = {r.tconst: (r.start_year, r.num_votes) for r in read_serving(spark, root).collect()}
    assert found == {
        "tt2000000040": (2000, 2**31 - 2),
        "tt2000000080": (2000, None),
        "tt2000000120": (2000, None),
        "tt2000000160": (2000, None),
        "tt2000000161": (1990, 1_800_000_000),
    }
    top = {r.tconst for r in read_mart(spark, root, "top_rated").collect()}
    assert top == {"tt2000000040", "tt2000000161"}
    rollup = {r.start_year: r.total_votes for r in read_mart(spark, root, "rollup").collect()}
    assert rollup == {1990: 1_800_000_000, 2000: 2**31 - 2}
