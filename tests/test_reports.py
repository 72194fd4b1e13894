import pytest
from pyspark.sql import functions as F

from playbill import functions as P
from playbill.operators import quality, shapes
from playbill.operators.cleaning import conform
from playbill.plans.reports import REPORTS, report
from playbill.sinks import write_serving
from playbill.sources import read_serving

COLUMNS = (
    "tconst string, title_type string, primary_title string, start_year int, end_year int,"
    " runtime_minutes int, genres string, average_rating float, num_votes int,"
    " parent_tconst string, season_number int"
)
WORDS = ("Drift", "Ember", "Gale", "Haze", "Iris", "Juno", "Kite")


def _made_rows():
    """Titles that walk over the reports' bounds: run times, votes, years, ratings, genres."""
    rows = []

    def add(kind, year, end, minutes, genres, rating, votes, parent=None, season=None):
        number = len(rows)
        name = f"{WORDS[number % 7]} {number}"
        rows.append((f"tt{number:04d}", kind, name, year, end, minutes, genres, rating, votes,
                     parent, season))

    for i, minutes in enumerate((29, 30, 60, 61, 90, 91, 120, 121, 150, 151, 180, 181)):
        genres = ("Noir", "Noir,Farce", "Heist,Farce", "Heist")[i % 4]
        add("movie", 1993 + 3 * i, None, minutes, genres, 8.5 + i % 3 / 2, 60_000 * (i + 1))
    for i in range(3):
        add("short", 1896 + i, None, 5 + i, "Farce", 5.5 + i / 2, 90 + i)
    for i in range(2):
        add("tvSeries", 2005 + i, 2011 + i, 45, "Heist", 9.0 + i / 4, 700_000 + i)
    series = rows[-2][0], rows[-1][0]
    for i in range(9):
        parent = (series[0], series[0], series[1], "tt9999", None)[i % 5]
        add("tvEpisode", 2007 + i % 4, None, 44, "Heist", 7.0 + i / 4, 1000 + i, parent, 1 + i % 3)
    add("movie", None, None, None, "Unknown", None, None)
    return rows


ROWS = _made_rows()
MOVIES = [r for r in ROWS if r[1] == "movie"]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("reports") / "serving")
    write_serving(conform(spark.createDataFrame(ROWS, COLUMNS)), path)
    return read_serving(spark, path)


def run(name, table, **kwargs):
    return [r.asDict() for r in report(name, table, **kwargs).collect()]


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_every_report_runs(table, name):
    rows = run(name, table)
    if name not in {"s3", "s5", "s8", "a8", "a10"}:  # their thresholds are above this small table
        assert rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_plans_stay_distributed(table, name):
    plan = plan_of(report(name, table))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert unwanted not in plan
    assert ("Window" in plan) == (name == "s6")
    if "limit" in REPORTS[name].params or "k" in REPORTS[name].params:
        assert "TakeOrderedAndProject" in plan


def test_filters_and_columns_reach_the_scan(table):
    plan = plan_of(report("s2", table))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(title_type,movie)" in pushed and "GreaterThan(num_votes,50000)" in pushed
    assert "original_title" not in plan.split("ReadSchema:")[1].split(">")[0]
    assert "decade" in plan_of(report("b4", table)).split("PartitionFilters: [")[1].split("]")[0]


def test_share_of_total(table):
    rows = run("s1", table)
    assert rows[0]["title_type"] == "movie" and rows[0]["title_count"] == len(MOVIES)
    assert rows[0]["pct_of_total"] == round(100 * len(MOVIES) / len(ROWS), 2)
    exact = run("s1", table, rounded=False)
    assert sum(r["pct_of_total"] for r in exact) == pytest.approx(100)


def test_top_movies_order_and_ties(table):
    rows = run("b2", table)
    best = sorted((r for r in MOVIES if (r[8] or 0) > 100000), key=lambda r: (-r[7], r[0]))
    assert [r["primary_title"] for r in rows] == [r[2] for r in best[:10]]


def test_genres_count_a_title_once_per_genre(table):
    rows = {r["genre"]: r for r in run("b3", table)}
    assert rows["Noir"]["cnt"] == len([r for r in ROWS if "Noir" in r[6].split(",")])
    assert "Unknown" not in rows
    assert run("k6", table)[0]["value"] == len(
        {g for r in ROWS if r[6] != "Unknown" for g in r[6].split(",")}
    )
    approximate = shapes.distinct_items(table, "n", where="genres != 'Unknown'", approximate=True)
    assert approximate.first()["n"] == pytest.approx(3, abs=1)


def test_years_in_range_and_change(table):
    years = [r["start_year"] for r in run("b4", table)]
    assert years == sorted(years) and min(years) >= 2000 and max(years) <= 2024
    found = run("s6", table)
    assert [r["start_year"] for r in found] == sorted(r["start_year"] for r in found)
    first, before = found[0], None
    assert first["yoy_change"] == first["titles_released"] and first["yoy_pct_change"] is None
    for row in found:
        made = sum(1 for r in ROWS if r[3] == row["start_year"] and r[1] in ("movie", "tvSeries"))
        assert row["titles_released"] == made
        if before:
            assert row["yoy_change"] == made - before
            assert row["yoy_pct_change"] == round(100 * (made - before) / before, 1)
        before = made


def test_series_rollup(table):
    series = {r[0]: r[2] for r in ROWS if r[1] == "tvSeries"}
    children = {}
    for r in ROWS:
        if r[9] in series:
            children.setdefault(series[r[9]], []).append(r)
    counts = {r["primary_title"]: r["episode_count"] for r in run("b5", table)}
    assert counts == {name: len(rows) for name, rows in children.items()}
    for row in run("a5", table):
        own = children[row["series_name"]]
        assert row["episode_count"] == len(own) and row["total_seasons"] == max(r[10] for r in own)
        assert row["avg_episode_rating"] == pytest.approx(sum(r[7] for r in own) / len(own), abs=0.01)


def test_rollup_of_a_hot_parent_equals_the_plain_join(spark):
    children = spark.range(3000).select(
        F.concat(F.lit("c"), F.col("id")).alias("tconst"),
        F.lit("tvEpisode").alias("title_type"),
        F.when(F.col("id") % 3 > 0, F.lit("p0"))
        .otherwise(F.concat(F.lit("p"), (F.col("id") % 40)))
        .alias("parent_tconst"),
        (F.col("id") % 17).cast("int").alias("season_number"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 100) / 10).cast("float").alias("average_rating"),
    )
    parents = spark.range(40).select(
        F.concat(F.lit("p"), F.col("id")).alias("tconst"),
        F.lit("tvSeries").alias("title_type"),
        F.concat(F.lit("name "), (F.col("id") % 25)).alias("primary_title"),
    )
    df = conform(parents.unionByName(children, allowMissingColumns=True))
    found = report("a5", df, rounded=False).collect()

    e, p = df.alias("e"), df.alias("p")
    plain = (
        e.filter("e.title_type = 'tvEpisode'")
        .join(p, F.expr("e.parent_tconst = p.tconst"))
        .groupBy(F.col("p.primary_title").alias("series_name"))
        .agg(
            F.count(F.lit(1)).alias("episode_count"),
            F.max("e.season_number").alias("total_seasons"),
            F.avg(F.col("e.average_rating").cast("double")).alias("avg_episode_rating"),
        )
        .orderBy(F.desc("episode_count"), "series_name")
        .limit(10)
        .collect()
    )
    assert [r[:3] for r in found] == [r[:3] for r in plain]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in plain])


def test_runtime_buckets(table):
    rows = {r["runtime_bucket"]: r["cnt"] for r in run("b6", table)}
    known = [r[5] for r in MOVIES if r[5] is not None]
    bounds = {"Short": (0, 29), "Medium": (30, 90), "Standard": (91, 150), "Long": (151, 9999)}
    expected = {n: sum(low <= m <= high for m in known) for n, (low, high) in bounds.items()}
    assert rows == {n: c for n, c in expected.items() if c}
    assert {"Under 30m", "1-2 hrs", "3+ hrs"} <= {r["bucket"] for r in run("d6", table)}


@pytest.mark.parametrize(
    "minutes, label",
    [(1, "a"), (29, "a"), (30, "b"), (60, "b"), (61, "c"), (120, "c"), (121, "d"), (None, "d")],
)
def test_bucket_edges(spark, minutes, label):
    df = spark.createDataFrame([(minutes,)], "m int")
    assert df.select(P.bucket("m", (30, 60, 120), "abcd")).first()[0] == label


def test_bucket_needs_a_label_per_interval():
    with pytest.raises(ValueError):
        P.bucket("m", (30, 60), ("a", "b"))


def test_season_statistics(table):
    rows = {r["season_number"]: r for r in run("s9", table)}
    own = sorted(r[7] for r in ROWS if r[10] == 1)
    assert rows[1]["episode_count"] == len(own) == 3 and rows[1]["median_rating"] == own[1]
    assert (rows[1]["min_rating"], rows[1]["max_rating"]) == (own[0], own[-1])
    approximate = shapes.described(
        table, "season_number", "average_rating", "n", "m", "lo", "hi", "mid", approximate=True,
        where="season_number = 1",
    )
    assert approximate.first()["mid"] == own[1]


def test_bands_sort_by_number_and_labels(table):
    rows = run("d10", table)
    assert [r["range"] for r in rows] == ["5-6", "6-7", "7-8", "8-9", "9-10"]
    assert sum(r["count"] for r in rows) == len([r for r in ROWS if r[7] is not None])
    assert run("d4", table)[0]["decade"] == "1890s"


def test_figures_agree_with_each_other(table):
    row = run("kpis", table)[0]
    singles = [run(f"k{i}", table)[0]["value"] for i in range(1, 6)]
    assert list(row.values()) == singles


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(0.125, 0.375, 2.5)], "a double, b double, c double")
    row = df.select(P.half_even("a", 2), P.half_even("b", 2), P.half_even("c", 0)).first()
    assert tuple(row) == (0.12, 0.38, 2.0)


def test_readable_size(spark):
    df = spark.createDataFrame([(1572864,)], "b long")
    assert df.select(P.readable_size("b")).first()[0] == "1.5 MiB"


def test_quality_report_counts_each_rule(spark):
    rows = [
        ("tt1", "movie", 2000, "A", 5.0),
        ("tt1", "movie", 2000, "A", 5.0),
        ("tt1", "movie", 1700, None, 12.0),
        (None, "movie", None, "A", -1.0),
        ("tt2", "movie", 2032, "A", None),
    ]
    df = spark.createDataFrame(
        rows, "tconst string, title_type string, start_year int, genres string, average_rating float"
    )
    expected = {
        "key_not_null": 1,
        "rating_in_range": 2,
        "year_in_range": 2,
        "genres_not_null": 1,
        "key_unique": 2,
    }
    rules = quality.title_rules(2026)
    assert dict(map(tuple, quality.quality_report(df, rules).collect())) == expected
    del expected["key_unique"]
    assert dict(map(tuple, quality.quality_report(df, rules, None).collect())) == expected
    none = df.filter("false")
    assert set(dict(map(tuple, quality.quality_report(none, rules).collect())).values()) == {0}


def test_results_do_not_depend_on_partitioning(spark, table):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    results = []
    try:
        for parts in ("1", "7"):
            spark.conf.set(name, parts)
            results.append({n: report(n, table).collect() for n in ("s1", "s2", "s4", "s9", "a5")})
    finally:
        spark.conf.set(name, before)
    assert results[0] == results[1]
