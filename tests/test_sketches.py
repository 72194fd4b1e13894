"""Stored sketches of ratings, titles and genres against exact figures."""

import random

import pytest
from pyspark.sql import functions as F
from test_storage import wide_rows

from playbill.operators.sketches import (
    DISTINCT_ERROR,
    RANK_ERROR,
    merge_sketches,
    sketch_estimates,
    sketch_state,
)
from playbill.plans.refresh import apply_changes, publish, read_summary
from playbill.sinks.folders import serving_rows
from playbill.sources import read_serving
from playbill.versions import Store, partition_values


def many_titles(spark, count=40_000):
    """One type has nearly all rows, ratings have many values and one of them a third of all."""
    rows = wide_rows(spark, [("tt0", "movie", 1990, "A", 5.0, 1)])
    number = F.col("id")
    rating = F.when(number % 3 == 0, F.lit(7.5)).otherwise((number * 7919 % 10_007) / 1000.7)
    return spark.range(count).select(
        F.format_string("tt%07d", number).alias("tconst"),
        F.when(number % 50 == 0, "short").otherwise("movie").alias("title_type"),
        (1960 + number % 60).cast("int").alias("start_year"),
        F.concat_ws(",", (number % 13).cast("string"), (number % 17 + 20).cast("string")).alias("genres"),
        rating.cast("float").alias("average_rating"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields
          if f.name not in ("tconst", "title_type", "start_year", "genres", "average_rating")],
    ).select(rows.columns)


def check_ranks(titles, estimates, by, quantiles):
    for row in estimates.collect():
        own = titles.filter(F.col(by).eqNullSafe(F.lit(row[by])))
        ratings = sorted(r[0] for r in own.select("average_rating").dropna().collect())
        assert row.rated == len(ratings)
        for share, value in zip(quantiles, row.rating_quantiles or []):
            below = sum(r < value for r in ratings) / len(ratings)
            up_to = sum(r <= value for r in ratings) / len(ratings)
            assert below <= share + RANK_ERROR and up_to >= share - RANK_ERROR
            assert up_to > below  # a value that occurs
        exact = own.select("tconst").distinct().count()
        assert abs(row.titles - exact) <= DISTINCT_ERROR * exact


def test_merged_sketches_keep_their_bounds(spark, tmp_path):
    root, quantiles = str(tmp_path / "store"), (0.0, 0.1, 0.5, 0.9, 1.0)
    publish(spark, root, many_titles(spark))
    for years in ((None, None), (1975, 1994)):
        titles = read_serving(spark, root, *years)
        read = read_summary(spark, root, ("title_type",), *years, quantiles=quantiles)
        assert read.count() == 2
        check_ranks(titles, read, "title_type", quantiles)
    whole = read_summary(spark, root, (), quantiles=(0.0, 1.0)).first()
    ratings = read_serving(spark, root).agg(F.min("average_rating"), F.max("average_rating")).first()
    assert tuple(whole.rating_quantiles) == tuple(ratings)
    assert whole.genres == 13 + 17 and whole.rated == 40_000


def test_only_the_decades_asked_for_are_read(spark, tmp_path):
    root = str(tmp_path / "store")
    publish(spark, root, many_titles(spark, 600))
    plan = read_summary(spark, root, ("title_type",), 1990, 1999)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(decade" in plan and "decade#" in plan
    assert "average_rating" not in plan


def test_few_values_nulls_and_unknown_genres(spark):
    rows = wide_rows(
        spark,
        [("tt1", "movie", None, None, None, None), ("tt2", "movie", None, "Unknown", None, 1),
         ("tt3", "short", 1990, "A,B", 3.0, 1), ("tt3", "short", 1990, "A,B", 3.0, 1),
         ("tt4", "short", 1991, "B,C,Unknown", 5.0, 1), ("tt5", None, 1991, "", None, 1)],
    )
    state = sketch_state(serving_rows(rows))
    read = sketch_estimates(merge_sketches(state, ["title_type"]), (0.5, 1.0), ["title_type"])
    found = {r.title_type: (r.rated, r.titles, r.genres, r.rating_quantiles) for r in read.collect()}
    assert found == {
        "movie": (0, 2, 0, None),
        "short": (3, 2, 3, [3.0, 5.0]),
        "": (0, 1, 0, None),
    }
    nothing = serving_rows(rows).limit(0)
    assert sketch_state(nothing).count() == 0
    one = sketch_estimates(merge_sketches(sketch_state(nothing))).first()
    assert (one.rated, one.rating_quantiles) == (0, None)
    with pytest.raises(ValueError, match="shares"):
        sketch_estimates(merge_sketches(state), (1.5,))


def test_changes_make_the_sketches_of_touched_decades_again(spark, tmp_path):
    root, rng = str(tmp_path / "store"), random.Random(5)
    rows = [(f"tt{i:04d}", rng.choice(["movie", "short"]), rng.choice([None, 1955, 1975, 1995]),
             rng.choice(["A", "B,C", "C"]), rng.choice([None, 2.0, 4.5, 9.0]), 1)
            for i in range(200)]
    publish(spark, root, wide_rows(spark, rows))
    before = Store(spark, root).snapshot().tables["sketches"]
    moved = [(k, t, 1995, "D", 10.0, v) for k, t, y, g, r, v in rows if y == 1975][:20]
    gone = [r[0] for r in rows if r[2] == 1975][20:25]
    apply_changes(spark, root, wide_rows(spark, moved), spark.createDataFrame([(k,) for k in gone], "tconst string"))
    after = Store(spark, root).snapshot().tables["sketches"]
    kept = {partition_values(f)[0] for f in set(before) & set(after)}
    assert kept == {"0", "1950"}
    check_ranks(read_serving(spark, root), read_summary(spark, root, ("decade",)), "decade", (0.5,))


def test_a_store_from_before_the_sketches_gets_them_with_its_next_change(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = [("tt1", "movie", 1990, "A", 2.0, 1), ("tt2", "movie", 1950, "B", 4.0, 1)]
    base = publish(spark, root, wide_rows(spark, rows))
    store = Store(spark, root)
    base.tables.pop("sketches")
    store.commit(base, {})
    apply_changes(spark, root, wide_rows(spark, [("tt3", "movie", 1990, "C", 6.0, 1)]))
    row = read_summary(spark, root, ()).first()
    assert (row.rated, row.titles, row.genres, row.rating_quantiles) == (3, 3, 3, [4.0])
