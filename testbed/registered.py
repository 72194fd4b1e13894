"""The registered queries: library calls over the whole derived input."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill import fixed_values as V
from playbill import functions as P
from playbill.operators import cleaning, marts, quality, shapes
from playbill.operators.sketches import DISTINCT_ERROR, RANK_ERROR
from playbill.operators.ledger import step_totals
from playbill.plans.pipeline import build_lake, load_serving, read_ledger, read_rollup
from playbill.plans.refresh import publish, read_mart, read_summary
from playbill.plans.reports import report
from playbill.schemas import ENRICHED, RAW_RATINGS, RAW_TITLES
from playbill.session import fresh_path
from playbill.sinks import (
    ensure_tables,
    load_by_genre,
    load_leaderboard,
    load_table,
    load_titles,
    write_by_genre,
    write_lake,
    write_leaderboard,
    write_rollup,
    write_serving,
)
from playbill.sinks.folders import serving_rows
from playbill.sources import (
    partition_summary,
    read_by_genre,
    read_delimited,
    read_lake,
    read_serving,
)
from playbill.versions import Store
from testbed.catalog_fixture import (
    AS_OF_YEAR,
    damaged,
    raw_episodes,
    raw_frames,
    raw_ratings,
    raw_titles,
    write_delimited,
)
from testbed.stored import changed_store, changed_titles, enriched, serving

#: Rows of a compressed file of raw text: some 16 MB as plain text.
PACKED_ROWS = 250_000


def run_report(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(name, serving(spark, sf_dir), rounded=False)


def delimited_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "titles-tsv")
    write_delimited(raw_titles(spark, sf_dir), path)
    return read_delimited(spark, path, RAW_TITLES)


def gzip_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "ratings-tsv-gz")
    write_delimited(raw_ratings(spark, sf_dir), path, "gzip")
    return read_delimited(spark, path, RAW_RATINGS, spread=True)


def _written_lake(spark, sf_dir):
    path = fresh_path(spark, "lake")
    write_lake(serving(spark, sf_dir).select(ENRICHED.fieldNames()), path)
    return path


def lake_roundtrip(spark, sf_dir):
    return read_lake(spark, _written_lake(spark, sf_dir))


def lake_one_type(spark, sf_dir):
    lake = read_lake(spark, _written_lake(spark, sf_dir))
    return lake.filter("title_type = 'movie' and start_year >= 1990")


def lake_refresh(spark, sf_dir):
    path = _written_lake(spark, sf_dir)
    movies = marts.movies(serving(spark, sf_dir).select(ENRICHED.fieldNames()))
    changed = movies.withColumn("primary_title", F.upper("primary_title"))
    write_lake(changed, path, refresh="partitions")
    return read_lake(spark, path)


def serving_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "serving")
    write_serving(enriched(spark, sf_dir), path, bloom_columns=("tconst",))
    return read_serving(spark, path)


def serving_years(spark, sf_dir):
    return shapes.years_between(serving(spark, sf_dir), 1995, 2004)


def leaderboard_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "leaderboard")
    write_leaderboard(marts.top_rated(serving(spark, sf_dir)), path)
    return spark.read.parquet(path)


def genre_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "by-genre")
    write_by_genre(marts.titles_by_genre(serving(spark, sf_dir)), path)
    return read_by_genre(spark, path)


def rollup_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "rollup")
    write_rollup(marts.rollup_state(serving(spark, sf_dir)), path)
    return read_rollup(spark, path)


def _database(spark):
    name = f"playbill_{uuid.uuid4().hex}"
    ensure_tables(spark, name, fresh_path(spark, "database"))
    return name


def catalog_titles(spark, sf_dir):
    database = _database(spark)
    load_titles(serving(spark, sf_dir), f"{database}.titles_enriched")
    return spark.table(f"{database}.titles_enriched")


def catalog_rollup(spark, sf_dir):
    database = _database(spark)
    rollup = marts.ratings_rollup(serving(spark, sf_dir))
    load_table(rollup, f"{database}.ratings_by_type_year")
    return spark.table(f"{database}.ratings_by_type_year")


def catalog_top_rated(spark, sf_dir):
    database = _database(spark)
    load_leaderboard(marts.top_rated(serving(spark, sf_dir)), f"{database}.top_rated")
    return spark.table(f"{database}.top_rated")


def catalog_by_genre(spark, sf_dir):
    database = _database(spark)
    load_by_genre(marts.titles_by_genre(serving(spark, sf_dir)), f"{database}.titles_by_genre")
    return spark.table(f"{database}.titles_by_genre")


def damaged_wide(spark, sf_dir):
    raw = [damaged(spark, sf_dir, name) for name in ("titles", "ratings", "episodes")]
    titles, ratings, episodes = raw
    return cleaning.enrich(
        cleaning.clean_titles(titles, AS_OF_YEAR, keep_hash=True),
        cleaning.clean_ratings(ratings, keep_hash=True),
        cleaning.clean_episodes(episodes, keep_hash=True),
    )


def damaged_rules(spark, sf_dir):
    rows = cleaning.conform(cleaning.typed_titles(damaged(spark, sf_dir, "titles")))
    return quality.quality_report(rows, quality.title_rules(AS_OF_YEAR))


def partition_listing(spark, sf_dir):
    """Files and bytes of the summary beside those of a listing of the folders."""
    path = fresh_path(spark, "serving")
    write_serving(enriched(spark, sf_dir), path)
    found = partition_summary(read_serving(spark, path))
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    listed = listed.groupBy(F.col("decade").alias("partition")).agg(
        F.count(F.lit(1)).alias("listed"), F.sum("length").alias("listed_bytes")
    )
    return found.join(listed, "partition", "full").selectExpr(
        "partition",
        "rows",
        "files <=> listed as files_match",
        "bytes <=> listed_bytes as bytes_match",
    )


def lenient_int(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = F.col("l_extendedprice").cast("string")
    return items.select("l_orderkey", "l_linenumber", P.lenient_int(text).alias("whole_price"))


def rounded_ties(spark, sf_dir):
    """Eighths and quarters of a table's numbers are exact in binary, so ties are real."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    number = F.col("l_quantity").cast("double")
    return items.select(
        "l_orderkey",
        "l_linenumber",
        P.half_even(number / 8, 2).alias("eighths"),
        P.half_even(number / 4, 1).alias("quarters"),
        P.half_even(number / 2, 0).alias("halves"),
    )


def recent_today(spark, sf_dir):
    return marts.recent_popular(serving(spark, sf_dir))


def sizes(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    return parts.select(
        "p_partkey", P.readable_size(F.col("p_partkey") * 524288).alias("size")
    )


def gz_lake(spark, sf_dir):
    """The lake from one gzip file for each input, whose rows are spread before further work."""
    raw = fresh_path(spark, "raw-gz")
    names = (V.TITLES_FILE, V.RATINGS_FILE, V.EPISODES_FILE)
    for frame, name in zip(raw_frames(spark, sf_dir), names):
        write_delimited(frame, f"{raw}/{name}.gz", "gzip")
    lake = fresh_path(spark, "lake")
    build_lake(spark, raw, lake, AS_OF_YEAR, suffix=".gz", spread=True)
    return read_lake(spark, lake)


def conformed(spark, sf_dir):
    return cleaning.conform(cleaning.clean_titles(raw_titles(spark, sf_dir), AS_OF_YEAR))


def serving_nulls(spark, sf_dir):
    texts = cleaning.typed_titles(raw_titles(spark, sf_dir)).select(
        "tconst", "title_type", "primary_title", "original_title", "genres"
    )
    return cleaning.serving_nulls(texts)


def titles_ratings(spark, sf_dir):
    return cleaning.left_join_all(
        cleaning.clean_titles(raw_titles(spark, sf_dir), AS_OF_YEAR, keep_hash=True),
        cleaning.clean_ratings(raw_ratings(spark, sf_dir), keep_hash=True),
    )


def children_per_parent(spark, sf_dir):
    return shapes.child_rollup(
        serving(spark, sf_dir),
        group={"series": "tconst", "primary_title": "primary_title"},
        children="title_type = 'tvEpisode'",
        count_name="episode_count",
        last_of=("total_seasons", "season_number"),
    )


def distinct_keys(spark, sf_dir):
    episodes = cleaning.typed_episodes(raw_episodes(spark, sf_dir))
    return shapes.headline(episodes, {"distinct_keys": "count(distinct tconst)"})


def scalars(spark, sf_dir):
    return serving(spark, sf_dir).select(
        "tconst",
        P.decade("start_year").alias("decade"),
        P.decade_label("start_year").alias("decade_label"),
        P.band_start("average_rating").alias("band_start"),
        P.band_label("average_rating").alias("band"),
        P.bucket("runtime_minutes", V.RUNTIME_EDGES_BY_TYPE, V.RUNTIME_LABELS_BY_TYPE).alias(
            "runtime_bucket"
        ),
        F.coalesce("start_year", F.lit(0)).alias("year_or_zero"),
    )


def rollup_merge(spark, sf_dir):
    table = serving(spark, sf_dir)
    often = F.coalesce(F.col("num_votes") > 1000, F.lit(False))
    stored, arrived = (marts.rollup_state(table.filter(part)) for part in (often, ~often))
    return marts.rollup_view(marts.merge_rollup(stored, arrived))


def raw_title_rules(spark, sf_dir):
    rows = cleaning.conform(cleaning.typed_titles(raw_titles(spark, sf_dir)))
    return quality.quality_report(rows, quality.title_rules(AS_OF_YEAR))


def raw_rating_rules(spark, sf_dir):
    rules = {
        "rating_in_range": ~P.in_range_or_null("average_rating", 0.0, 10.0),
        "votes_positive": ~P.positive_or_null("num_votes"),
    }
    return quality.quality_report(cleaning.typed_ratings(raw_ratings(spark, sf_dir)), rules)


def view_sql(spark, sf_dir):
    prefix = f"v{uuid.uuid4().hex}_"
    marts.register_views(serving(spark, sf_dir), AS_OF_YEAR, prefix)
    return spark.sql(
        f"""
        select title_type, count(*) as cnt, avg(cast(average_rating as double)) as avg_rating
        from {prefix}titles group by title_type
        """
    )


def _built_lake(spark, sf_dir, ledger=False, compression="none"):
    raw = fresh_path(spark, "raw")
    names = (V.TITLES_FILE, V.RATINGS_FILE, V.EPISODES_FILE)
    most = 0 if compression == "none" else PACKED_ROWS
    for frame, name in zip(raw_frames(spark, sf_dir), names):
        write_delimited(frame, f"{raw}/{name}", compression, most)
    lake = fresh_path(spark, "lake")
    return lake, build_lake(spark, raw, lake, AS_OF_YEAR, ledger=ledger)


def lake_and_load(spark, sf_dir):
    """Both jobs, from many compressed files: plain text would be a third of their disk."""
    lake, _ = _built_lake(spark, sf_dir, compression="gzip")
    table, rollup = (fresh_path(spark, x) for x in ("serving", "rollup"))
    load_serving(spark, lake, table, rollup)
    return read_rollup(spark, rollup)


def row_counts(spark, sf_dir):
    _, outcome = _built_lake(spark, sf_dir)
    counts = [(f"{n} read", c) for n, c in outcome.rows_read.items()]
    counts += [(f"{n} kept", c) for n, c in outcome.rows_kept.items()]
    return spark.createDataFrame([*counts, ("wide", outcome.rows)], "step string, rows long")


def job_ledger(spark, sf_dir):
    lake, _ = _built_lake(spark, sf_dir, ledger=True)
    return step_totals(read_ledger(spark, lake))


def refresh_not_switched(spark, sf_dir):
    """What readers see while the next load is written: all rows of the one before."""
    root = fresh_path(spark, "store")
    titles = serving(spark, sf_dir).select(ENRICHED.fieldNames())
    publish(spark, root, titles)
    changed, _ = changed_titles(titles)
    Store(spark, root).stage("titles", serving_rows(changed), ("decade",))
    return read_serving(spark, root)


def ranking_layout(spark, sf_dir):
    path = fresh_path(spark, "serving")
    write_serving(enriched(spark, sf_dir), path, ("tconst",), layout="ranking")
    return read_serving(spark, path).filter("num_votes > 100000 and average_rating >= 8")


def _mart_after_changes(name):
    return lambda spark, sf: read_mart(spark, changed_store(spark, sf), name)


def median_sketch(spark, sf_dir):
    """Rating quantiles from merged sketches of a changed store, with their ranks held exactly."""
    store = changed_store(spark, sf_dir)
    q = F.col("rating_quantiles")
    read = read_summary(spark, store, ("title_type",), 1990, 2009, (0.0, 0.5, 1.0)).select(
        "title_type", "rated", q[0].alias("least"), q[1].alias("middle"), q[2].alias("most")
    )
    rating = F.col("average_rating").cast("double")
    titles = read_serving(spark, store, 1990, 2009).select("title_type", rating.alias("rating"))
    ranks = titles.join(read, "title_type").groupBy("title_type", "rated", "least", "most").agg(
        F.avg((F.col("rating") < F.col("middle")).cast("int")).alias("below"),
        F.avg((F.col("rating") <= F.col("middle")).cast("int")).alias("up_to"),
    )
    within = (F.col("below") <= 0.5 + RANK_ERROR) & (F.col("up_to") >= 0.5 - RANK_ERROR)
    return ranks.select("title_type", "rated", "least", "most", within.alias("median_within_error"))


def distinct_sketch(spark, sf_dir):
    """Titles and genres per decade from merged sketches of a changed store; few genres: exact."""
    store = changed_store(spark, sf_dir)
    exact = read_serving(spark, store).groupBy("decade").agg(F.count_distinct("tconst").alias("n"))
    near = F.abs(F.col("titles") - F.col("n")) <= DISTINCT_ERROR * F.col("n")
    return read_summary(spark, store, ("decade",)).join(exact, "decade").select(
        "decade", "genres", F.col("n").alias("titles"), near.alias("titles_within_error")
    )


STEPS = {
    "src_delimited_roundtrip": delimited_roundtrip,
    "src_gzip_roundtrip": gzip_roundtrip,
    "src_lake_one_type": lake_one_type,
    "src_serving_years": serving_years,
    "snk_lake_roundtrip": lake_roundtrip,
    "snk_lake_refresh": lake_refresh,
    "snk_serving_roundtrip": serving_roundtrip,
    "snk_leaderboard_roundtrip": leaderboard_roundtrip,
    "snk_genre_roundtrip": genre_roundtrip,
    "snk_rollup_roundtrip": rollup_roundtrip,
    "snk_catalog_titles": catalog_titles,
    "snk_catalog_rollup": catalog_rollup,
    "snk_catalog_top_rated": catalog_top_rated,
    "snk_catalog_by_genre": catalog_by_genre,
    "cln_titles": lambda spark, sf: cleaning.clean_titles(raw_titles(spark, sf), AS_OF_YEAR),
    "cln_ratings": lambda spark, sf: cleaning.clean_ratings(raw_ratings(spark, sf)),
    "cln_episodes": lambda spark, sf: cleaning.clean_episodes(raw_episodes(spark, sf)),
    "cln_titles_keys": lambda spark, sf: cleaning.clean_titles(
        damaged(spark, sf, "titles"), AS_OF_YEAR
    ),
    "cln_ratings_keys": lambda spark, sf: cleaning.clean_ratings(damaged(spark, sf, "ratings")),
    "cln_episodes_keys": lambda spark, sf: cleaning.clean_episodes(damaged(spark, sf, "episodes")),
    "cln_wide_keys": damaged_wide,
    "dq_damaged_titles": damaged_rules,
    "cln_rename_cast": lambda spark, sf: cleaning.typed_titles(raw_titles(spark, sf)),
    "cln_lenient_int": lenient_int,
    "cln_key_prefix": lambda spark, sf: cleaning.require_key(
        cleaning.typed_titles(raw_titles(spark, sf)), key="genres", prefix="Drama"
    ),
    "cln_nullable_range": lambda spark, sf: cleaning.keep_in_range(
        cleaning.typed_ratings(raw_ratings(spark, sf)), "average_rating", 0.0, 10.0
    ),
    "cln_dedupe": lambda spark, sf: cleaning.dedupe_by_key(
        cleaning.typed_titles(raw_titles(spark, sf))
    ),
    "cln_fill_default": lambda spark, sf: cleaning.fill_default(
        cleaning.typed_titles(raw_titles(spark, sf)), "genres", V.UNKNOWN_GENRE
    ).select("tconst", "genres"),
    "cln_conform": conformed,
    "cln_serving_nulls": serving_nulls,
    "jon_titles_ratings": titles_ratings,
    "jon_enrich": enriched,
    "jon_children_per_parent": children_per_parent,
    "agg_distinct_keys": distinct_keys,
    "agg_median_sketch": median_sketch,
    "agg_distinct_sketch": distinct_sketch,
    "fun_scalars": scalars,
    "mrt_rollup": lambda spark, sf: marts.ratings_rollup(serving(spark, sf)),
    "mrt_rollup_merge": rollup_merge,
    "mrt_top_rated": lambda spark, sf: marts.top_rated(serving(spark, sf)),
    "mrt_by_genre": lambda spark, sf: marts.titles_by_genre(serving(spark, sf)),
    "mrt_movies": lambda spark, sf: marts.movies(serving(spark, sf)),
    "mrt_tv_series": lambda spark, sf: marts.tv_series(serving(spark, sf)),
    "mrt_recent_popular": lambda spark, sf: marts.recent_popular(serving(spark, sf), AS_OF_YEAR),
    "prf_summary": lambda spark, sf: quality.summary(serving(spark, sf)),
    "prf_types": lambda spark, sf: quality.type_summary(serving(spark, sf)),
    "prf_partition_rows": lambda spark, sf: partition_summary(serving(spark, sf)).select(
        "partition", "rows"
    ),
    "prf_partition_files": lambda spark, sf: partition_summary(serving(spark, sf)).selectExpr(
        "partition", "rows", "files >= 1 as has_files", "bytes > 0 as has_bytes"
    ),
    "prf_partition_listing": partition_listing,
    "dq_served": lambda spark, sf: quality.quality_report(
        serving(spark, sf), quality.title_rules(AS_OF_YEAR)
    ),
    "dq_raw_titles": raw_title_rules,
    "dq_raw_ratings": raw_rating_rules,
    "snk_view_sql": view_sql,
    "fun_round": rounded_ties,
    "fun_readable_size": sizes,
    "mrt_recent_today": recent_today,
    "snk_refresh_not_switched": refresh_not_switched,
    "snk_changes_titles": lambda spark, sf: read_serving(spark, changed_store(spark, sf)),
    "snk_changes_years": lambda spark, sf: read_serving(
        spark, changed_store(spark, sf), 1995, 2004
    ),
    "snk_ranking_layout": ranking_layout,
    "mrt_rollup_changes": _mart_after_changes("rollup"),
    "mrt_by_genre_changes": _mart_after_changes("by_genre"),
    "mrt_top_rated_changes": _mart_after_changes("top_rated"),
    "mrt_board_changes": lambda spark, sf: read_mart(
        spark, changed_store(spark, sf), "board", k=100
    ),
    "job_gz_lake": gz_lake,
    "job_lake_and_load": lake_and_load,
    "job_row_counts": row_counts,
    "job_ledger": job_ledger,
}
