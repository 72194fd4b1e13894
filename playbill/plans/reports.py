"""The named reports: each is a shape and its parameters.

``report("s3", table)`` gives the report as published, ``rounded=False`` the same without
rounding. Groups: s = analytic set, b = timing set, a = documented variants, k and d =
dashboard figures and panels, l = checks after a load.

Fixed values: conditions, thresholds, year bounds, row limits and output names below are part
of each report's definition.
"""

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame

from playbill import fixed_values as V
from playbill.functions import band_label, band_start, decade, decade_label
from playbill.operators import shapes
from playbill.operators.shapes import mean, rows


@dataclass(frozen=True)
class Report:
    title: str
    shape: Callable[..., DataFrame]
    params: Mapping


def report(name: str, table: DataFrame, rounded: bool = True) -> DataFrame:
    """Run a named report over the wide table."""
    chosen = REPORTS[name]
    params = dict(chosen.params)
    if not rounded:
        params.pop("digits", None)
    return chosen.shape(table, **params)


def _same(*names):
    return {name: name for name in names}


RATED = "average_rating is not null"
MOVIES = "title_type = 'movie'"
SERIES = "title_type = 'tvSeries'"
EPISODES = "title_type = 'tvEpisode'"
MOVIES_AND_SERIES = "title_type in ('movie', 'tvSeries')"
KNOWN_GENRE = f"genres != '{V.UNKNOWN_GENRE}'"
HAS_RUNTIME = "runtime_minutes > 0"

AVG_RATING = partial(mean, "average_rating")
SUM_VOTES = "sum(num_votes)"
AVG_RUNTIME = partial(mean, "runtime_minutes")
AVG_VOTES = partial(mean, "num_votes")
TYPE = _same("title_type")


def _bands(df, count_name, where):
    banded = shapes.grouped(
        df,
        {"band_start": band_start("average_rating"), "range": band_label("average_rating")},
        {count_name: rows()},
        where=where,
        order=["band_start"],
    )
    return banded.select("range", count_name, "band_start")


REPORTS = {
    "s1": Report(
        "Content distribution by type",
        shapes.distribution,
        dict(
            keys=TYPE,
            measures={"avg_rating": AVG_RATING, "total_engagement": SUM_VOTES},
            count_name="title_count",
            share_name="pct_of_total",
            order=["-title_count", "title_type"],
            digits={"pct_of_total": 2},
        ),
    ),
    "s2": Report(
        "Twenty highest rated movies above 50,000 votes",
        shapes.top_k,
        dict(
            columns=_same(
                "primary_title",
                "start_year",
                "genres",
                "average_rating",
                "num_votes",
                "runtime_minutes",
            ),
            k=20,
            order=["-average_rating", "-num_votes"],
            where=f"{MOVIES} and num_votes > 50000 and {RATED}",
        ),
    ),
    "s3": Report(
        "Rating trend by decade and type",
        shapes.by_decade,
        dict(
            keys=TYPE,
            measures={
                "title_count": rows,
                "avg_rating": AVG_RATING,
                "total_votes": SUM_VOTES,
                "avg_runtime": AVG_RUNTIME,
            },
            where=RATED,
            years=(1920, None),
            having="title_count > 100",
            order=["-decade", "-title_count", "title_type"],
            digits={"avg_rating": 2, "avg_runtime": 0},
        ),
    ),
    "s4": Report(
        "Genre popularity",
        shapes.per_item,
        dict(
            measures={
                "title_count": rows,
                "avg_rating": AVG_RATING,
                "total_engagement": SUM_VOTES,
                "avg_runtime": AVG_RUNTIME,
            },
            where=f"{MOVIES_AND_SERIES} and {RATED} and {KNOWN_GENRE}",
            order=["-total_engagement", "genre"],
            limit=20,
            digits={"avg_rating": 2, "avg_runtime": 0},
        ),
    ),
    "s5": Report(
        "Series with most episodes",
        shapes.child_rollup,
        dict(
            group={
                "series_title": "primary_title",
                "start_year": "start_year",
                "genres": "genres",
                "series_rating": "average_rating",
            },
            children=EPISODES,
            parents=SERIES,
            count_name="episode_count",
            last_of=("total_seasons", "season_number"),
            mean_of=("avg_episode_rating", "average_rating"),
            having="episode_count > 100",
            order=["-episode_count", "series_title", "start_year", "genres", "series_rating"],
            limit=20,
        ),
    ),
    "s6": Report(
        "Year-over-year growth in titles released",
        shapes.period_change,
        dict(
            years=(2000, 2024),
            where="title_type in ('movie', 'tvSeries', 'tvMovie')",
            count_name="titles_released",
            change_name="yoy_change",
            percent_name="yoy_pct_change",
            digits={"yoy_pct_change": 1},
        ),
    ),
    "s7": Report(
        "Runtime distribution by type",
        shapes.histogram,
        dict(
            column="runtime_minutes",
            edges=V.RUNTIME_EDGES_BY_TYPE,
            labels=V.RUNTIME_LABELS_BY_TYPE,
            bucket_name="runtime_bucket",
            keys=TYPE,
            measures={
                "title_count": rows,
                "avg_rating": AVG_RATING,
                "avg_votes": AVG_VOTES,
            },
            where=f"{HAS_RUNTIME} and runtime_minutes < 1000 and {RATED}",
            order=["title_type", "-title_count", "runtime_bucket"],
            digits={"avg_rating": 2, "avg_votes": 0},
        ),
    ),
    "s8": Report(
        "Underrated titles",
        shapes.top_k,
        dict(
            columns=_same(
                "primary_title",
                "start_year",
                "genres",
                "average_rating",
                "num_votes",
                "title_type",
            ),
            k=25,
            order=["-average_rating", "-num_votes"],
            where=f"average_rating >= 8.0 and num_votes between 1000 and 10000"
            f" and {MOVIES_AND_SERIES}",
            years=(2015, None),
        ),
    ),
    "s9": Report(
        "Episode ratings by season",
        shapes.described,
        dict(
            key="season_number",
            value="average_rating",
            count_name="episode_count",
            mean_name="avg_rating",
            median_name="median_rating",
            min_name="min_rating",
            max_name="max_rating",
            where=f"{EPISODES} and season_number between 1 and 20 and {RATED}",
            order=["season_number"],
            digits={"avg_rating": 2, "median_rating": 2},
        ),
    ),
    "s10": Report(
        "Titles by type and decade",
        shapes.grouped,
        dict(
            keys={"title_type": "title_type", "decade": partial(decade, "start_year")},
            measures={"title_count": rows, "avg_rating": AVG_RATING},
            years=(1950, None),
            order=["title_type", "decade"],
            digits={"avg_rating": 2},
        ),
    ),
    "b1": Report(
        "Titles and rating by type",
        shapes.grouped,
        dict(
            keys=TYPE,
            measures={"cnt": rows, "avg_rating": AVG_RATING},
            order=["-cnt", "title_type"],
        ),
    ),
    "b2": Report(
        "Ten highest rated movies above 100,000 votes",
        shapes.top_k,
        dict(
            columns=_same("primary_title", "average_rating", "num_votes"),
            k=10,
            order=["-average_rating"],
            where=f"{MOVIES} and num_votes > 100000",
        ),
    ),
    "b3": Report(
        "Rating by genre",
        shapes.per_item,
        dict(
            measures={"cnt": rows, "avg_rating": AVG_RATING},
            where=RATED,
            order=["-cnt", "genre"],
            limit=15,
        ),
    ),
    "b4": Report(
        "Titles per year",
        shapes.grouped,
        dict(
            keys=_same("start_year"),
            measures={"titles_produced": rows, "avg_rating": AVG_RATING},
            where=MOVIES_AND_SERIES,
            years=(2000, 2024),
            order=["start_year"],
        ),
    ),
    "b5": Report(
        "Episodes per series title",
        shapes.child_rollup,
        dict(
            group={"primary_title": "primary_title"},
            children=EPISODES,
            parents=SERIES,
            count_name="episode_count",
            order=["-episode_count", "primary_title"],
            limit=20,
        ),
    ),
    "b6": Report(
        "Movie runtime histogram",
        shapes.histogram,
        dict(
            column="runtime_minutes",
            edges=V.RUNTIME_EDGES_HISTOGRAM,
            labels=V.RUNTIME_LABELS_HISTOGRAM,
            bucket_name="runtime_bucket",
            measures={"cnt": rows, "avg_rating": AVG_RATING},
            where=f"{HAS_RUNTIME} and {MOVIES}",
            order=["-cnt", "runtime_bucket"],
        ),
    ),
    "a1": Report(
        "Content distribution without share",
        shapes.grouped,
        dict(
            keys=TYPE,
            measures={
                "title_count": rows,
                "avg_rating": AVG_RATING,
                "total_engagement": SUM_VOTES,
            },
            order=["-title_count", "title_type"],
            digits={"avg_rating": 2},
        ),
    ),
    "a2": Report(
        "Ten highest rated movies above 100,000 votes, by votes next",
        shapes.top_k,
        dict(
            columns=_same("primary_title", "start_year", "average_rating", "num_votes", "genres"),
            k=10,
            order=["-average_rating", "-num_votes"],
            where=f"{MOVIES} and num_votes > 100000",
        ),
    ),
    "a3": Report(
        "Genre engagement, unknown kept",
        shapes.per_item,
        dict(
            measures={
                "title_count": rows,
                "avg_rating": AVG_RATING,
                "total_engagement": SUM_VOTES,
            },
            where=RATED,
            order=["-total_engagement", "genre"],
            limit=10,
            digits={"avg_rating": 2},
        ),
    ),
    "a4": Report(
        "Titles by decade",
        shapes.by_decade,
        dict(
            measures={
                "titles_produced": rows,
                "avg_rating": AVG_RATING,
                "avg_runtime_min": AVG_RUNTIME,
            },
            where="start_year is not null",
            order=["decade"],
            digits={"avg_rating": 2, "avg_runtime_min": 0},
        ),
    ),
    "a5": Report(
        "Longest series of any parent type",
        shapes.child_rollup,
        dict(
            group={"series_name": "primary_title"},
            children=EPISODES,
            count_name="episode_count",
            last_of=("total_seasons", "season_number"),
            mean_of=("avg_episode_rating", "average_rating"),
            order=["-episode_count", "series_name"],
            limit=10,
            digits={"avg_episode_rating": 2},
        ),
    ),
    "a6": Report(
        "Episode ratings by season without median",
        shapes.described,
        dict(
            key="season_number",
            value="average_rating",
            count_name="episode_count",
            mean_name="avg_rating",
            min_name="worst_episode",
            max_name="best_episode",
            where=f"{EPISODES} and season_number between 1 and 20 and {RATED}",
            order=["season_number"],
            digits={"avg_rating": 2},
        ),
    ),
    "a7": Report(
        "Movie runtime and engagement",
        shapes.histogram,
        dict(
            column="runtime_minutes",
            edges=V.RUNTIME_EDGES_MOVIES,
            labels=V.RUNTIME_LABELS_MOVIES,
            bucket_name="runtime_bucket",
            measures={
                "titles": rows,
                "avg_rating": AVG_RATING,
                "avg_engagement": AVG_VOTES,
            },
            where=f"{HAS_RUNTIME} and {MOVIES} and {RATED}",
            order=["-avg_rating", "runtime_bucket"],
            digits={"avg_rating": 2, "avg_engagement": 0},
        ),
    ),
    "a8": Report(
        "Hidden gems",
        shapes.top_k,
        dict(
            columns=_same(
                "primary_title",
                "start_year",
                "genres",
                "average_rating",
                "num_votes",
                "title_type",
            ),
            k=10,
            order=["-average_rating", "-num_votes"],
            where=f"average_rating >= 8.5 and num_votes between 1000 and 50000"
            f" and {MOVIES_AND_SERIES}",
            years=(2010, None),
        ),
    ),
    "a9": Report(
        "Titles per year and type",
        shapes.grouped,
        dict(
            keys=_same("start_year", "title_type"),
            measures={"titles_produced": rows},
            where=MOVIES_AND_SERIES,
            years=(2000, 2024),
            order=["start_year", "title_type"],
        ),
    ),
    "a10": Report(
        "Best series above 100,000 votes",
        shapes.top_k,
        dict(
            columns=_same(
                "primary_title",
                "start_year",
                "end_year",
                "average_rating",
                "num_votes",
                "genres",
            ),
            k=10,
            order=["-average_rating"],
            where=f"{SERIES} and num_votes > 100000",
        ),
    ),
    "k1": Report("Total titles", shapes.headline, dict(measures={"value": rows})),
    "k2": Report("Movies", shapes.headline, dict(measures={"value": rows}, where=MOVIES)),
    "k3": Report("Series", shapes.headline, dict(measures={"value": rows}, where=SERIES)),
    "k4": Report(
        "Average rating",
        shapes.headline,
        dict(measures={"value": AVG_RATING}, where=RATED, digits={"value": 2}),
    ),
    "k5": Report("Total engagement", shapes.headline, dict(measures={"value": SUM_VOTES})),
    "k6": Report(
        "Different genres", shapes.distinct_items, dict(name="value", where=KNOWN_GENRE)
    ),
    "kpis": Report(
        "The figures k1 to k5 in one pass",
        shapes.headline,
        dict(
            measures={
                "total_titles": rows,
                "movies": f"count_if({MOVIES})",
                "series": f"count_if({SERIES})",
                "avg_rating": AVG_RATING,
                "total_engagement": SUM_VOTES,
            },
            digits={"avg_rating": 2},
        ),
    ),
    "d1": Report(
        "Titles by type",
        shapes.grouped,
        dict(keys=TYPE, measures={"count": rows}, order=["-count", "title_type"]),
    ),
    "d2": Report(
        "Top rated movies",
        shapes.top_k,
        dict(
            columns={
                "title": "primary_title",
                "year": "start_year",
                "rating": "average_rating",
                "votes": "num_votes",
                "genres": "genres",
            },
            k=10,
            order=["-average_rating", "-num_votes"],
            where=f"{MOVIES} and num_votes > 100000",
        ),
    ),
    "d3": Report(
        "Genre engagement",
        shapes.per_item,
        dict(
            measures={"engagement": SUM_VOTES},
            where=f"{RATED} and {KNOWN_GENRE}",
            order=["-engagement", "genre"],
            limit=12,
        ),
    ),
    "d4": Report(
        "Rating by decade label",
        shapes.by_decade,
        dict(
            decade_of=partial(decade_label, "start_year"),
            measures={"avg_rating": AVG_RATING},
            where=f"start_year is not null and {RATED}",
            order=["decade"],
            digits={"avg_rating": 2},
        ),
    ),
    "d5": Report(
        "Best series above 50,000 votes",
        shapes.top_k,
        dict(
            columns={
                "series": "primary_title",
                "start": "start_year",
                "end": "end_year",
                "rating": "average_rating",
                "votes": "num_votes",
                "genres": "genres",
            },
            k=8,
            order=["-average_rating"],
            where=f"{SERIES} and num_votes > 50000",
        ),
    ),
    "d6": Report(
        "Runtime against rating",
        shapes.histogram,
        dict(
            column="runtime_minutes",
            edges=V.RUNTIME_EDGES_PANEL,
            labels=V.RUNTIME_LABELS_PANEL,
            bucket_name="bucket",
            measures={"avg_rating": AVG_RATING, "count": rows},
            where=f"{HAS_RUNTIME} and {MOVIES} and {RATED}",
            order=["-avg_rating", "bucket"],
            digits={"avg_rating": 2},
        ),
    ),
    "d7": Report(
        "Genre quality",
        shapes.per_item,
        dict(
            measures={"avg_rating": AVG_RATING, "titles": rows},
            where=f"{RATED} and {KNOWN_GENRE}",
            having="titles > 1",
            hidden=("titles",),
            order=["-avg_rating", "genre"],
            digits={"avg_rating": 2},
        ),
    ),
    "d8": Report(
        "Production timeline",
        shapes.grouped,
        dict(
            keys={"year": "cast(start_year as string)", "title_type": "title_type"},
            measures={"count": rows},
            years=(1950, None),
            order=["year", "title_type"],
        ),
    ),
    "d9": Report(
        "Most episodes",
        shapes.child_rollup,
        dict(
            group={"series": "primary_title"},
            children=EPISODES,
            count_name="episodes",
            order=["-episodes", "series"],
            limit=10,
        ),
    ),
    "d10": Report("Rating bands", _bands, dict(count_name="count", where=RATED)),
    "l1": Report("Rows loaded", shapes.headline, dict(measures={"rows": rows})),
    "l2": Report(
        "Ten most frequent types",
        shapes.grouped,
        dict(keys=TYPE, measures={"cnt": rows}, order=["-cnt", "title_type"], limit=10),
    ),
    "l3": Report(
        "Titles since 2020 by type",
        shapes.grouped,
        dict(
            keys=TYPE,
            measures={"cnt": rows, "avg_rating": AVG_RATING},
            years=(2020, None),
            order=["-cnt", "title_type"],
        ),
    ),
    "l4": Report(
        "Ten highest rated movies, as a load check",
        shapes.top_k,
        dict(
            columns=_same("primary_title", "average_rating", "num_votes"),
            k=10,
            order=["-average_rating"],
            where=f"{MOVIES} and num_votes > 100000",
        ),
    ),
}
