"""Expected results as SQL for an independent engine, written apart from the library."""

from testbed.catalog_fixture import DAMAGED, EPISODES, RATINGS, TITLES

_INPUT = f"""
titles_raw as ({TITLES}),
ratings_raw as ({RATINGS}),
episodes_raw as ({EPISODES})
"""

_TITLE_REST = (
    "title_type, primary_title, original_title, is_adult, start_year, end_year,"
    " runtime_minutes, genres"
)
_RATING_REST = "average_rating, num_votes"
_EPISODE_REST = "parent_tconst, season_number, episode_number"


def _first_per_key(source, rest):
    order = ", ".join(f"{c.strip()} asc nulls first" for c in rest.split(","))
    return f"""
select tconst, {rest} from (
    select *, row_number() over (partition by tconst order by {order}) as pick from {source}
) ranked where pick = 1
"""


_TYPED = """
titles_typed as (
    select tconst, titleType as title_type, primaryTitle as primary_title,
           originalTitle as original_title,
           try_cast(isAdult as integer) as is_adult,
           try_cast(startYear as integer) as start_year,
           try_cast(endYear as integer) as end_year,
           try_cast(runtimeMinutes as integer) as runtime_minutes,
           genres
    from titles_raw
),
ratings_typed as (
    select tconst, try_cast(averageRating as float) as average_rating,
           try_cast(numVotes as integer) as num_votes
    from ratings_raw
),
episodes_typed as (
    select tconst, parentTconst as parent_tconst,
           try_cast(seasonNumber as integer) as season_number,
           try_cast(episodeNumber as integer) as episode_number
    from episodes_raw
)
"""

_VALID = """
titles_valid as (
    select * from titles_typed
    where tconst like 'tt%' and (start_year is null or start_year between 1874 and 2031)
),
ratings_valid as (
    select * from ratings_typed
    where tconst is not null
      and (average_rating is null or average_rating between 0.0 and 10.0)
      and (num_votes is null or num_votes > 0)
),
episodes_valid as (select * from episodes_typed where tconst is not null)
"""

_CLEAN = f"""
titles_first as ({_first_per_key("titles_valid", _TITLE_REST)}),
titles as (select * replace (coalesce(genres, 'Unknown') as genres) from titles_first),
ratings as ({_first_per_key("ratings_valid", _RATING_REST)}),
episodes as ({_first_per_key("episodes_valid", _EPISODE_REST)})
"""

_WIDE = f"""
wide as (
    select titles.*, {_RATING_REST}, {_EPISODE_REST}
    from titles left join ratings using (tconst) left join episodes using (tconst)
),
served as (
    select *, cast(floor(coalesce(start_year, 0) / 10) * 10 as integer) as "decade" from wide
)
"""

# The titles after a batch: a fortieth of them changed, another one removed.
_NUMBER = "cast(substr(tconst, 4) as bigint)"
_AFTER = f"""
wide_after as (
    select * replace (cast(coalesce(start_year, 1950) + 10 as integer) as start_year,
                      cast(num_votes * 2 as integer) as num_votes, 'Drama,Moved' as genres)
    from wide where {_NUMBER} % 40 = 0
    union all
    select * from wide where {_NUMBER} % 40 not in (0, 7)
),
served_after as (
    select *, cast(floor(coalesce(start_year, 0) / 10) * 10 as integer) as "decade"
    from wide_after
)
"""

_STEPS = ", ".join([_INPUT, _TYPED, _VALID, _CLEAN, _WIDE, _AFTER])


def _sql(body):
    return f"with {_STEPS} {body}"


_RATING = "avg(cast(average_rating as double))"
_VOTES = "cast(sum(num_votes) as bigint)"
_DECADE = 'cast(floor(start_year / 10) * 10 as integer) as "decade"'
_TWO_KINDS = "title_type in ('movie', 'tvSeries')"

_BY_TYPE_LABELS = """
case when runtime_minutes < 30 then 'Short (<30min)'
     when runtime_minutes between 30 and 60 then 'Medium (30-60min)'
     when runtime_minutes between 61 and 120 then 'Standard (1-2hr)'
     when runtime_minutes between 121 and 180 then 'Long (2-3hr)'
     else 'Very Long (>3hr)' end
"""
_HISTOGRAM_LABELS = """
case when runtime_minutes < 30 then 'Short'
     when runtime_minutes between 30 and 90 then 'Medium'
     when runtime_minutes between 91 and 150 then 'Standard'
     else 'Long' end
"""
_MOVIE_LABELS = """
case when runtime_minutes < 30 then '<30 min'
     when runtime_minutes <= 60 then '30-60 min'
     when runtime_minutes <= 120 then '1-2 hours'
     when runtime_minutes <= 180 then '2-3 hours'
     else '>3 hours' end
"""
_PANEL_LABELS = """
case when runtime_minutes < 30 then 'Under 30m'
     when runtime_minutes <= 60 then '30-60m'
     when runtime_minutes <= 120 then '1-2 hrs'
     when runtime_minutes <= 180 then '2-3 hrs'
     else '3+ hrs' end
"""

_ROLLUP = f"""
select title_type, coalesce(start_year, 0) as start_year, {_RATING} as avg_rating,
       coalesce({_VOTES}, 0) as total_votes, count(*) as title_count
from wide where average_rating is not null
group by title_type, coalesce(start_year, 0)
"""

_BY_GENRE = """
select tconst, title_type, primary_title, start_year,
       unnest(string_split(genres, ',')) as genre,
       average_rating, num_votes, runtime_minutes
from wide
"""

_GENRE_ROWS = "(select *, unnest(string_split(genres, ',')) as genre from wide)"

_TOP_RATED = """
select tconst, title_type, primary_title, start_year, genres, average_rating, num_votes
from wide where average_rating is not null and num_votes >= 50000
"""


def _children(parent_condition):
    return f"""
from wide e join wide p on e.parent_tconst = p.tconst
where e.title_type = 'tvEpisode' {parent_condition}
"""


_REPORTS = {
    "s1": f"""
select title_type, count(*) as title_count,
       cast(count(*) as double) * 100 / (select count(*) from wide) as pct_of_total,
       {_RATING} as avg_rating, {_VOTES} as total_engagement
from wide group by title_type
""",
    "s2": """
select primary_title, start_year, genres, average_rating, num_votes, runtime_minutes
from wide where title_type = 'movie' and num_votes > 50000 and average_rating is not null
order by average_rating desc, num_votes desc, tconst limit 20
""",
    "s3": f"""
select {_DECADE}, title_type, count(*) as title_count, {_RATING} as avg_rating,
       {_VOTES} as total_votes, avg(cast(runtime_minutes as double)) as avg_runtime
from wide where average_rating is not null and start_year >= 1920
group by 1, 2 having count(*) > 100
""",
    "s4": f"""
select genre, count(*) as title_count, {_RATING} as avg_rating, {_VOTES} as total_engagement,
       avg(cast(runtime_minutes as double)) as avg_runtime
from {_GENRE_ROWS}
where {_TWO_KINDS} and average_rating is not null and genres <> 'Unknown'
group by genre order by sum(num_votes) desc, genre limit 20
""",
    "s5": f"""
select p.primary_title as series_title, p.start_year, p.genres,
       p.average_rating as series_rating, count(*) as episode_count,
       max(e.season_number) as total_seasons,
       avg(cast(e.average_rating as double)) as avg_episode_rating
{_children("and p.title_type = 'tvSeries'")}
group by p.primary_title, p.start_year, p.genres, p.average_rating
having count(*) > 100
order by count(*) desc, p.primary_title, p.start_year nulls first, p.genres,
         p.average_rating nulls first
limit 20
""",
    "s6": """
select start_year, titles_released,
       titles_released - lag(titles_released, 1, 0) over (order by start_year) as yoy_change,
       cast(titles_released - lag(titles_released) over (order by start_year) as double) * 100
           / lag(titles_released) over (order by start_year) as yoy_pct_change
from (
    select start_year, count(*) as titles_released from wide
    where start_year between 2000 and 2024 and title_type in ('movie', 'tvSeries', 'tvMovie')
    group by start_year
) yearly
""",
    "s7": f"""
select title_type, {_BY_TYPE_LABELS} as runtime_bucket, count(*) as title_count,
       {_RATING} as avg_rating, avg(cast(num_votes as double)) as avg_votes
from wide
where runtime_minutes > 0 and runtime_minutes < 1000 and average_rating is not null
group by 1, 2
""",
    "s8": f"""
select primary_title, start_year, genres, average_rating, num_votes, title_type
from wide
where average_rating >= 8.0 and num_votes between 1000 and 10000 and {_TWO_KINDS}
  and start_year >= 2015
order by average_rating desc, num_votes desc, tconst limit 25
""",
    "s9": f"""
select season_number, count(*) as episode_count, {_RATING} as avg_rating,
       median(cast(average_rating as double)) as median_rating,
       min(average_rating) as min_rating, max(average_rating) as max_rating
from wide
where title_type = 'tvEpisode' and season_number between 1 and 20
  and average_rating is not null
group by season_number
""",
    "s10": f"""
select title_type, {_DECADE}, count(*) as title_count, {_RATING} as avg_rating
from wide where start_year >= 1950 group by 1, 2
""",
    "b1": f"""
select title_type, count(*) as cnt, {_RATING} as avg_rating from wide group by title_type
""",
    "b2": """
select primary_title, average_rating, num_votes from wide
where title_type = 'movie' and num_votes > 100000
order by average_rating desc nulls last, tconst limit 10
""",
    "b3": f"""
select genre, count(*) as cnt, {_RATING} as avg_rating
from {_GENRE_ROWS} where average_rating is not null
group by genre order by count(*) desc, genre limit 15
""",
    "b4": f"""
select start_year, count(*) as titles_produced, {_RATING} as avg_rating
from wide where start_year between 2000 and 2024 and {_TWO_KINDS} group by start_year
""",
    "b5": f"""
select p.primary_title, count(*) as episode_count
{_children("and p.title_type = 'tvSeries'")}
group by p.primary_title order by count(*) desc, p.primary_title limit 20
""",
    "b6": f"""
select {_HISTOGRAM_LABELS} as runtime_bucket, count(*) as cnt, {_RATING} as avg_rating
from wide where runtime_minutes > 0 and title_type = 'movie' group by 1
""",
    "a1": f"""
select title_type, count(*) as title_count, {_RATING} as avg_rating,
       {_VOTES} as total_engagement
from wide group by title_type
""",
    "a2": """
select primary_title, start_year, average_rating, num_votes, genres from wide
where title_type = 'movie' and num_votes > 100000
order by average_rating desc nulls last, num_votes desc, tconst limit 10
""",
    "a3": f"""
select genre, count(*) as title_count, {_RATING} as avg_rating, {_VOTES} as total_engagement
from {_GENRE_ROWS} where average_rating is not null
group by genre order by sum(num_votes) desc, genre limit 10
""",
    "a4": f"""
select {_DECADE}, count(*) as titles_produced, {_RATING} as avg_rating,
       avg(cast(runtime_minutes as double)) as avg_runtime_min
from wide where start_year is not null group by 1
""",
    "a5": f"""
select p.primary_title as series_name, count(*) as episode_count,
       max(e.season_number) as total_seasons,
       avg(cast(e.average_rating as double)) as avg_episode_rating
{_children("")}
group by p.primary_title order by count(*) desc, p.primary_title limit 10
""",
    "a6": f"""
select season_number, count(*) as episode_count, {_RATING} as avg_rating,
       min(average_rating) as worst_episode, max(average_rating) as best_episode
from wide
where title_type = 'tvEpisode' and season_number between 1 and 20
  and average_rating is not null
group by season_number
""",
    "a7": f"""
select {_MOVIE_LABELS} as runtime_bucket, count(*) as titles, {_RATING} as avg_rating,
       avg(cast(num_votes as double)) as avg_engagement
from wide
where runtime_minutes > 0 and title_type = 'movie' and average_rating is not null
group by 1
""",
    "a8": f"""
select primary_title, start_year, genres, average_rating, num_votes, title_type
from wide
where average_rating >= 8.5 and num_votes between 1000 and 50000 and {_TWO_KINDS}
  and start_year >= 2010
order by average_rating desc, num_votes desc, tconst limit 10
""",
    "a9": f"""
select start_year, title_type, count(*) as titles_produced
from wide where start_year between 2000 and 2024 and {_TWO_KINDS}
group by start_year, title_type
""",
    "a10": """
select primary_title, start_year, end_year, average_rating, num_votes, genres from wide
where title_type = 'tvSeries' and num_votes > 100000
order by average_rating desc nulls last, tconst limit 10
""",
    "k1": "select count(*) as value from wide",
    "k2": "select count(*) as value from wide where title_type = 'movie'",
    "k3": "select count(*) as value from wide where title_type = 'tvSeries'",
    "k4": f"select {_RATING} as value from wide where average_rating is not null",
    "k5": f"select {_VOTES} as value from wide",
    "k6": f"select count(distinct genre) as value from {_GENRE_ROWS} where genres <> 'Unknown'",
    "kpis": f"""
select count(*) as total_titles,
       count(*) filter (where title_type = 'movie') as movies,
       count(*) filter (where title_type = 'tvSeries') as series,
       {_RATING} as avg_rating, {_VOTES} as total_engagement
from wide
""",
    "d1": 'select title_type, count(*) as "count" from wide group by title_type',
    "d2": """
select primary_title as title, start_year as "year", average_rating as rating,
       num_votes as votes, genres
from wide where title_type = 'movie' and num_votes > 100000
order by average_rating desc nulls last, num_votes desc, tconst limit 10
""",
    "d3": f"""
select genre, {_VOTES} as engagement
from {_GENRE_ROWS} where average_rating is not null and genres <> 'Unknown'
group by genre order by sum(num_votes) desc, genre limit 12
""",
    "d4": f"""
select cast(cast(floor(start_year / 10) * 10 as integer) as varchar) || 's' as "decade",
       {_RATING} as avg_rating
from wide where start_year is not null and average_rating is not null group by 1
""",
    "d5": """
select primary_title as series, start_year as "start", end_year as "end",
       average_rating as rating, num_votes as votes, genres
from wide where title_type = 'tvSeries' and num_votes > 50000
order by average_rating desc nulls last, tconst limit 8
""",
    "d6": f"""
select {_PANEL_LABELS} as bucket, {_RATING} as avg_rating, count(*) as "count"
from wide
where runtime_minutes > 0 and title_type = 'movie' and average_rating is not null
group by 1
""",
    "d7": f"""
select genre, {_RATING} as avg_rating
from {_GENRE_ROWS} where average_rating is not null and genres <> 'Unknown'
group by genre having count(*) > 1
""",
    "d8": """
select cast(start_year as varchar) as "year", title_type, count(*) as "count"
from wide where start_year >= 1950 group by 1, 2
""",
    "d9": f"""
select p.primary_title as series, count(*) as episodes
{_children("")}
group by p.primary_title order by count(*) desc, p.primary_title limit 10
""",
    "d10": """
select cast(band_start as varchar) || '-' || cast(band_start + 1 as varchar) as "range",
       count(*) as "count", band_start
from (
    select cast(floor(average_rating) as integer) as band_start
    from wide where average_rating is not null
) bands group by band_start
""",
    "l1": 'select count(*) as "rows" from wide',
    "l2": """
select title_type, count(*) as cnt from wide
group by title_type order by count(*) desc, title_type limit 10
""",
    "l3": f"""
select title_type, count(*) as cnt, {_RATING} as avg_rating
from wide where start_year >= 2020 group by title_type
""",
    "l4": """
select primary_title, average_rating, num_votes from wide
where title_type = 'movie' and num_votes > 100000
order by average_rating desc nulls last, tconst limit 10
""",
}

_STEPS_AND_TABLES = {
    "src_delimited_roundtrip": "select * from titles_raw",
    "src_gzip_roundtrip": "select * from ratings_raw",
    "src_lake_one_type": "select * from wide where title_type = 'movie' and start_year >= 1990",
    "src_serving_years": "select * from served where start_year between 1995 and 2004",
    "snk_lake_roundtrip": "select * from wide",
    "snk_refresh_not_switched": "select * from served",
    "snk_changes_titles": "select * from served_after",
    "snk_changes_years": "select * from served_after where start_year between 1995 and 2004",
    "snk_ranking_layout": "select * from served where num_votes > 100000 and average_rating >= 8",
    "mrt_rollup_changes": _ROLLUP.replace("from wide", "from wide_after"),
    "mrt_by_genre_changes": _BY_GENRE.replace("from wide", "from wide_after"),
    "mrt_top_rated_changes": _TOP_RATED.replace("from wide", "from wide_after"),
    "mrt_board_changes": f"""
select * from (
    select *, cast(row_number() over (
        partition by title_type order by average_rating desc, num_votes desc, tconst
    ) as integer) as place
    from ({_TOP_RATED.replace("from wide", "from wide_after")}) best
) placed where place <= 100
""",
    "snk_lake_refresh": """
select * replace (case when title_type = 'movie' then upper(primary_title)
                       else primary_title end as primary_title)
from wide
""",
    "snk_serving_roundtrip": "select * from served",
    "snk_leaderboard_roundtrip": _TOP_RATED,
    "snk_genre_roundtrip": _BY_GENRE,
    "snk_rollup_roundtrip": _ROLLUP,
    "snk_catalog_titles": "select * from served",
    "snk_catalog_rollup": _ROLLUP,
    "snk_catalog_top_rated": _TOP_RATED,
    "snk_catalog_by_genre": _BY_GENRE,
    "cln_titles": "select * from titles",
    "cln_ratings": "select * from ratings",
    "cln_episodes": "select * from episodes",
    "cln_rename_cast": "select * from titles_typed",
    "cln_lenient_int": """
select l_orderkey, l_linenumber, cast(trunc(l_extendedprice) as integer) as whole_price
from lineitem
""",
    "cln_key_prefix": "select * from titles_typed where genres like 'Drama%'",
    "cln_nullable_range": """
select * from ratings_typed where average_rating is null or average_rating between 0.0 and 10.0
""",
    "cln_dedupe": _first_per_key("titles_typed", _TITLE_REST),
    "cln_fill_default": """
select tconst, coalesce(genres, 'Unknown') as genres from titles_typed
""",
    "cln_conform": """
select tconst, title_type, primary_title, original_title, is_adult, start_year, end_year,
       runtime_minutes, genres, cast(null as float) as average_rating,
       cast(null as integer) as num_votes, cast(null as varchar) as parent_tconst,
       cast(null as integer) as season_number, cast(null as integer) as episode_number
from titles
""",
    "cln_serving_nulls": """
select tconst, coalesce(title_type, '') as title_type, coalesce(primary_title, '')
           as primary_title, coalesce(original_title, '') as original_title,
       case when coalesce(genres, '') = '' then 'Unknown' else genres end as genres
from titles_typed
""",
    "jon_titles_ratings": f"""
select titles.*, {_RATING_REST} from titles left join ratings using (tconst)
""",
    "jon_enrich": "select * from wide",
    "jon_children_per_parent": f"""
select p.tconst as series, p.primary_title, count(*) as episode_count,
       max(e.season_number) as total_seasons
{_children("")}
group by p.tconst, p.primary_title
""",
    "agg_distinct_keys": "select count(distinct tconst) as distinct_keys from episodes_typed",
    "agg_median_sketch": """
select title_type, count(average_rating) as rated, min(average_rating::double) as least,
       max(average_rating::double) as most,
       case when count(average_rating) > 0 then true end as median_within_error
from served_after where start_year between 1990 and 2009 group by title_type
""",
    "agg_distinct_sketch": """
select "decade", count(distinct tconst) as titles, true as titles_within_error,
       (select count(distinct genre) from (
            select unnest(string_split(genres, ',')) as genre from served_after s
            where s."decade" = t."decade"
        ) items where genre <> 'Unknown') as genres
from served_after t group by "decade"
""",
    "fun_scalars": f"""
select tconst, {_DECADE},
       cast(cast(floor(start_year / 10) * 10 as integer) as varchar) || 's' as decade_label,
       cast(floor(average_rating) as integer) as band_start,
       cast(cast(floor(average_rating) as integer) as varchar) || '-'
           || cast(cast(floor(average_rating) as integer) + 1 as varchar) as band,
       {_BY_TYPE_LABELS} as runtime_bucket,
       coalesce(start_year, 0) as year_or_zero
from wide
""",
    "mrt_rollup": _ROLLUP,
    "mrt_rollup_merge": _ROLLUP,
    "mrt_top_rated": _TOP_RATED,
    "mrt_by_genre": _BY_GENRE,
    "mrt_movies": "select * from served where title_type = 'movie'",
    "mrt_tv_series": "select * from served where title_type = 'tvSeries'",
    "fun_round": """
select l_orderkey, l_linenumber, round_even(cast(l_quantity as double) / 8, 2) as eighths,
       round_even(cast(l_quantity as double) / 4, 1) as quarters,
       round_even(cast(l_quantity as double) / 2, 0) as halves
from lineitem
""",
    "fun_readable_size": """
select p_partkey, format('{:,.1f} MiB', p_partkey * 0.5::double) as size from part
""",
    "mrt_recent_today": """
select * from served where start_year >= year(current_date) - 5 and num_votes > 1000
""",
    "job_gz_lake": "select * from wide",
    "mrt_recent_popular": "select * from served where start_year >= 2021 and num_votes > 1000",
    "prf_summary": """
select count(*) as total, min(start_year) as min_year, max(start_year) as max_year,
       count(average_rating) as rated,
       cast(count(average_rating) as double) * 100 / count(*) as rated_pct,
       count(parent_tconst) as with_parent,
       cast(count(parent_tconst) as double) * 100 / count(*) as with_parent_pct
from wide
""",
    "prf_types": """
select title_type, count(*) as "count",
       cast(count(*) as double) * 100 / (select count(*) from wide) as pct
from wide group by title_type
""",
    "prf_partition_files": """
select "decade" as "partition", count(*) as "rows", true as has_files, true as has_bytes
from served group by 1
""",
    "prf_partition_listing": """
select "decade" as "partition", count(*) as "rows", true as files_match, true as bytes_match
from served group by 1
""",
    "prf_partition_rows": 'select "decade" as "partition", count(*) as "rows" from served group by 1',
    "dq_served": """
select rule, cast(violations as bigint) as violations from (
    select 'key_not_null' as rule, count(*) filter (where tconst is null) as violations from wide
    union all
    select 'rating_in_range', count(*) filter (where average_rating < 0 or average_rating > 10)
    from wide
    union all
    select 'year_in_range', count(*) filter (where start_year < 1874 or start_year > 2031)
    from wide
    union all
    select 'genres_not_null', count(*) filter (where genres is null) from wide
    union all
    select 'key_unique', count(*) - count(distinct tconst) from wide
) found
""",
    "dq_raw_titles": """
select rule, cast(violations as bigint) as violations from (
    select 'key_not_null' as rule, count(*) filter (where tconst is null) as violations
    from titles_typed
    union all
    select 'rating_in_range', 0
    union all
    select 'year_in_range', count(*) filter (where start_year < 1874 or start_year > 2031)
    from titles_typed
    union all
    select 'genres_not_null', count(*) filter (where genres is null) from titles_typed
    union all
    select 'key_unique', count(*) - count(distinct tconst) from titles_typed
) found
""",
    "dq_raw_ratings": """
select rule, cast(violations as bigint) as violations from (
    select 'rating_in_range' as rule,
           count(*) filter (where average_rating < 0 or average_rating > 10) as violations
    from ratings_typed
    union all
    select 'votes_positive', count(*) filter (where num_votes <= 0) from ratings_typed
    union all
    select 'key_unique', count(*) - count(distinct tconst) from ratings_typed
) found
""",
    "snk_view_sql": f"""
select title_type, count(*) as cnt, {_RATING} as avg_rating from wide group by title_type
""",
    "job_lake_and_load": _ROLLUP,
    "job_ledger": """
select cast(0 as integer) as load_version, input, step, "rows" from (
    select 'titles' as input, 'read' as step, count(*) as "rows" from titles_raw
    union all select 'ratings', 'read', count(*) from ratings_raw
    union all select 'episodes', 'read', count(*) from episodes_raw
    union all select 'titles', 'valid', count(*) from titles_valid
    union all select 'ratings', 'valid', count(*) from ratings_valid
    union all select 'episodes', 'valid', count(*) from episodes_valid
    union all select 'titles', 'kept', count(*) from titles
    union all select 'ratings', 'kept', count(*) from ratings
    union all select 'episodes', 'kept', count(*) from episodes
    union all select 'lake', 'written', count(*) from wide
) counts
""",
    "job_row_counts": """
select 'titles read' as step, count(*) as "rows" from titles_raw
union all select 'ratings read', count(*) from ratings_raw
union all select 'episodes read', count(*) from episodes_raw
union all select 'titles kept', count(*) from titles
union all select 'ratings kept', count(*) from ratings
union all select 'episodes kept', count(*) from episodes
union all select 'wide', count(*) from wide
""",
}

_DAMAGED_INPUT = ", ".join(f"{name}_raw as ({text})" for name, text in DAMAGED.items())
_DAMAGED_STEPS = ", ".join([_DAMAGED_INPUT, _TYPED, _VALID, _CLEAN, _WIDE])

# From rows of which some have no key, or titles a key that is not one of a title.
_OF_DAMAGED = {
    "cln_titles_keys": "select * from titles",
    "cln_ratings_keys": "select * from ratings",
    "cln_episodes_keys": "select * from episodes",
    "cln_wide_keys": "select * from wide",
    "dq_damaged_titles": """
select rule, cast(violations as bigint) as violations from (
    select 'key_not_null' as rule, count(*) filter (where tconst is null) as violations
    from titles_typed
    union all
    select 'rating_in_range', 0
    union all
    select 'year_in_range', count(*) filter (where start_year < 1874 or start_year > 2031)
    from titles_typed
    union all
    select 'genres_not_null', count(*) filter (where genres is null) from titles_typed
    union all
    select 'key_unique', sum(copies - 1)
    from (select count(*) as copies from titles_typed group by tconst) per_key
) found
""",
}

ORACLE = {name: _sql(body) for name, body in {**_REPORTS, **_STEPS_AND_TABLES}.items()}
ORACLE |= {name: f"with {_DAMAGED_STEPS} {body}" for name, body in _OF_DAMAGED.items()}
