"""Raw title, rating and episode rows derived from the part, supplier and lineitem tables.

The texts run unchanged in Spark and in the checking engine: they define the input, and only
the input, for both.
"""

from pyspark.sql import DataFrame, SparkSession

TITLES = """
select concat('tt1', lpad(cast(p_partkey as string), 9, '0')) as tconst,
       case p_type when 'SMALL' then 'short' when 'ECONOMY' then 'tvMovie' else 'movie' end
           as titleType,
       p_name as primaryTitle,
       concat(p_brand, ' ', p_name) as originalTitle,
       cast(p_size % 2 as string) as isAdult,
       case when p_partkey % 19 = 0 then null
            when p_partkey % 23 = 0 then '9999'
            else cast(1900 + p_partkey % 125 as string) end as startYear,
       cast(null as string) as endYear,
       case when p_partkey % 17 = 0 then null else cast(p_size * 4 as string) end
           as runtimeMinutes,
       case when p_partkey % 11 = 0 then null else replace(p_name, ' ', ',') end as genres
from part
union all
select concat('tt2', lpad(cast(s_suppkey as string), 9, '0')),
       'tvSeries',
       s_name,
       s_name,
       '0',
       cast(1990 + s_suppkey % 35 as string),
       cast(1995 + s_suppkey % 35 as string),
       '45',
       case s_nationkey % 3 when 0 then 'Drama,Crime' when 1 then 'Comedy' else null end
from supplier
union all
select concat('tt3', lpad(cast(l_orderkey as string), 9, '0'), cast(l_linenumber as string)),
       'tvEpisode',
       concat('Episode ', cast(l_orderkey as string)),
       'Episode',
       '0',
       cast(year(l_shipdate) as string),
       null,
       cast(cast(l_quantity as int) as string),
       null
from lineitem
"""

RATINGS = """
select concat('tt1', lpad(cast(p_partkey as string), 9, '0')) as tconst,
       cast(cast(cast((cast(round(p_retailprice * 10) as bigint) * 7) % 111 as decimal(10, 1))
           / 10 as decimal(4, 1)) as string) as averageRating,
       cast((p_partkey * 7919) % case when p_partkey % 3 = 0 then 12000 else 250000 end
           as string) as numVotes
from part
where p_partkey % 7 <> 0
union all
select concat('tt2', lpad(cast(s_suppkey as string), 9, '0')),
       cast(cast(cast(50 + s_suppkey % 50 as decimal(10, 1)) / 10 as decimal(4, 1)) as string),
       cast(s_suppkey * 5000 as string)
from supplier
union all
select concat('tt3', lpad(cast(l_orderkey as string), 9, '0'), cast(l_linenumber as string)),
       cast(cast(cast(40 + (l_partkey * 13 + l_linenumber) % 61 as decimal(10, 1))
           / 10 as decimal(4, 1)) as string),
       cast(l_partkey * 3 as string)
from lineitem
where l_partkey % 5 <> 0
"""

EPISODES = """
select concat('tt3', lpad(cast(l_orderkey as string), 9, '0'), cast(l_linenumber as string))
           as tconst,
       concat('tt2', lpad(cast(l_suppkey as string), 9, '0')) as parentTconst,
       cast(l_linenumber as string) as seasonNumber,
       case when l_quantity > 48 then null else cast(cast(l_quantity as int) as string) end
           as episodeNumber
from lineitem
"""

# The same rows, of which some have no key and some titles one of another kind.
_KEYS = {
    "titles": "case when tconst like '%3' then null when tconst like '%7' then replace(tconst, 'tt', 'nm')"
    " else tconst end",
    "ratings": "case when tconst like '%3' then null else tconst end",
    "episodes": "case when tconst like '%3' then null else tconst end",
}
_OTHERS = {
    "titles": "titleType, primaryTitle, originalTitle, isAdult, startYear, endYear, runtimeMinutes, genres",
    "ratings": "averageRating, numVotes",
    "episodes": "parentTconst, seasonNumber, episodeNumber",
}
DAMAGED = {
    name: f"select {_KEYS[name]} as tconst, {_OTHERS[name]} from ({text}) whole_rows"
    for name, text in (("titles", TITLES), ("ratings", RATINGS), ("episodes", EPISODES))
}

AS_OF_YEAR = 2026
_SOURCES = ("part", "supplier", "lineitem")


def _frame(spark, sf_dir, text):
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _SOURCES if t in text}
    for table in tables:
        text = text.replace(f"from {table}\n", f"from {{{table}}}\n")
    return spark.sql(text, **tables)


def raw_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, TITLES)


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, RATINGS)


def raw_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, EPISODES)


def damaged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _frame(spark, sf_dir, DAMAGED[name])


def raw_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return raw_titles(spark, sf_dir), raw_ratings(spark, sf_dir), raw_episodes(spark, sf_dir)


def write_delimited(
    df: DataFrame, path: str, compression: str = "none", most_rows: int = 0
) -> None:
    r"""Raw rows as tab-separated text with a header and ``\N`` for null.

    ``most_rows`` bounds the rows of a file, as a compressed one is read by one task.
    """
    (
        df.write.options(header=True, sep="\t", nullValue="\\N", quote="", emptyValue="")
        .options(compression=compression, maxRecordsPerFile=most_rows)
        .csv(path)
    )
