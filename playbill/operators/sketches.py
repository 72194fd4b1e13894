"""Medians and distinct counts as states that are stored, merged and read for any range of years.

An exact median or distinct count cannot be added up from those of its parts. Sketches can: they
are small, their size does not grow with the rows, and the sketch of all parts is made of the
parts' sketches. What is read from them is an estimate within a stated error; the exact figures
stay the default of the reports. Sketches cannot take rows back, so a load of changes makes those
of the touched folders again.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill import fixed_values as V
from playbill.schemas import SKETCHES

#: Size of the quantile sketches, and the share of all values by which the rank of a quantile may
#: be off. A sketch of this size is off by 2.296 / 1024 ** 0.9723 = 0.0027 in 99 of 100 cases.
QUANTILE_SIZE, RANK_ERROR = 1024, 0.01
#: Binary logarithm of the cells of the distinct sketches, and the share by which a count may be
#: off: the standard error is 1.04 / 128 = 0.0081. Below some thousand values they are exact.
DISTINCT_BITS, DISTINCT_ERROR = 14, 0.04


def sketch_state(titles: DataFrame) -> DataFrame:
    """Per decade, type and year (0 = unknown): sketches of the ratings, keys and genres.

    ``titles`` are rows of the serving table. Null ratings and keys and the unknown genre are not
    counted. One pass and one shuffle: a row is followed by one for each genre it names, and the
    sketches are made in the map tasks, so a type with a third of all rows is one row of each task.
    """
    nothing = F.lit(None).cast("string")
    rating = F.col("average_rating").cast("double")
    own = F.struct(rating.alias("rating"), F.col("tconst").alias("title"), nothing.alias("genre"))
    named = F.coalesce(F.split("genres", V.GENRE_SEPARATOR), F.array().cast("array<string>"))
    genres = F.transform(
        F.filter(named, lambda g: g != V.UNKNOWN_GENRE),
        lambda g: F.struct(
            F.lit(None).cast("double").alias("rating"), nothing.alias("title"), g.alias("genre")
        ),
    )
    seen = titles.select(
        "decade",
        "title_type",
        F.coalesce("start_year", F.lit(0)).alias("start_year"),
        F.explode(F.concat(F.array(own), genres)).alias("seen"),
    )
    return (
        seen.groupBy("decade", "title_type", "start_year")
        .agg(
            F.count("seen.rating").alias("rated"),
            F.kll_sketch_agg_double("seen.rating", QUANTILE_SIZE).alias("rating_sketch"),
            F.hll_sketch_agg("seen.title", DISTINCT_BITS).alias("title_sketch"),
            F.hll_sketch_agg("seen.genre", DISTINCT_BITS).alias("genre_sketch"),
        )
        .select(SKETCHES.fieldNames())
    )


def merge_sketches(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One state for each group of ``by``, or one of all rows, from the stored ones.

    States without any rating are left out of the quantile sketch, which is null if none is left.
    """
    rated = F.when(F.col("rated") > 0, F.col("rating_sketch"))
    return state.groupBy(*by).agg(
        F.coalesce(F.sum("rated"), F.lit(0)).alias("rated"),
        F.kll_merge_agg_double(rated, QUANTILE_SIZE).alias("rating_sketch"),
        F.hll_union_agg("title_sketch").alias("title_sketch"),
        F.hll_union_agg("genre_sketch").alias("genre_sketch"),
    )


def sketch_estimates(
    merged: DataFrame, quantiles: Sequence[float] = (0.5,), by: Sequence[str] = ()
) -> DataFrame:
    """What merged states say: ``rated`` (exact), ``titles`` and ``genres`` (within
    ``DISTINCT_ERROR``), and ``rating_quantiles``, one for each share in ``quantiles``.

    A quantile is a value that occurs, whose rank is within ``RANK_ERROR``; shares 0 and 1 give
    the exact extremes. Groups without a rating have null quantiles.
    """
    if not all(0 <= q <= 1 for q in quantiles):
        raise ValueError(f"quantiles are shares from 0 to 1, not {list(quantiles)}")
    read = [F.kll_sketch_get_quantile_double("rating_sketch", F.lit(float(q))) for q in quantiles]
    return merged.select(
        *by,
        "rated",
        F.hll_sketch_estimate("title_sketch").alias("titles"),
        F.hll_sketch_estimate("genre_sketch").alias("genres"),
        F.when(F.col("rated") > 0, F.array(*read)).alias("rating_quantiles"),
    )
