"""The parametric query shapes that the named reports are made of.

Every shape takes a frame and returns a frame. ``where`` is a condition (text or column),
``years`` a pair of bounds that also prunes decade folders, ``order`` a list of output names
with a leading ``-`` for descending, ``digits`` a mapping from an output name to the number of
decimals it is rounded to (half to even) before ordering. Keys and measures map output names
to columns, to SQL text, or to functions that make a column. Shapes aggregate before anything is
shuffled, and never gather ungrouped rows in one task.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.functions import bucket, decade, half_even, list_items, percent_of
from playbill.sources.tables import years_between

Spec = Mapping[str, Column | str | Callable[[], Column]]


def rows() -> Column:
    return F.count(F.lit(1))


def mean(column: str) -> Column:
    """Average in double; float input is widened first."""
    return F.avg(F.col(column).cast("double"))


def _select_rows(df, where, years):
    if years is not None:
        df = years_between(df, *years)
    return df if where is None else df.filter(where)


def _sort_columns(order):
    return [F.col(n[1:]).desc() if n.startswith("-") else F.col(n).asc() for n in order]


def _finish(df, having, order, limit):
    if having is not None:
        df = df.filter(having)
    if order:
        df = df.orderBy(*_sort_columns(order))
    return df if limit is None else df.limit(limit)


def _column(c):
    if isinstance(c, str):
        return F.expr(c)
    return c() if callable(c) and not isinstance(c, Column) else c


def _aliased(spec: Spec, digits: Mapping[str, int] | None = None):
    columns = {name: _column(c) for name, c in spec.items()}
    for name in set(digits or ()) & set(columns):
        columns[name] = half_even(columns[name], digits[name])
    return [c.alias(name) for name, c in columns.items()]


def grouped(
    df: DataFrame,
    keys: Spec,
    measures: Spec,
    where=None,
    years=None,
    having=None,
    order: Sequence[str] = (),
    limit: int | None = None,
    digits: Mapping[str, int] | None = None,
    hidden: Sequence[str] = (),
) -> DataFrame:
    """Measures per group; keys may be computed, and there may be none.

    ``hidden`` measures serve ``having`` and ``order`` only.
    """
    picked = _select_rows(df, where, years)
    summed = picked.groupBy(*_aliased(keys)).agg(*_aliased(measures, digits))
    finished = _finish(summed, having, order, limit)
    return finished.drop(*hidden) if hidden else finished


def distribution(
    df: DataFrame,
    keys: Spec,
    measures: Spec,
    count_name: str,
    share_name: str,
    where=None,
    years=None,
    order: Sequence[str] = (),
    digits: Mapping[str, int] | None = None,
) -> DataFrame:
    """Row count per group with its percentage of all rows, and further measures.

    The total is a one-row subquery that reads no more than the filter needs, so the number of
    groups is not limited by one task as it would be with a window over all groups.
    """
    picked = _select_rows(df, where, years)
    total = picked.agg(rows().alias("total")).scalar()
    share = percent_of(rows(), total)
    every = {count_name: rows, share_name: share, **measures}
    shared = picked.groupBy(*_aliased(keys)).agg(*_aliased(every, digits))
    return _finish(shared, None, order, None)


def top_k(
    df: DataFrame,
    columns: Mapping[str, str],
    k: int,
    order: Sequence[str],
    where=None,
    years=None,
    tie_break: str = "tconst",
) -> DataFrame:
    """The first ``k`` rows by ``order`` (input names); equal rows are taken by ``tie_break``."""
    picked = _select_rows(df, where, years)
    first = picked.orderBy(*_sort_columns([*order, tie_break])).limit(k)
    return first.select(*_aliased(columns))


def by_decade(
    df: DataFrame,
    measures: Spec,
    keys: Spec | None = None,
    decade_of: Column | Callable[[], Column] | None = None,
    **options,
) -> DataFrame:
    """Measures per decade and further keys."""
    first = {"decade": decade("start_year") if decade_of is None else decade_of}
    return grouped(df, {**first, **(keys or {})}, measures, **options)


def per_item(
    df: DataFrame,
    measures: Spec,
    list_column: str = "genres",
    item: str = "genre",
    where=None,
    years=None,
    **options,
) -> DataFrame:
    """Measures per item of a separated list column; a row counts once per item it has.

    The exploded rows never leave their task: they are partially aggregated first.
    """
    picked = _select_rows(df, where, years)
    used = [c for c in picked.columns if c != item]
    exploded = picked.select(*used, list_items(list_column).alias(item))
    return grouped(exploded, {item: item}, measures, **options)


def distinct_items(
    df: DataFrame,
    name: str,
    list_column: str = "genres",
    where=None,
    approximate: bool = False,
) -> DataFrame:
    """Number of different items in a separated list column."""
    items = _select_rows(df, where, None).select(list_items(list_column).alias("item"))
    count = F.approx_count_distinct("item") if approximate else F.count_distinct("item")
    return items.agg(count.alias(name))


def child_rollup(
    df: DataFrame,
    group: Mapping[str, str],
    children: str,
    count_name: str,
    parents: str | None = None,
    last_of: tuple[str, str] | None = None,
    mean_of: tuple[str, str] | None = None,
    key: str = "tconst",
    parent_key: str = "parent_tconst",
    having=None,
    order: Sequence[str] = (),
    limit: int | None = None,
    digits: Mapping[str, int] | None = None,
) -> DataFrame:
    """Child rows joined to their parent and summed per group of parents.

    ``group`` maps output names to parent columns; ``last_of`` and ``mean_of`` are
    (output name, child column). Children are summed per parent before the join, so a parent
    with a great share of all children is one row there and cannot skew it.
    """
    partial = [rows().alias("n")]
    if last_of:
        partial.append(F.max(last_of[1]).alias("last"))
    if mean_of:
        value = F.col(mean_of[1]).cast("double")
        partial += [F.sum(value).alias("total"), F.count(value).alias("known")]
    per_parent = (
        df.filter(children)
        .filter(F.col(parent_key).isNotNull())
        .groupBy(F.col(parent_key).alias("parent"))
        .agg(*partial)
    )
    parent_rows = _select_rows(df, parents, None).select(
        F.col(key).alias("parent"), *_aliased(group)
    )

    measures = {count_name: F.sum("n")}
    if last_of:
        measures[last_of[0]] = F.max("last")
    if mean_of:
        measures[mean_of[0]] = F.try_divide(F.sum("total"), F.sum("known"))
    joined = parent_rows.join(per_parent, "parent")
    summed = joined.groupBy(*group).agg(*_aliased(measures, digits))
    return _finish(summed, having, order, limit)


def period_change(
    df: DataFrame,
    years: tuple[int, int],
    count_name: str,
    change_name: str,
    percent_name: str,
    where=None,
    digits: Mapping[str, int] | None = None,
) -> DataFrame:
    """Rows per start year with the change from the year before it that has rows.

    The first year's change is its own count, its percentage is null. The window runs over
    the yearly counts only: at most ``last - first + 1`` rows.
    """
    picked = _select_rows(df, where, years)
    counted = picked.groupBy("start_year").agg(rows().alias(count_name))
    before = F.lag(count_name, 1, 0).over(Window.orderBy("start_year"))
    change = F.col(count_name) - before
    changes = {change_name: change, percent_name: percent_of(change, before)}
    changed = counted.select("start_year", count_name, *_aliased(changes, digits))
    return changed.orderBy("start_year")


def histogram(
    df: DataFrame,
    column: str,
    edges: Sequence[int],
    labels: Sequence[str],
    measures: Spec,
    bucket_name: str,
    keys: Spec | None = None,
    **options,
) -> DataFrame:
    """Measures per labelled bucket of a number, and per further keys put before it."""
    all_keys = {**(keys or {}), bucket_name: bucket(column, edges, labels)}
    return grouped(df, all_keys, measures, **options)


def described(
    df: DataFrame,
    key: str,
    value: str,
    count_name: str,
    mean_name: str,
    min_name: str,
    max_name: str,
    median_name: str | None = None,
    approximate: bool = False,
    **options,
) -> DataFrame:
    """Count, mean, extremes and, if named, the median of a value per key.

    The exact median keeps one counter per different value and group, which is small for
    values on a fixed scale such as ratings; for others set ``approximate``.
    """
    wide = F.col(value).cast("double")
    measures = {count_name: rows(), mean_name: F.avg(wide)}
    if median_name:
        middle = F.percentile_approx(wide, F.lit(0.5)) if approximate else F.median(wide)
        measures[median_name] = middle
    measures |= {min_name: F.min(value), max_name: F.max(value)}
    return grouped(df, {key: key}, measures, **options)


def headline(df: DataFrame, measures: Spec, where=None, digits=None) -> DataFrame:
    """One row of measures over the whole frame, in one pass."""
    return grouped(df, {}, measures, where=where, digits=digits)
