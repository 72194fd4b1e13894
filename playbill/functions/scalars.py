"""Column functions. All are built from Spark built-ins, so they stay in generated code."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c):
    """Text to int; bad text becomes null and '9.7' becomes 9, whatever the ANSI setting."""
    c = _col(c)
    decimal_text = c.rlike(r"^\s*[+-]?(\d+\.\d*|\.\d+)\s*$")
    whole_part = F.substring_index(F.trim(c), ".", 1)
    whole_part = F.when(whole_part.isin("", "+", "-"), "0").otherwise(whole_part)
    return F.coalesce(c.try_cast("int"), F.when(decimal_text, whole_part.try_cast("int")))


def lenient_float(c):
    """Text to float; bad text becomes null."""
    return _col(c).try_cast("float")


def in_range_or_null(c, low, high):
    """Predicate: null, or within [low, high]. NaN is out of range."""
    return F.coalesce(_col(c).between(low, high), F.lit(True))


def positive_or_null(c):
    """Predicate: null, or above zero."""
    return F.coalesce(_col(c) > 0, F.lit(True))


def decade(c):
    """1994 -> 1990."""
    return (F.floor(_col(c) / 10) * 10).cast("int")


def decade_label(c):
    """1994 -> '1990s'."""
    return F.concat(decade(c).cast("string"), F.lit("s"))


def band_start(c):
    """8.7 -> 8."""
    return F.floor(_col(c)).cast("int")


def band_label(c):
    """8.7 -> '8-9'."""
    low = band_start(c)
    return F.concat(low.cast("string"), F.lit("-"), (low + 1).cast("string"))


def bucket(c, edges, labels) -> Column:
    """Label a number: below ``edges[0]``, then up to and including each further edge.

    Nulls fall into the last label, as with any ELSE; filter them out beforehand.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError(f"{len(edges)} edges need {len(edges) + 1} labels, got {len(labels)}")
    c = _col(c)
    case = F.when(c < edges[0], F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:-1]):
        case = case.when(c <= edge, F.lit(label))
    return case.otherwise(F.lit(labels[-1]))


def percent_of(part, whole):
    """``part`` as a percentage of ``whole``, in double; null when ``whole`` is 0."""
    return F.try_divide(_col(part).cast("double") * 100, _col(whole).cast("double"))


def half_even(c, digits):
    """Round ties to the even neighbour."""
    return F.bround(_col(c), digits)


def list_items(c, separator=","):
    """The items of a separated text, one row each (a generator)."""
    return F.explode(F.split(_col(c), separator))


def readable_size(c):
    """Bytes as text in MiB with one decimal."""
    return F.concat(F.format_number(_col(c) / F.lit(1024 * 1024), 1), F.lit(" MiB"))
