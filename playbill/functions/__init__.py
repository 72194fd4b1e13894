from playbill.functions.scalars import (
    band_label,
    band_start,
    bucket,
    decade,
    decade_label,
    half_even,
    in_range_or_null,
    lenient_float,
    lenient_int,
    list_items,
    percent_of,
    positive_or_null,
    readable_size,
)

__all__ = [
    "band_label",
    "band_start",
    "bucket",
    "decade",
    "decade_label",
    "half_even",
    "in_range_or_null",
    "lenient_float",
    "lenient_int",
    "list_items",
    "percent_of",
    "positive_or_null",
    "readable_size",
]
