from playbill.sources.delimited import read_delimited, read_raw
from playbill.sources.tables import (
    partition_summary,
    read_by_genre,
    read_lake,
    read_serving,
    years_between,
)

__all__ = [
    "partition_summary",
    "read_by_genre",
    "read_delimited",
    "read_lake",
    "read_raw",
    "read_serving",
    "years_between",
]
