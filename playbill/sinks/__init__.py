from playbill.sinks.folders import (
    write_by_genre,
    write_lake,
    write_leaderboard,
    write_rollup,
    write_serving,
)
from playbill.sinks.tables import (
    ensure_tables,
    load_by_genre,
    load_leaderboard,
    load_table,
    load_titles,
)

__all__ = [
    "ensure_tables",
    "load_by_genre",
    "load_leaderboard",
    "load_table",
    "load_titles",
    "write_by_genre",
    "write_lake",
    "write_leaderboard",
    "write_rollup",
    "write_serving",
]
