"""Values that results depend on.

Fixed values: every name, bound, threshold, edge and label below has to equal the
published definition of the data set or of a report, so they are stated here as they are.
"""

# --- Fixed values: input files -------------------------------------------------------
NULL_MARKER = "\\N"
TITLES_FILE = "title.basics.tsv"
RATINGS_FILE = "title.ratings.tsv"
EPISODES_FILE = "title.episode.tsv"

# --- Fixed values: cleaning rules ----------------------------------------------------
KEY_PREFIX = "tt"
FIRST_YEAR = 1874
YEARS_AHEAD = 5
LOWEST_RATING = 0.0
HIGHEST_RATING = 10.0
UNKNOWN_GENRE = "Unknown"
GENRE_SEPARATOR = ","

# --- Fixed values: layout ------------------------------------------------------------
LAKE_PARTITIONS = ("title_type", "start_year")
RECENT_YEARS = 5
RECENT_MIN_VOTES = 1000

# --- Fixed values: runtime buckets ---------------------------------------------------
# A value below the first edge gets the first label, a value up to and including edge i
# gets label i, anything else gets the last label.
RUNTIME_EDGES_BY_TYPE = (30, 60, 120, 180)
RUNTIME_LABELS_BY_TYPE = (
    "Short (<30min)",
    "Medium (30-60min)",
    "Standard (1-2hr)",
    "Long (2-3hr)",
    "Very Long (>3hr)",
)
RUNTIME_EDGES_HISTOGRAM = (30, 90, 150)
RUNTIME_LABELS_HISTOGRAM = ("Short", "Medium", "Standard", "Long")
RUNTIME_EDGES_MOVIES = (30, 60, 120, 180)
RUNTIME_LABELS_MOVIES = ("<30 min", "30-60 min", "1-2 hours", "2-3 hours", ">3 hours")
RUNTIME_EDGES_PANEL = (30, 60, 120, 180)
RUNTIME_LABELS_PANEL = ("Under 30m", "30-60m", "1-2 hrs", "2-3 hrs", "3+ hrs")
