"""What the operators share: stored tables, batches of texts, positions, a word table."""

import sys
import types
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playbill.session import fresh_path

#: Words as the contracts define them: runs of anything but the six ASCII white-space characters.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Texts a task splits at once; words as objects take some ten times the bytes of their text.
TEXT_BYTES_AT_ONCE = 2 * 1024 * 1024


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it again: short lineage, safe against loss."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def process_cache() -> dict:
    """What a Python worker keeps between tasks (models, word tables)."""
    name = "playbill_process_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def cached(key, build: Callable):
    """What ``build`` makes, kept between the tasks of a worker until another key is asked for.

    Workers outlive stages; with one thing kept, a stage has not also what the last one needed.
    """
    kept = process_cache()
    if key not in kept:
        kept.clear()
        kept[key] = build()
    return kept[key]


def bounded_slices(batch: pa.RecordBatch, text: str) -> Iterable[pa.RecordBatch]:
    """Slices of a batch with some megabytes of text each, or one longer text alone."""
    column = batch.column(text)
    sizes = np.fromiter((len(t.as_buffer()) if t.is_valid else 0 for t in column), np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > TEXT_BYTES_AT_ONCE:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def map_texts(
    df: DataFrame,
    keep: Sequence[str],
    text: str,
    function: Callable[..., tuple],
    fields: str,
    beside: str | None = None,
) -> DataFrame:
    """Rows made from texts, in batches of bounded size; a null text is an empty one.

    ``function`` gets a list of texts and returns (rows, columns): for each row it makes the
    index of its text, or None for one row each, and the columns named in ``fields``. The
    columns in ``keep`` go along. With ``beside``, the function also gets that kept column of
    equally long number lists as an array.
    """
    made = T._parse_datatype_string(fields)
    kept = [df.schema[name] for name in keep]
    schema = T.StructType([*kept, *made.fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    source_name = text if text in keep else "__text"

    def run(batches):
        for batch in batches:
            for part in bounded_slices(batch, source_name):
                texts = [t or "" for t in part.column(source_name).to_pylist()]
                more = [np.array(part.column(beside).to_pylist())] if beside else []
                rows, columns = function(texts, *more)
                own = [part.column(name) for name in keep]
                if rows is not None:
                    own = [c.take(pa.array(rows, pa.int64())) for c in own]
                made_types = [f.type for f in arrow][len(keep) :]
                arrays = [pa.array(c, t) for c, t in zip(columns, made_types)]
                own = [c.cast(f.type) for c, f in zip(own, arrow)]
                yield pa.RecordBatch.from_arrays([*own, *arrays], schema=arrow)

    source = df.select(*keep, *([F.col(text).alias("__text")] if text not in keep else []))
    return source.mapInArrow(run, schema)


def cells_for(rows: int, rows_per_cell: int = 50_000, least: int = 64) -> int:
    return max(least, -(-rows // rows_per_cell))


def with_positions(
    df: DataFrame, keys: Sequence[str], cell: Column, order: Sequence, name: str
) -> DataFrame:
    """Number the rows of each key from 0 without a gap, by cell and then by ``order``.

    A key's rows are dealt over cells, numbered there, and shifted by the sizes of the cells
    before: no task gets a whole key. Sizes are one row for each key and cell.
    """
    df = df.withColumn("__cell", cell)
    sizes = df.groupBy(*keys, "__cell").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(*keys).orderBy("__cell")
    shifts = sizes.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        F.col("__cell").alias("__key_cell"),
        (F.sum("__size").over(before) - F.col("__size")).alias("__shift"),
    )
    within = Window.partitionBy(*keys, "__cell").orderBy(*order)
    numbered = df.withColumn("__within", F.row_number().over(within) - 1)
    same = F.col("__cell") == F.col("__key_cell")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    joined = numbered.join(shifts, same)
    return joined.withColumn(name, F.col("__within") + F.col("__shift")).select(
        *[c for c in df.columns if c != "__cell"], name
    )


class _Index(dict):
    """Numbers words in the order in which they are first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word):
        self[word] = at = len(self)
        self.new.append(word)
        return at


class WordTable:
    """Ids of words met before, in flat arrays; beyond ``limit``, words met once are forgotten."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self):
        self.index = _Index()
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int32)
        self.met = np.zeros(0, np.int32)

    def _forget(self):
        """Keep the words met most, at most half of the limit."""
        often = np.sort(np.argsort(-self.met, kind="stable")[: self.limit // 2])
        often = often[self.met[often] > 1]
        words = list(self.index)
        kept = [words[i] for i in often.tolist()]
        sizes = self.sizes[often].astype(np.int64)
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[often] - ends + sizes, sizes) + np.arange(sizes.sum())
        flat, met = self.flat[at], self.met[often]
        self.clear()
        self.index.update(zip(kept, range(len(kept))))
        self.flat, self.sizes, self.met = flat, sizes.astype(np.int32), met
        self.starts = ends - sizes

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all words, one after another; how many ids each word has)."""
        if len(self.index) > self.limit:
            self._forget()
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.new:
            ids, sizes = self.encode(self.index.new)
            self.index.new = []
            self.starts = np.r_[self.starts, len(self.flat) + np.cumsum(sizes) - sizes]
            self.sizes = np.r_[self.sizes, np.asarray(sizes, np.int32)]
            self.flat = np.r_[self.flat, np.asarray(ids, np.int32)]
            self.met = np.r_[self.met, np.zeros(len(sizes), np.int32)]
        self.met += np.bincount(at, minlength=len(self.met)).astype(np.int32)
        sizes = self.sizes[at].astype(np.int64)
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[at] - ends + sizes, sizes)
        shift += np.arange(len(shift))
        return self.flat[shift], sizes
