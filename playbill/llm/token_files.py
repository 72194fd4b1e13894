"""Token ids in binary files: one array of ids, document boundaries and document ids in Elias-Fano.

A folder of token files holds all documents in ascending order of their ids. A file is

* a head of ``HEAD_BYTES`` bytes, JSON padded with spaces: ``format``, ``task`` and ``chunk`` (files
  are in order by these two), ``docs``, ``null_docs`` (documents without an id, which come first),
  ``tokens``, ``width`` (bytes an id takes: 2 where all fit, else 4), ``first_doc``, ``last_doc``;
* the ids of all its documents, one after another, little-endian and unsigned;
* the ends of its documents in that array, Elias-Fano coded over ``tokens``;
* its documents' ids less ``first_doc``, Elias-Fano coded over ``last_doc - first_doc``;
* one line break, which Spark's writer puts after every file.

An Elias-Fano sequence of n numbers up to u keeps the low ``log2(u / n)`` bits of each as they
are. The high parts are steps: number i sets the bit ``high + i``, so number i is found by
selecting the i-th one. The places of each ``SELECT_EVERY``-th one are kept in 32 bits; a select
unpacks only the bits between two of them. That is some ``2 + log2(u / n)`` bits a document,
where a table of offsets takes 64.

Writing sorts by ranges of ids, so each task has a run of documents and cuts its files by tokens
and documents: a file has a size bound however long the documents, but for one document alone.
Spark's own writer and reader do the file access, so that any store it knows will do.

A null text is an empty one, and an empty text the end id alone. Documents that share an id are
in order of their text's hash; repeated rows are written as often as they occur, and share no
task beyond a file's size. Null ids come first. Ids are whole numbers. An empty table gives no
file and no rows. Other columns play no part, whatever their names.
"""

import json
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playbill.llm.packing import ByteBpe
from playbill.llm.support import bounded_slices, cached, stored
from playbill.session import fresh_path

FORMAT = "token-ids-1"
HEAD_BYTES = 256
HEAD = (
    "format string, task long, chunk long, docs long, null_docs long, tokens long, width long, "
    "first_doc long, last_doc long"
)
SELECT_EVERY = 4096
#: Bounds of a file. A reader's task holds one as a whole, some 8 MiB where ids take two bytes;
#: executors with more memory take larger ones (``file_tokens``, ``task_bytes``).
FILE_TOKENS = 4 * 1024 * 1024
FILE_DOCS = 1024 * 1024
#: Text that a task gets, about.
TASK_TEXT_BYTES = 16 * 1024 * 1024
DOCUMENTS = "task long, chunk long, place long, doc_id long, local_start long, n_tokens long"


class EliasFano:
    """A rising sequence of whole numbers from 0 to ``universe`` in near-minimal space."""

    def __init__(self, count: int, universe: int, low: np.ndarray, high: np.ndarray, marks):
        self.count, self.universe = count, universe
        self.low, self.high, self.marks = low, high, marks

    @staticmethod
    def low_bits(count: int, universe: int) -> int:
        return max(0, (universe // count).bit_length() - 1) if count else 0

    @classmethod
    def sizes(cls, count: int, universe: int) -> tuple[int, int, int]:
        """Bytes of the low bits, of the high bits and of the places of ones."""
        if not count:
            return 0, 0, 0
        bits = cls.low_bits(count, universe)
        return -(-count * bits // 8), (count + (universe >> bits)) // 8 + 1, -(-count // SELECT_EVERY) * 4

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        count = len(values)
        bits = cls.low_bits(count, universe)
        _, high_bytes, _ = cls.sizes(count, universe)
        low = np.zeros((count, bits), np.uint8)
        for bit in range(bits):
            low[:, bit] = (values >> np.uint64(bit)) & np.uint64(1)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(count)
        steps = np.zeros(high_bytes * 8, np.uint8)
        steps[ones] = 1
        pack = {"bitorder": "little"}
        return cls(count, universe, np.packbits(low.ravel(), **pack), np.packbits(steps, **pack),
                   ones[::SELECT_EVERY].astype("<u4"))

    def to_bytes(self) -> bytes:
        return self.low.tobytes() + self.high.tobytes() + self.marks.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int, count: int, universe: int) -> tuple["EliasFano", int]:
        """The sequence that begins at a byte, without copying, and where it ends."""
        parts = []
        for size, kind in zip(cls.sizes(count, universe), (np.uint8, np.uint8, "<u4")):
            parts.append(np.frombuffer(data[at : at + size], kind))
            at += size
        return cls(count, universe, *parts), at

    def _ones(self, first: int, past: int) -> np.ndarray:
        """The places of the ones numbered from ``first``, a multiple of the step, to ``past``."""
        start = int(self.marks[first // SELECT_EVERY]) // 8
        after = -(-past // SELECT_EVERY)
        stop = int(self.marks[after]) // 8 + 1 if after < len(self.marks) else len(self.high)
        places = np.flatnonzero(np.unpackbits(self.high[start:stop], bitorder="little")) + start * 8
        skip = int(np.searchsorted(places, int(self.marks[first // SELECT_EVERY])))
        return places[skip : skip + past - first]

    def between(self, first: int, past: int) -> np.ndarray:
        """The numbers from the place ``first`` to before ``past``."""
        if past <= first:
            return np.zeros(0, np.uint64)
        from_mark = first - first % SELECT_EVERY
        ones = self._ones(from_mark, past)[first - from_mark :]
        values = (ones - np.arange(first, past)).astype(np.uint64)
        bits = self.low_bits(self.count, self.universe)
        if bits:
            start, stop = first * bits, past * bits
            packed = np.unpackbits(self.low[start // 8 : -(-stop // 8)], bitorder="little")
            own = packed[start % 8 :][: stop - start].reshape(-1, bits)
            values <<= np.uint64(bits)
            for bit in range(bits):
                values |= own[:, bit].astype(np.uint64) << np.uint64(bit)
        return values

    def select(self, place: int) -> int:
        return int(self.between(place, place + 1)[0])

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        """(place of the first, numbers) in order, a bounded number at once."""
        for first in range(0, self.count, SELECT_EVERY):
            yield first, self.between(first, min(self.count, first + SELECT_EVERY))

    def first_at_least(self, value: int) -> int:
        """The first place whose number is ``value`` or more; ``count`` if there is none."""
        low, past = 0, self.count
        while low < past:
            middle = (low + past) // 2
            low, past = (middle + 1, past) if self.select(middle) < value else (low, middle)
        return low


class TokenFile:
    """A token file in memory; arrays are views of its bytes."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        self.head = json.loads(bytes(view[:HEAD_BYTES]))
        if self.head["format"] != FORMAT:
            raise ValueError(f"not a token file of format {FORMAT}")
        self.docs, self.null_docs = self.head["docs"], self.head["null_docs"]
        tokens, width = self.head["tokens"], self.head["width"]
        at = HEAD_BYTES + tokens * width
        self.ids = np.frombuffer(view[HEAD_BYTES:at], f"<u{width}")
        self.ends, at = EliasFano.read(view, at, self.docs, tokens)
        self.first_doc = self.head["first_doc"]
        known = self.docs - self.null_docs
        spread = self.head["last_doc"] - self.first_doc if known else 0
        self.doc_ids, at = EliasFano.read(view, at, known, spread)
        if len(data) not in (at, at + 1):
            raise ValueError(f"{len(data)} bytes where the head asks for {at}")

    def doc_id(self, place: int) -> int | None:
        if place < self.null_docs:
            return None
        return self.doc_ids.select(place - self.null_docs) + self.first_doc

    def document(self, place: int) -> np.ndarray:
        """The ids of one document, by two selects."""
        start = self.ends.select(place - 1) if place else 0
        return self.ids[start : self.ends.select(place)]

    def places_of(self, doc_id: int) -> range:
        """The places of all documents with this id."""
        known = self.docs - self.null_docs
        if not known or not self.first_doc <= doc_id <= self.head["last_doc"]:
            return range(0)
        first = self.doc_ids.first_at_least(doc_id - self.first_doc)
        past = self.doc_ids.first_at_least(doc_id - self.first_doc + 1)
        return range(first + self.null_docs, past + self.null_docs)


def file_bytes(task: int, chunk: int, doc_ids: list, sizes: list[int], ids: np.ndarray) -> bytes:
    """A token file without its last line break; null document ids come first."""
    known = [d for d in doc_ids if d is not None]
    first, last = (known[0], known[-1]) if known else (0, 0)
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    head = {"format": FORMAT, "task": task, "chunk": chunk, "docs": len(doc_ids),
            "null_docs": len(doc_ids) - len(known), "tokens": len(ids), "width": width,
            "first_doc": first, "last_doc": last}
    ends = EliasFano.encode(np.cumsum(np.asarray(sizes, np.int64)), len(ids))
    # Differences of 64-bit numbers may pass 2**63 but not 2**64.
    spread = np.array(known, np.int64).astype(np.uint64) - np.array(first, np.int64).astype(np.uint64)
    own = EliasFano.encode(spread, last - first)
    text = json.dumps(head, separators=(",", ":")).encode().ljust(HEAD_BYTES)
    if len(text) != HEAD_BYTES:
        raise ValueError("the head is too long")
    array = np.ascontiguousarray(ids, f"<u{width}").data
    return b"".join((text, array, ends.to_bytes(), own.to_bytes()))


def write_token_files(
    df: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id: str = "doc_id",
    text: str = "text",
    file_tokens: int = FILE_TOKENS,
    task_bytes: int = TASK_TEXT_BYTES,
) -> None:
    """Tokenise whole texts, end each with ``end_id`` and write token files in order of ids."""
    docs = df.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    total = docs.agg(F.sum(size)).first()[0] or 0
    # The row's number spreads repeated rows over tasks; it decides between equal rows only.
    keys = ["doc_id", "__hash", "__row"]
    spread = docs.withColumns(
        {"__hash": F.xxhash64("text"), "__row": F.monotonically_increasing_id()}
    )
    tasks = int(max(1, -(-total // task_bytes)))
    ordered = spread.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)

    def run(batches):
        bpe = cached(("byte_bpe", tokenizer), lambda: ByteBpe(tokenizer))
        task, chunk, held = TaskContext.get().partitionId(), 0, 0
        doc_ids, sizes, parts = [], [], []

        def content():
            made = file_bytes(task, chunk, doc_ids, sizes, np.concatenate(parts))
            parts.clear()
            return pa.RecordBatch.from_pydict({"content": pa.array([made], pa.binary())})

        for batch in batches:
            for part in bounded_slices(batch, "text"):
                own = part.column("doc_id").to_pylist()
                encoded = bpe.encode([t or "" for t in part.column("text").to_pylist()])
                for doc_id, ids in zip(own, encoded):
                    if doc_ids and (held + len(ids) >= file_tokens or len(doc_ids) >= FILE_DOCS):
                        yield content()
                        chunk, held = chunk + 1, 0
                        doc_ids, sizes, parts = [], [], []
                    ids = np.append(ids, end_id)
                    ids = ids.astype(np.uint16 if ids.max() < 1 << 16 else np.uint32)
                    doc_ids.append(doc_id)
                    sizes.append(len(ids))
                    parts.append(ids)
                    held += len(ids)
        if doc_ids:
            yield content()

    files = ordered.select("doc_id", "text").mapInArrow(run, "content binary")
    writer = files.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1)
    writer.text(path)


def _contents(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
    return files.load(path).filter(F.col("length") > 0)


def file_index(spark: SparkSession, path: str, files_a_group: int = 1024) -> DataFrame:
    """One row for each token file: its head, its path and ``first_start``, the tokens before it.

    Only heads leave the scan. Files are numbered up in groups of tasks, then the groups.
    """
    head = F.from_json(F.substring("content", 1, HEAD_BYTES).cast("string"), HEAD).alias("head")
    heads = _contents(spark, path).select("path", head).select("path", "head.*")
    heads = stored(heads.withColumn("group", F.floor(F.col("task") / files_a_group)), "heads")
    within = Window.partitionBy("group").orderBy("task", "chunk")
    across = Window.orderBy("group")
    groups = heads.groupBy("group").agg(F.sum("tokens").alias("all"))
    before = groups.select("group", (F.sum("all").over(across) - F.col("all")).alias("before"))
    own = F.sum("tokens").over(within) - F.col("tokens")
    return heads.withColumn("own", own).join(before, "group").select(
        *[c for c in heads.columns if c != "group"],
        (F.col("before") + F.col("own")).alias("first_start"),
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    schema = f"{DOCUMENTS}, ids_crc32 long"

    def run(batches):
        for batch in batches:
            for data in batch.column("content"):
                file = TokenFile(data.as_buffer())
                yield from _described(file)

    def _described(file):
        start = 0
        for first, ends in file.ends.blocks():
            places = np.arange(first, first + len(ends))
            starts = np.r_[start, ends[:-1]].astype(np.int64)
            ends = ends.astype(np.int64)
            start = int(ends[-1])
            known = places[places >= file.null_docs] - file.null_docs
            ids = [None] * (len(places) - len(known))
            if len(known):
                own = file.doc_ids.between(int(known[0]), int(known[-1]) + 1)
                own += np.array(file.first_doc, np.int64).astype(np.uint64)
                ids += own.astype(np.int64).tolist()
            crcs = [
                zlib.crc32(file.ids[a:b].astype("<u4").tobytes())
                for a, b in zip(starts.tolist(), ends.tolist())
            ]
            same = np.ones(len(places), np.int64)
            columns = [same * file.head["task"], same * file.head["chunk"], places,
                       pa.array(ids, pa.int64()), starts, ends - starts, pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns],
                ["task", "chunk", "place", "doc_id", "local_start", "n_tokens", "ids_crc32"],
            )

    rows = _contents(spark, path).select("content").mapInArrow(run, schema)
    starts = file_index(spark, path).select("task", "chunk", "first_start")
    joined = rows.join(starts, ["task", "chunk"])
    start = (F.col("first_start") + F.col("local_start")).alias("start")
    return joined.select("doc_id", start, "n_tokens", "ids_crc32")


def look_up(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """(doc_id, ids array<int>) of the documents with one of these ids, each as often as stored.

    Only the files whose range of ids holds one are opened; there, selects lead to the documents
    without unpacking the other boundaries. The driver sees those files' paths, of which its
    listing of the folder holds more.
    """
    wanted = sorted(set(doc_ids))
    listed = F.array(*[F.lit(d) for d in wanted]).cast("array<bigint>")
    inside = F.exists(listed, lambda d: d.between(F.col("first_doc"), F.col("last_doc")))
    holding = file_index(spark, path).filter((F.col("docs") > F.col("null_docs")) & inside)
    paths = [r.path for r in holding.select("path").collect()]
    schema = "doc_id long, ids array<int>"
    if not paths:
        return spark.createDataFrame([], schema)

    def run(batches):
        for batch in batches:
            for data in batch.column("content"):
                file = TokenFile(data.as_buffer())
                for doc_id in wanted:
                    for place in file.places_of(doc_id):
                        ids = pa.array([file.document(place)], pa.list_(pa.int32()))
                        own = pa.array([doc_id], pa.int64())
                        yield pa.RecordBatch.from_arrays([own, ids], ["doc_id", "ids"])

    chosen = spark.read.format("binaryFile").load(paths)
    return chosen.select("content").mapInArrow(run, schema)


def token_round_trip(df: DataFrame, tokenizer: str, end_id: int = 2, **names) -> DataFrame:
    """Write all documents as token files, then read the files back."""
    path = fresh_path(df.sparkSession, "token-files")
    write_token_files(df, path, tokenizer, end_id, **names)
    return read_documents(df.sparkSession, path)
