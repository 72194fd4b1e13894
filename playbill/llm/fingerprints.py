"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

Fingerprints of 64 bits are cut into three segments. Of two fingerprints that differ in at most
two bits, one segment is equal and another differs in at most one bit. The keys of a fingerprint
are therefore, for each ordered pair of segments, the first one as it is with each codeword index
that the second one decodes to. The Golay code is perfect with radius 3: a word within 2 of its
codeword has that index alone, a word at 3 also has the indices of the five codewords at 4. Two
words one bit apart always share an index.

Fingerprints that share a key are compared. A key with more than ``most`` fingerprints is not
compared pair by pair: its fingerprints go, exactly, to all 65 points within one bit of them, and
those that meet in a point are within two bits of each other. A point has at most 65 of them, so
no group grows with the data. Groups are linked by their smallest member.

Null and empty texts have fingerprint zero and are linked like any other. Rows with a null id take
part; their component is the smallest id reachable, null only if there is none. Copies, ties and
repeated rows share a component. An empty table gives no rows. Other columns may have any names.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.support import cached, map_texts, stored

SEED = 42
SHINGLE_WORDS = 3
#: (first bit, bits) of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MOST_COMPARED = 64
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a fixed value of the code
GOLAY_BITS, GOLAY_DATA = 23, 12
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """The bits that are set in over half of the shingles' hashes."""
    parts = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*[parts[i:] for i in range(words)]))
    return _majority([xxhash.xxh64_intdigest(s, SEED) for s in shingles])


def _majority(values: list[int]) -> int:
    hashes = np.array(values, "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_hash, fp): one row for each document; fp is the fingerprint as a signed long."""
    hashed = df.select(id, F.xxhash64(text).alias("text_hash"), F.col(text).alias("__whole"))

    def run(texts):
        values = np.array([fingerprint(t) for t in texts], np.uint64)
        return None, [values.view(np.int64)]

    return map_texts(hashed, [id, "text_hash"], "__whole", run, "fp long")


class Golay:
    """Tables of the [23, 12] code: the error of each remainder, and codewords at distance 4."""

    def __init__(self):
        self.remainder_of_bit = np.array([_remainder(1 << i) for i in range(GOLAY_BITS)])
        self.error = np.zeros(1 << 11, np.int64)
        self.weight = np.zeros(1 << 11, np.int64)
        bits = 1 << np.arange(GOLAY_BITS)
        for i in range(GOLAY_BITS):
            self._set(bits[i], 1)
            for j in range(i):
                self._set(bits[i] | bits[j], 2)
                for k in range(j):
                    self._set(bits[i] | bits[j] | bits[k], 3)

    def _set(self, error, weight):
        at = _remainder(int(error))
        self.error[at], self.weight[at] = error, weight

    def remainder(self, words: np.ndarray) -> np.ndarray:
        found = np.zeros(len(words), np.int64)
        for i, r in enumerate(self.remainder_of_bit):
            found ^= np.where(words >> i & 1, r, 0)
        return found

    def indices(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, index) of all codewords that stand for each word."""
        at = self.remainder(words)
        rows, found = [np.arange(len(words))], [words ^ self.error[at]]
        deep = np.flatnonzero(self.weight[at] == 3)
        for i in range(GOLAY_BITS):
            beside = words[deep] ^ (1 << i)
            code = beside ^ self.error[self.remainder(beside)]
            rows.append(deep)
            found.append(code)
        row = np.concatenate(rows)
        index = np.concatenate(found) >> (GOLAY_BITS - GOLAY_DATA)
        both = np.sort(row << GOLAY_DATA | index)
        both = both[np.r_[True, both[1:] != both[:-1]]] if len(both) else both
        return both >> GOLAY_DATA, both & ((1 << GOLAY_DATA) - 1)


def _remainder(word: int) -> int:
    for i in range(GOLAY_BITS - 1, 10, -1):
        if word >> i & 1:
            word ^= GENERATOR << (i - 11)
    return word


def golay_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of each 64-bit value: ordered pair, exact segment, codeword index."""
    code = cached("golay", Golay)
    parts = [(values >> np.uint64(s)) & np.uint64((1 << n) - 1) for s, n in SEGMENTS]
    parts = [p.astype(np.int64) for p in parts]
    rows, keys = [], []
    for j in range(len(SEGMENTS)):
        row, index = code.indices(parts[j])
        for i in range(len(SEGMENTS)):
            if i != j:
                pair = (i * len(SEGMENTS) + j) << 40
                rows.append(row)
                keys.append(pair | parts[i][row] << GOLAY_DATA | index)
    return np.concatenate(rows), np.concatenate(keys)


def with_keys(values: DataFrame) -> DataFrame:
    """(fp, key) for distinct fingerprints."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column("fp").slice(at, 4096).to_numpy(zero_copy_only=False)
                row, key = golay_keys(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(fp[row]), pa.array(key)], ["fp", "key"])

    return values.select("fp").mapInArrow(run, "fp long, key long")


def links(values: DataFrame, most: int = MOST_COMPARED) -> DataFrame:
    """(a, b), a < b: links that join all distinct fingerprints within two bits of each other."""
    keys = with_keys(values)
    sizes = stored(keys.groupBy("key").count().filter("count > 1"), "key-sizes")
    met = stored(keys.join(sizes, "key"), "key-members")
    few = met.filter(F.col("count") <= most).select("key", "fp")
    left, right = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b")
    near = F.expr("a < b and bit_count(a ^ b) <= 2")
    pairs = left.join(right, "key").filter(near).select("a", "b")
    many = met.filter(F.col("count") > most).select("fp").distinct()
    flips = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    points = many.select("fp", F.explode(flips).alias("point"))
    by_point = points.groupBy("point").agg(F.collect_list("fp").alias("near"))  # 65 at most
    stars = by_point.filter(F.size("near") > 1).select(
        F.array_min("near").alias("a"), F.explode("near").alias("b")
    )
    return pairs.unionByName(stars.filter("a < b")).distinct()


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has a link.

    Large-star and small-star rounds, each written to the shared folder, until no link changes.
    """
    edges = stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), "m")
        large = large.filter("u <> m").distinct().withColumnRenamed("m", "v")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = stored(small, "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        now = tuple(state.first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select("v").distinct().select("v", F.col("v").alias("m"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _rooted(df: DataFrame, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, fp) of each document, and (fp, first_id, root) of each fingerprint."""
    rows = stored(fingerprints(df, id, text), "fingerprints")
    values = stored(rows.groupBy("fp").agg(F.min(id).alias("first_id")), "values")
    root = components(links(values)).select(F.col("node").alias("fp"), "root")
    rooted = values.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return rows, stored(rooted, "rooted")


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_hash, fingerprint, component_id) of every document."""
    rows, rooted = _rooted(df, id, text)
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = stored(rooted.join(first, "root").select("fp", "component_id"), "components")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(found, "fp").select(id, "text_hash", digits, "component_id")


def one_of_each(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` with one document of each group of ``near_duplicates`` left.

    The row with the smallest id stays; nulls come last, rows with equal ids are told apart by
    their text, and equal rows are one.
    """
    rows, rooted = _rooted(df, id, text)
    place = F.struct(F.col(id).isNull().alias("no_id"), F.col(id).alias("id"), "text_hash")
    firsts = rows.groupBy("fp").agg(F.min(place).alias("p"), F.count(F.lit(1)).alias("rows"))
    groups = firsts.join(rooted.select("fp", "root"), "fp").groupBy("root")
    chosen = stored(groups.agg(F.min("p").alias("p"), F.sum("rows").alias("rows")), "chosen")
    # The columns of the input go along as one, so none of their names can clash.
    whole = df.select(F.struct(*df.columns).alias("r"), F.col(id).alias("d"), F.xxhash64(text).alias("h"))
    kept = chosen.select(F.col("p.id").alias("k"), F.col("p.text_hash").alias("t"), "rows")
    found = whole.join(kept, F.col("d").eqNullSafe(F.col("k")) & (F.col("h") == F.col("t")))
    alone = found.filter("rows = 1").select("r.*")
    # Of several equal rows any one, as nothing tells them apart.
    repeated = found.filter("rows > 1").dropDuplicates(["d", "h"]).select("r.*")
    return alone.unionByName(repeated)
