"""Exact top-k inner products by a three-phase uniform threshold.

Vectors become whole numbers and are cut into ``parts`` runs of dimensions, each a node with a
list of partial scores for every query. Equal vectors are one candidate that holds its smallest
ids. Queries meet candidates in cells of bounded blocks, for each node of its own.

1. Every node gives the best local entries of each query. Their whole scores are looked up; the
   k-th best of them is a safe cutoff, as the k-th best of all is no lower.
2. The cutoff goes out with the queries. A node gives all entries that reach its uniform share,
   the cutoff over the number of nodes: a score whose parts all stay below cannot reach it.
3. Entries that not every node gave are resolved exactly from the whole vectors.

Scores are exact integers: by doubles where these hold every sum, else by 64 bits or by integers
of any size. A scaled component or a sum that 64 bits do not hold is an error, and so are vectors
of different lengths; neither gives a wrong score. Ties go to the smaller id. Vectors that are
null, empty or hold null or non-finite components take no part, nor rows with a null id; an empty
table gives no rows. Repeated rows with the same id and vector count as one. Other columns play no
part, whatever their names.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playbill.llm.support import stored

K = 5
QUERY_EVERY = 50
PARTS = 2
SEEDS = 16
SCALE = 256
QUERIES_AT_ONCE = 1024
CANDIDATES_AT_ONCE = 8192
LARGEST = 2**62
NONE = -LARGEST


def whole_numbers(df: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, v): floor(256 * x) of each usable vector."""
    x = F.col("x").cast("array<double>")
    rows = df.select(F.col(id).alias("id"), F.col(vector).alias("x"))
    usable = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & (F.size("x") > 0) & usable)
    large = F.raise_error(F.lit("a scaled component does not fit into 64 bits")).cast("long")
    whole = lambda e: F.when(F.abs(SCALE * e) < LARGEST, F.floor(SCALE * e)).otherwise(large)
    return rows.select("id", F.transform(x, whole).alias("v"))


def _blocks(count, size):
    return max(1, -(-count // size))


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1) if len(values) else np.zeros((0, 0), np.int64)


def _reach(queries: np.ndarray, candidates: np.ndarray) -> int:
    """A bound of all sums, exact."""
    sides = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (queries, candidates)]
    return sides[0] * sides[1] * max(1, queries.shape[1])


def _in_64_bits(scores: np.ndarray) -> np.ndarray:
    if scores.size and max(abs(scores.min()), abs(scores.max())) >= LARGEST:
        raise ValueError("a score does not fit into 64 bits")
    return scores.astype(np.int64)


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of all queries with all candidates."""
    reach = _reach(queries, candidates)
    if reach < 2**53:
        return np.rint(queries.astype(float) @ candidates.T.astype(float)).astype(np.int64)
    if reach < LARGEST:
        return queries @ candidates.T
    return _in_64_bits(queries.astype(object) @ candidates.T.astype(object))


def pair_products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of queries with candidates row by row."""
    if _reach(queries, candidates) < LARGEST:
        return (queries * candidates).sum(1)
    return _in_64_bits((queries.astype(object) * candidates.astype(object)).sum(1))


class Cells:
    """Queries and candidates dealt over cells of bounded blocks, with a part of each vector."""

    def __init__(self, queries: DataFrame, candidates: DataFrame, width: int, parts: int):
        self.width, self.parts = width, min(parts, width)
        self.q_blocks = _blocks(queries.count(), QUERIES_AT_ONCE)
        self.c_blocks = _blocks(candidates.count(), CANDIDATES_AT_ONCE)
        self.queries, self.candidates = queries, candidates

    def q_block(self):
        return F.pmod(F.xxhash64("q"), F.lit(self.q_blocks)).cast("int")

    def c_block(self):
        return F.pmod(F.xxhash64("c"), F.lit(self.c_blocks)).cast("int")

    def _dealt(self, queries, by_part):
        """Both sides with the columns (part, q_block, c_block), vectors cut to their part."""
        cuts = np.linspace(0, self.width, self.parts + 1).astype(int) if by_part else [0, self.width]
        part = F.explode(
            F.array(*[
                F.struct(
                    F.lit(i).alias("part"), F.slice("v", int(a) + 1, int(b - a)).alias("v")
                )
                for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
            ])
        )
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = queries.select(*[c for c in queries.columns if c != "v"], part.alias("p"))
        left = left.select("*", self.q_block().alias("q_block"), every(self.c_blocks).alias("c_block"))
        right = self.candidates.select("c", part.alias("p"))
        right = right.select("*", every(self.q_blocks).alias("q_block"), self.c_block().alias("c_block"))
        return [d.select("p.part", "p.v", *[c for c in d.columns if c != "p"]) for d in (left, right)]

    def local_best(self, most: int) -> DataFrame:
        """Phase 1: (part, q, c, local), the best entries of each query in each cell."""
        left, right = self._dealt(self.queries, True)

        def run(key, q, c):
            if not q.num_rows or not c.num_rows:
                return _table([[], [], [], []], ["part", "q", "c", "local"])
            names = c.column("c").to_numpy()
            order = np.argsort(names)
            scores = products(_matrix(q.column("v")), _matrix(c.column("v"))[order])
            best = np.argsort(-scores, axis=1, kind="stable")[:, :most]
            rows = np.repeat(np.arange(q.num_rows), best.shape[1])
            found = best.ravel()
            part = np.full(len(rows), key[0].as_py())
            return _table(
                [part, q.column("q").to_numpy()[rows], names[order][found], scores[rows, found]],
                ["part", "q", "c", "local"],
            )

        return self._together(left, right, run, "part long, q long, c long, local long")

    def reaching(self, cutoffs: DataFrame) -> DataFrame:
        """Phase 2: (q, c, local) of all entries that reach their node's share of the cutoff."""
        left, right = self._dealt(self.queries.join(cutoffs, "q"), True)
        parts = self.parts

        def run(key, q, c):
            if not q.num_rows or not c.num_rows:
                return _table([[], [], []], ["q", "c", "local"])
            scores = products(_matrix(q.column("v")), _matrix(c.column("v")))
            cutoff = q.column("cutoff").to_numpy()
            rows, found = np.nonzero(scores >= -(-cutoff // parts)[:, None])
            return _table(
                [q.column("q").to_numpy()[rows], c.column("c").to_numpy()[found], scores[rows, found]],
                ["q", "c", "local"],
            )

        return self._together(left, right, run, "q long, c long, local long")

    def resolved(self, pairs: DataFrame) -> DataFrame:
        """(q, c, score): the whole scores of pairs."""
        left, right = self._dealt(self.queries, False)
        both = left.select("q_block", "c_block", F.lit(0).alias("kind"), "q", F.lit(0).cast("long").alias("c"), "v")
        both = both.unionByName(
            right.select("q_block", "c_block", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("q"), "c", "v")
        ).unionByName(
            pairs.select(
                self.q_block().alias("q_block"), self.c_block().alias("c_block"),
                F.lit(2).alias("kind"), "q", "c", F.lit(None).cast("array<long>").alias("v"),
            )
        )

        def run(rows):
            kind = rows.column("kind").to_numpy()
            names = [rows.column(n).to_numpy() for n in ("q", "c")]
            asked = np.flatnonzero(kind == 2)
            if not len(asked):
                return _table([[], [], []], ["q", "c", "score"])
            sides = []
            for side in (0, 1):
                at = np.flatnonzero(kind == side)
                at = at[np.argsort(names[side][at])]
                vectors = _matrix(rows.column("v").combine_chunks().take(pa.array(at)))
                sides.append((vectors, np.searchsorted(names[side][at], names[side][asked])))
            (q, q_at), (c, c_at) = sides
            scores = np.concatenate([
                pair_products(q[q_at[i : i + 65536]], c[c_at[i : i + 65536]])
                for i in range(0, len(asked), 65536)
            ])
            return _table([names[0][asked], names[1][asked], scores], ["q", "c", "score"])

        return both.groupBy("q_block", "c_block").applyInArrow(run, "q long, c long, score long")

    @staticmethod
    def _together(left, right, run, schema):
        keys = ("part", "q_block", "c_block")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _table(columns, names):
    return pa.table([pa.array(np.asarray(c, np.int64)) for c in columns], names)


def _best_of(df, by, order, most, rank=F.row_number):
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__rank", rank().over(window)).filter(F.col("__rank") <= most)


def top_k(
    df: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    every: int = QUERY_EVERY,
    parts: int = PARTS,
) -> DataFrame:
    """(query_id, rank, id, score): the best rows for each row whose id divides by ``every``."""
    rows = stored(whole_numbers(df, id, vector), "vectors")
    lengths = rows.select(F.size("v").alias("n")).distinct().orderBy("n").take(2)
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths, {lengths[0].n} and {lengths[1].n}")
    if not lengths:
        nothing = rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0).cast("long").alias("score"))
        return nothing.withColumnRenamed("id", id)
    width = lengths[0].n
    rows = rows.distinct().withColumn("h", F.xxhash64("v"))
    # A query needs at most k + 1 rows of one vector, itself among them.
    few = _best_of(rows, ["h", "v"], ["id"], k + 1)
    vectors = few.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    vectors = stored(vectors.withColumn("c", F.col("ids")[0]), "distinct-vectors")
    asking = rows.filter(F.col("id") % every == 0)
    firsts = asking.groupBy("h", "v").agg(F.min("id").alias("q"))
    queries = stored(firsts, "query-vectors")
    cells = Cells(queries.select("q", "v"), vectors.select("c", "v"), width, parts)
    need = k + 1

    order = [F.desc("local"), "c"]
    seeds = _best_of(cells.local_best(SEEDS), ["part", "q"], order, SEEDS).select("q", "c")
    known = stored(cells.resolved(seeds.distinct()), "seed-scores")
    kth = _best_of(known, ["q"], [F.desc("score"), "c"], need)
    kth = kth.filter(F.col("__rank") == need).select("q", F.col("score").alias("cutoff"))
    cutoffs = queries.select("q").join(kth, "q", "left")
    cutoffs = stored(cutoffs.fillna(NONE, ["cutoff"]), "cutoffs")

    entries = cells.reaching(cutoffs).groupBy("q", "c")
    entries = entries.agg(F.sum("local").alias("score"), F.count(F.lit(1)).alias("given"))
    entries = stored(entries, "entries")
    whole = entries.filter(F.col("given") == cells.parts).select("q", "c", "score")
    rest = cells.resolved(entries.filter(F.col("given") < cells.parts).select("q", "c"))
    scores = whole.unionByName(rest).join(cutoffs, "q").filter("score >= cutoff")
    best = _best_of(scores, ["q"], [F.desc("score")], need, F.rank).select("q", "c", "score")
    # From vectors back to rows.
    listed = best.join(vectors.select("c", "ids"), "c")
    listed = listed.select("q", "score", F.explode("ids").alias("found"))
    listed = stored(
        _best_of(listed, ["q"], [F.desc("score"), "found"], need).drop("__rank"), "best-rows"
    )
    owners = asking.join(queries.select("h", "v", "q"), ["h", "v"]).select(
        F.col("id").alias("query_id"), "q"
    )
    pairs = owners.join(listed, "q").filter("query_id <> found")
    ranked = _best_of(pairs, ["query_id"], [F.desc("score"), "found"], k)
    return ranked.select(
        "query_id", F.col("__rank").alias("rank"), F.col("found").alias(id), "score"
    )
