"""A quality classifier: a factorisation machine over words, structure and metadata.

Inputs are hashed words, statistics of the text's structure, and numeric metadata columns. Each
statistic falls into bins whose edges come from the training rows. Every input has a weight and a
short vector; the score adds, to the weighted inputs, the products of the vectors of all pairs of
inputs. The sum-of-squares identity gives all pairs in time linear in the inputs.

Fitting takes at most ``most_rows`` labelled rows, those with the smallest hashes, and is done on
the driver; its features are ``most_rows`` short lists. Scoring covers every whole text.

Null texts are empty ones and have a score like any other; null metadata counts as 0, rows with a
null label are not learnt from. Without both labels among the rows, every score is the share of
the label that is there (0.5 without rows).
"""

import unicodedata
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.support import cached, map_texts

MOST_ROWS = 10_000
BUCKETS = 4096
RANK = 6
BINS = 12
THRESHOLD = 0.3
STATISTICS = (
    "log_words", "word_length", "distinct", "top_word", "repeats_previous", "duplicate_lines",
    "upper", "digit", "mark", "symbol", "other", "wordless", "loud_words", "capital_words",
    "words_in_line",
)


def _classes() -> np.ndarray:
    """Class of each code point: 0 lower or other letter, 1 upper, 2 digit, 3 mark, 4 symbol,
    5 space, 6 anything else; code points beyond the first plane are other letters."""
    kinds = {"L": 0, "N": 2, "P": 3, "S": 4, "Z": 5, "M": 0}
    found = np.zeros(1 << 16, np.uint8)
    for i in range(1 << 16):
        kind = unicodedata.category(chr(i))
        found[i] = 1 if kind == "Lu" else kinds.get(kind[0], 6)
    found[[9, 10, 11, 12, 13]] = 5
    return found


def statistics(text: str, words: list[bytes], counts: Counter) -> list[float]:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = cached("classes", _classes)[np.minimum(codes, (1 << 16) - 1)]
    upper = np.bincount(classes, minlength=7).astype(float)
    letters = max(1.0, upper[0] + upper[1])
    visible = max(1.0, len(codes) - upper[5])
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    return [
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        upper[1] / letters,
        upper[2] / visible,
        upper[3] / visible,
        upper[4] / visible,
        upper[6] / visible,
        sum(c for w, c in counts.items() if not any(b >= 128 or 65 <= b <= 122 for b in w)) / n,
        sum(c for w, c in counts.items() if w[-2:-1] == w[-1:] and not w[-1:].isalnum()) / n,
        sum(c for w, c in counts.items() if len(w) > 2 and w.isupper()) / n,
        np.log1p(n / max(1, len(lines))),
    ]


def word_buckets(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all distinct words, how many each text has, statistics of each text)."""
    flat, sizes, stats = [], [], []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").split()
        counts = Counter(words)
        own = {zlib.crc32(w) & (BUCKETS - 1) for w in counts}
        flat += own
        sizes.append(len(own))
        stats.append(statistics(text, words, counts))
    return np.array(flat, np.int64), np.array(sizes, np.int64), np.array(stats, float)


@dataclass
class Machine:
    """Weights and vectors of the inputs: buckets first, then the bins of each statistic."""

    edges: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def inputs(self, flat, sizes, stats):
        """Flat (input, value, text); words share a length of 1, each bin has the value 1."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        value = 1 / np.sqrt(np.maximum(1, sizes))[owner]
        bins = self.bins(stats)
        owners = np.repeat(np.arange(len(stats)), stats.shape[1])
        return (
            np.r_[flat, bins.ravel()],
            np.r_[value, np.ones(bins.size)],
            np.r_[owner, owners],
        )

    def bins(self, stats):
        first = BUCKETS + np.arange(stats.shape[1]) * BINS
        found = [np.searchsorted(e, s, side="left") for e, s in zip(self.edges, stats.T)]
        return np.stack(found, axis=1) + first

    def scores(self, flat, sizes, stats) -> np.ndarray:
        """Linear time: half of (the square of the sum less the sum of the squares)."""
        at, value, owner = self.inputs(flat, sizes, stats)
        n = len(sizes)
        total = np.bincount(owner, self.weights[at] * value, n) + self.bias
        for f in range(self.vectors.shape[1]):
            part = self.vectors[at, f] * value
            total += (np.bincount(owner, part, n) ** 2 - np.bincount(owner, part**2, n)) / 2
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(rows: Sequence[tuple], width: int, epochs: int = 12, seed: int = 7) -> Machine:
    """Fit on (buckets, ``width`` statistics, label) by logistic loss and small Adam steps."""
    size = BUCKETS + width * BINS
    labels = np.array([r[2] for r in rows], float)
    share = labels.mean() if len(rows) else 0.5
    stats = np.array([r[1] for r in rows], float).reshape(-1, width)
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(stats, quantiles, axis=0).T if len(rows) else np.zeros((width, BINS - 1))
    bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    rng = np.random.default_rng(seed)
    machine = Machine(edges, bias, np.zeros(size), np.zeros((size, RANK)))
    if not len(rows):
        return machine
    if not 0 < share < 1:
        machine.bias = 30 * (2 * share - 1)
        return machine
    bins = machine.bins(stats)
    params = [machine.weights, rng.normal(0, 0.02, (size, RANK))]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 256):
            chosen = order[at : at + 256]
            x = np.zeros((len(chosen), size))
            for i, r in enumerate(chosen):
                words = rows[r][0]
                x[i, words] = 1 / np.sqrt(max(1, len(words)))
                x[i, bins[r]] = 1
            w, v = params
            sums = x @ v
            squares = x**2
            guess = bias + x @ w + (sums**2 - squares @ v**2).sum(1) / 2
            error = 1 / (1 + np.exp(-np.clip(guess, -30, 30))) - labels[chosen]
            error /= len(chosen)
            slopes = [
                x.T @ error + 1e-5 * w,
                x.T @ (error[:, None] * sums) - v * (squares.T @ error)[:, None] + 1e-4 * v,
            ]
            step += 1
            rate = 0.02 * (1 - epoch / epochs)
            for p, g, (m, s) in zip(params, slopes, moments):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    machine.weights, machine.vectors = params
    return machine


def held_out(id: str, folds: int = 5):
    """The rows that are never learnt from: the checksum of the id's text divides by ``folds``."""
    rest = F.crc32(F.col(id).cast("string").cast("binary")) % folds
    return F.coalesce(rest == 0, F.lit(False))


def _with_metadata(df, metadata):
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in metadata]
    return F.array(*[F.log1p(F.greatest(n, F.lit(0.0))) for n in numbers])


def train(
    df: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    metadata: Sequence[str] = ("n_chars",),
    most_rows: int = MOST_ROWS,
) -> Machine:
    """Fit on at most ``most_rows`` labelled rows that are not held out."""
    usable = labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(id))
    chosen = usable.select(F.col(id).alias("__id"), F.col(label).cast("int").alias("__label"))
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id", "__label").limit(most_rows)
    rows = df.select(id, text, _with_metadata(df, metadata).alias("__meta"))
    # The chosen rows are most_rows pairs of numbers at most.
    rows = rows.join(F.broadcast(chosen), F.col(id) == F.col("__id"))
    # An id that repeats is learnt from once, so the rows stay as few as the chosen ones.
    first = F.min(F.struct("__label", F.col(text).alias("__whole"), "__meta")).alias("r")
    rows = rows.groupBy("__id").agg(first).select("r.*")

    def run(texts):
        flat, sizes, stats = word_buckets(texts)
        parts = np.split(flat.astype(np.int16), np.cumsum(sizes)[:-1])
        return None, [parts, list(stats)]

    found = map_texts(
        rows, ["__label", "__meta"], "__whole", run, "buckets array<short>, stats array<double>"
    )
    got = found.toArrow()  # most_rows rows at most, each with at most BUCKETS short numbers
    return fit(_training_rows(got), len(STATISTICS) + len(metadata))


def _training_rows(got) -> list[tuple]:
    """(buckets, statistics, label) of each row, in an order that does not depend on partitions.

    The buckets stay short numbers in one flat array, of which each row has its part.
    """
    buckets = got.column("buckets").combine_chunks()
    flat = buckets.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(buckets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    stats = [a + b for a, b in zip(*[got.column(c).to_pylist() for c in ("stats", "__meta")])]
    parts = np.split(flat, ends[:-1]) if len(ends) else []
    rows = list(zip(parts, stats, got.column("__label").to_pylist()))
    return sorted(rows, key=lambda r: (r[2], r[1], r[0].tobytes()))


def score(
    df: DataFrame,
    machine: Machine,
    id: str = "doc_id",
    text: str = "text",
    metadata: Sequence[str] = ("n_chars",),
    threshold: float = THRESHOLD,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(id, kept columns, held_out, score, predicted) of every whole text."""
    own = [id, *[c for c in keep if c != id]]
    source = [text] if text not in own else []
    rows = df.select(*own, *source, _with_metadata(df, metadata).alias("__m"))

    def run(batch_texts, meta):
        flat, sizes, stats = word_buckets(batch_texts)
        return None, [machine.scores(flat, sizes, np.hstack([stats, meta]))]

    made = map_texts(rows, [*own, "__m"], text, run, "score double", beside="__m")
    value = F.col("score")
    return made.drop("__m").select(
        *own, held_out(id).alias("held_out"), value,
        F.when(value >= threshold, 1).otherwise(0).alias("predicted"),
    )


def keep_good(
    df: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    metadata: Sequence[str] = ("n_chars",),
) -> DataFrame:
    """The rows of ``df`` whose text is predicted good, with all their columns."""
    machine = train(df, labels, id, text, metadata=metadata)
    names = df.columns
    own = {name: f"__c{i}" for i, name in enumerate(names)}  # apart from the score's own names
    plain = df.toDF(*own.values())
    scored = score(
        plain, machine, own[id], own[text], [own[m] for m in metadata], keep=plain.columns
    )
    return scored.filter("predicted = 1").select(plain.columns).toDF(*names)
