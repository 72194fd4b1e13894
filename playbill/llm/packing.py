"""Packing token pieces into fixed windows by non-negative least squares.

Documents are cut at the window size, which leaves whole windows and one shorter piece each. The
lengths of all pieces form a histogram of at most ``window`` numbers. Shallow combinations of
lengths that fill a window are enumerated, and non-negative least squares finds how often each
is to be used to meet the histogram. The counts are rounded down, and what is left over is packed
greedily, again by length. The result is a plan: for each length, which ranks go to which place
of which combination. Every piece finds its place from its rank among the pieces of its length.
The driver sees the histogram and the plan, whose size depends on the window alone.

Null texts are empty ones; an empty text is the end id alone, a piece of length 1. Repeated rows
are packed as often as they occur. An empty table gives an empty result.
"""

import json
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import pairwise

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.support import (
    cached,
    cells_for,
    map_texts,
    stored,
    with_positions,
)

#: Characters of a text that are encoded at once, about.
CHARACTERS_AT_ONCE = 256 * 1024
#: White-space characters on end from which a text goes through ``tokenizers``.
LONG_GAP = 10_000
# Fixed value: how the byte-level files split a text before the merges.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


class ByteBpe:
    """Ids of whole texts from a ``tokenizers`` file.

    Texts are encoded with the file's vocabulary as ranks, which gives the same ids in a fraction
    of the time where merges are in the order of ids; otherwise, and for texts with added tokens
    or very long white space, on which that encoder's pattern fails, by ``tokenizers``. The file's pattern lets only the beginning of a token be a space, so a long
    text is cut before single spaces between two other characters without changing its ids, and
    its ids are never all in one Python list.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.path = path
        self.added = [a["content"] for a in described["added_tokens"]]
        self.single_space = re.compile(r"(?<=\S) (?=\S)")
        self.long_gap = re.compile(rf"\s{{{LONG_GAP}}}")
        self.ranked = _as_ranks(described)

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _as_listed(self, text):
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.fromiter(ids, np.int64, len(ids))

    def parts(self, text: str, at_least: int = CHARACTERS_AT_ONCE) -> Iterator[str]:
        """The text in parts of ``at_least`` characters, up to the next place for a cut."""
        start = 0
        while cut := self.single_space.search(text, start + at_least):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        for text in texts:
            unfit = self.long_gap.search(text) or any(a in text for a in self.added)
            if self.ranked is None or unfit:
                yield self._as_listed(text)
                continue
            ids = [
                np.fromiter(own, np.int64, len(own))
                for own in map(self.ranked.encode_ordinary, self.parts(text))
            ]
            yield ids[0] if len(ids) == 1 else np.concatenate(ids)


def _as_ranks(described: dict):
    """The file as a tiktoken encoding, or None where that might give other ids."""
    vocabulary, merges = described["model"]["vocab"], described["model"]["merges"]
    pre = described["pre_tokenizer"]
    plain = pre == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                    "use_regex": True}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    ids = [vocabulary.get(a + b) for a, b in pairs]
    in_order = None not in ids and all(x < y for x, y in pairwise(ids))
    if not (plain and in_order and described["normalizer"] is None):
        return None
    # Bytes that print stand for themselves, the others for characters from 256 on.
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printing}
    byte_of |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printing)))}
    added = {a["content"] for a in described["added_tokens"]}
    ranks = {
        bytes(map(byte_of.__getitem__, token)): i
        for token, i in vocabulary.items()
        if token not in added
    }
    return tiktoken.Encoding(
        "file", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def cut_into_pieces(
    df: DataFrame, tokenizer: str, end_id: int, window: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens): the pieces of every document."""

    def run(texts):
        bpe = cached(("byte_bpe", tokenizer), lambda: ByteBpe(tokenizer))
        rows, start, length, crc, total = [], [], [], [], []
        for i, ids in enumerate(bpe.encode(texts)):
            ids = np.append(ids, end_id).astype("<u4")
            for at in range(0, len(ids), window):
                piece = ids[at : at + window]
                rows.append(i)
                start.append(at)
                length.append(len(piece))
                crc.append(zlib.crc32(piece.tobytes()))
                total.append(len(ids))
        return rows, [start, length, crc, total]

    return map_texts(
        df, [id], text, run, "start long, length long, ids_crc32 long, doc_tokens long"
    )


def combinations(lengths: np.ndarray, counts: np.ndarray, window: int, depth: int, each: int):
    """Combinations of up to ``depth`` present lengths that fill a window to a 64th part.

    For each length as the longest one, the ``each`` most frequent second lengths and, if
    ``depth`` is 3, third ones; the last length is always the longest that still fits. Lengths
    too short for any such combination are left to the greedy step.
    """
    present = np.sort(lengths)
    often = lengths[np.argsort(-counts, kind="stable")][: 4 * each]

    def longest_within(room, most):
        at = np.searchsorted(present, min(room, most), side="right")
        return int(present[at - 1]) if at else 0

    found = set()
    for first in present.tolist():
        second = longest_within(window - first, first)
        if second:
            found.add((first, second))
        if depth < 3:
            continue
        seconds = [int(s) for s in often if s <= min(first, window - first)][:each]
        spread = present[present <= min(first, window - first)]
        seconds += spread[:: max(1, len(spread) // each)].tolist()
        for second in seconds:
            third = longest_within(window - first - second, second)
            found.add((first, second, third) if third else (first, second))
    return sorted((c for c in found if window - sum(c) <= window // 64), reverse=True)


def non_negative_least_squares(
    columns: list[tuple[int, ...]], lengths: np.ndarray, counts: np.ndarray, rounds: int = 300
) -> np.ndarray:
    """Repeat counts x >= 0 that make the combinations' lengths meet ``counts``.

    Accelerated projected gradient on sparse columns, which have two or three entries each.
    Errors weigh by length over the square root of the count, so long and rare lengths count.
    """
    place = {int(n): i for i, n in enumerate(lengths)}
    column = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    row = np.array([place[n] for c in columns for n in c])
    weight = lengths / np.sqrt(counts) / lengths.max()
    entry = weight[row]
    scale = np.bincount(column, entry**2, len(columns)) + 1e-12
    target = counts * weight
    x = look = np.zeros(len(columns))
    touch = np.bincount(row, minlength=len(lengths)).max()
    momentum = 1.0
    for _ in range(rounds):
        residual = np.bincount(row, entry * look[column], len(lengths)) - target
        slope = np.bincount(column, entry * residual[row], len(columns))
        new = np.maximum(0, look - slope / (scale * touch))
        ahead = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        look = new + (momentum - 1) / ahead * (new - x)
        x, momentum = new, ahead
    return x


def plan_windows(
    lengths: Sequence[int], counts: Sequence[int], window: int, depth: int = 3, each: int = 12
) -> list[tuple[tuple[int, ...], int]]:
    """[(combination, repeats)] which uses each length exactly as often as it is there."""
    left = dict(zip(map(int, lengths), map(int, counts)))
    plan = []

    def use(combination, repeats):
        for n in combination:
            left[n] -= repeats
            if not left[n]:
                del left[n]
        plan.append((combination, repeats))

    if window in left:
        use((window,), left[window])
    if left:
        short = np.array(sorted(left))
        amount = np.array([left[n] for n in short.tolist()], float)
        columns = combinations(short, amount, window, depth, each)
        if columns:
            solved = non_negative_least_squares(columns, short, amount)
            waste = [window - sum(c) for c in columns]
            for i in sorted(range(len(columns)), key=lambda i: (waste[i], -solved[i])):
                need = {n: columns[i].count(n) for n in columns[i]}
                fits = min(left.get(n, 0) // k for n, k in need.items())
                repeats = min(int(solved[i]), fits)
                if repeats:
                    use(columns[i], repeats)
    while left:  # the longest left, then again and again the longest that fits
        room, chosen, taken = window, [], {}
        ordered = sorted(left, reverse=True)
        for n in ordered:
            while n <= room and left[n] > taken.get(n, 0):
                chosen.append(n)
                taken[n] = taken.get(n, 0) + 1
                room -= n
        use(tuple(chosen), min(left[n] // k for n, k in taken.items()))
    return plan


def placements(plan: list[tuple[tuple[int, ...], int]]):
    """Rows (length, first_rank, end_rank, first_sequence, per_sequence, offset) of a plan.

    A combination that holds a length k times takes k ranks in a row for each sequence; each of
    its places is a row of its own with every k-th rank.
    """
    rows, used, sequence = [], {}, 0
    for combination, repeats in plan:
        offset, places = 0, {}
        for n in combination:
            places.setdefault(n, []).append(offset)
            offset += n
        for n, offsets in places.items():
            first = used.get(n, 0)
            used[n] = first + repeats * len(offsets)
            rows.append((n, first, used[n], sequence, offsets))
        sequence += repeats
    return rows


def pack(pieces: DataFrame, window: int, id: str = "doc_id") -> DataFrame:
    """Add sequence_id and offset to stored pieces; sequences are gapless from offset 0."""
    spark = pieces.sparkSession
    histogram = pieces.groupBy("length").count().collect()  # at most ``window`` rows
    if not histogram:
        nothing = F.lit(None).cast("long")
        return pieces.withColumns({"sequence_id": nothing, "offset": nothing})
    plan = plan_windows([r[0] for r in histogram], [r[1] for r in histogram], window)
    rows = placements(plan)
    places = spark.createDataFrame(
        rows, "p_length long, first long, past long, sequence long, offsets array<long>"
    )
    total = sum(r[1] for r in histogram)
    cells = cells_for(total)
    cell = F.pmod(F.xxhash64(id, "start"), F.lit(cells))
    # Rows of one id can have different texts: those stay in place when a stage runs again.
    ranked = with_positions(pieces, ["length"], cell, [id, "start", "ids_crc32"], "__rank")
    # Ranges of ranks: the plan has for each length its ranges in order, found by their number.
    per_length = places.groupBy("p_length").agg(
        F.array_sort(F.collect_list(F.struct("first", "past", "sequence", "offsets"))).alias("at")
    )
    joined = ranked.join(F.broadcast(per_length), F.col("length") == F.col("p_length"))
    step = F.expr("filter(at, r -> r.first <= __rank and __rank < r.past)[0]")
    found = joined.withColumn("__place", step)
    inside = F.col("__rank") - F.col("__place.first")
    repeats = F.size("__place.offsets")
    return found.select(
        *pieces.columns,
        (F.col("__place.sequence") + F.floor(inside / repeats)).cast("long").alias("sequence_id"),
        F.get(F.col("__place.offsets"), (inside % repeats).cast("int")).alias("offset"),
    )


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    window: int = 2048,
    end_id: int = 1,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Tokenise, cut and pack whole texts: one row for each piece."""
    pieces = cut_into_pieces(df, tokenizer, end_id, window, id, text)
    return pack(stored(pieces, "pieces"), window, id)


def packing_summary(packed: DataFrame, window: int) -> DataFrame:
    """(sequences, tokens, padding): padding up to the window, none at a power of two."""
    filled = packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"))
    power = F.expr("bit_count(tokens) = 1")
    padding = F.when(power, 0).otherwise(window - F.col("tokens"))
    return filled.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.sum("tokens").alias("tokens"),
        F.sum(padding).alias("padding"),
    )
