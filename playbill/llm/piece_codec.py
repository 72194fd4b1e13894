"""Encoding and decoding with a SentencePiece BPE model by vectorised merge rounds.

All words of a batch lie in one flat numpy array of symbols. A round finds the best-ranked pair
of each word, merges its occurrences from the left all at once, and compacts the array; words
without a pair left drop out. Results equal the library's greedy order: where merging all
occurrences could run ahead of it (a merged piece may form a better-ranked piece at once), only
the leftmost is merged in that round.

A null or empty text has no pieces, only the begin and end ids. Texts may be of any length.
"""

import hashlib
from collections.abc import Sequence

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from playbill.llm.support import WordTable, cached, map_texts

SPACE = "▁"
CODE_POINTS = 0x110000
NO_PAIR = np.iinfo(np.int64).max
KEPT_WORDS = 600_000
REPLACEMENT = "�"


class PieceModel:
    """The vocabulary of a model as arrays."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = model.get_piece_size()
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        names = model.id_to_piece(list(range(n)))
        scores = model.get_score(list(range(n)))
        control = {i for i in range(n) if model.is_control(i)}
        byte = {i for i in range(n) if model.is_byte(i)}
        if any(model.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        if model.encode(" a") != model.encode("a") and model.encode("  ") == []:
            raise ValueError("models that trim white space are not supported")
        plain = [i for i in range(n) if i not in control and i not in byte and i != self.unknown]
        ids = {names[i]: i for i in plain}

        #: Symbol of each code point: its piece, or a number of its own beyond the pieces.
        self.symbol_of = np.arange(CODE_POINTS, dtype=np.int64) + n
        for name, i in ids.items():
            if len(name) == 1:
                self.symbol_of[ord(name)] = i
        order = sorted(plain, key=lambda i: -scores[i])
        self.rank = np.full(n, NO_PAIR, np.int64)
        self.rank[order] = np.arange(len(order))
        self.by_rank = np.array(order, np.int64)
        symbol = lambda s: ids.get(s, n + ord(s) if len(s) == 1 else None)
        pairs = {}
        for name, i in ids.items():
            for cut in range(1, len(name)):
                left, right = symbol(name[:cut]), symbol(name[cut:])
                if left is not None and right is not None:
                    pairs[left * (n + CODE_POINTS) + right] = i
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = self.rank[[pairs[k] for k in self.pair_keys.tolist()]]
        self.ahead = np.zeros(len(order), bool)  # by rank
        for key, i in pairs.items():
            for part in divmod(key, n + CODE_POINTS):
                if part < n and self.rank[i] < self.rank[part]:
                    self.ahead[self.rank[part]] = True

        self.splits_at_spaces = not any(SPACE in x.lstrip(SPACE) for x in ids)
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.has_bytes = len(byte) == 256
        self.bytes_of = [
            b"" if i in control else names[i].replace(SPACE, " ").encode() for i in range(n)
        ]
        self.bytes_of[self.unknown] = " ⁇ ".encode()
        for value, i in enumerate(self.byte_ids.tolist() if self.has_bytes else []):
            self.bytes_of[i] = bytes([value])
        self.is_byte = np.zeros(n, bool)
        self.is_byte[list(byte)] = True
        self.silent = np.zeros(n, bool)
        self.silent[list(control)] = True
        self.leading_space = np.array([x.startswith(SPACE) for x in names])

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * (self.size + CODE_POINTS) + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_PAIR)


def merged_symbols(model: PieceModel, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(final symbols of all non-empty words, one after another; symbols of each word)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = model.symbol_of[points]
    word = np.repeat(np.arange(len(words)), sizes)
    rank = np.full(len(symbols), NO_PAIR, np.int64)
    if len(symbols) > 1:
        rank[:-1] = model.pair_rank(symbols[:-1], symbols[1:])
        rank[:-1][word[:-1] != word[1:]] = NO_PAIR
    done_symbols, done_words = [], []
    while len(symbols):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        lengths = np.diff(np.r_[starts, len(symbols)])
        best = np.minimum.reduceat(rank, starts)
        open_word = best != NO_PAIR
        if not open_word.all():
            keep = np.repeat(open_word, lengths)
            done_symbols.append(symbols[~keep])
            done_words.append(word[~keep])
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            best, lengths = best[open_word], lengths[open_word]
            if not len(symbols):
                break
        hit = np.flatnonzero(rank == np.repeat(best, lengths))
        # In a run of neighbouring pairs every other one merges, from the left.
        first = np.r_[True, np.diff(hit) != 1]
        run = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
        take = (np.arange(len(hit)) - run) % 2 == 0
        ahead = model.ahead[rank[hit]]
        if ahead.any():
            leftmost = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
            take &= ~ahead | leftmost
        hit = hit[take]
        symbols[hit] = model.by_rank[rank[hit]]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        place = np.cumsum(keep) - 1
        symbols, word, rank = symbols[keep], word[keep], rank[keep]
        at = place[hit]
        beside = np.zeros(len(symbols), bool)
        beside[at] = True
        beside[at[at > 0] - 1] = True
        changed = np.flatnonzero(beside)
        rank[changed] = NO_PAIR
        inner = changed[changed + 1 < len(symbols)]
        inner = inner[word[inner] == word[inner + 1]]
        rank[inner] = model.pair_rank(symbols[inner], symbols[inner + 1])
    if not done_symbols:
        return np.zeros(0, np.int64), sizes
    symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(word, kind="stable")
    return symbols[order], np.bincount(word, minlength=len(words))


def encode_words(model: PieceModel, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids of each word); characters outside the vocabulary become their bytes."""
    symbols, sizes = merged_symbols(model, words)
    strange = symbols >= model.size
    if not strange.any():
        return symbols, sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    if not model.has_bytes:
        symbols[strange] = model.unknown
        again = np.r_[False, strange[1:] & strange[:-1] & (owner[1:] == owner[:-1])]
        return symbols[~again], np.bincount(owner[~again], minlength=len(words))
    points = (symbols[strange] - model.size).astype("<u4")
    raw = [chr(p).encode("utf-8", "surrogatepass") for p in points.tolist()]
    counts = np.ones(len(symbols), np.int64)
    counts[strange] = [len(r) for r in raw]
    ids = np.repeat(symbols, counts)
    ids[np.repeat(strange, counts)] = model.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return ids, np.bincount(np.repeat(owner, counts), minlength=len(words))


def words_of(text: str, splits: bool) -> list[str]:
    """The parts that are merged on their own; each but for its first space mark.

    A part begins at a run of spaces. Its first mark (for the first part: the one the model
    puts before every text) is left off, further ones are written.
    """
    if not text:
        return []
    if not splits:
        return [text.replace(" ", SPACE)]
    parts = text.replace(SPACE, " ").split(" ")
    if "" not in parts:
        return parts
    words, marks = [], ""
    for part in parts[:-1]:
        if part:
            words.append(marks + part)
            marks = ""
        else:
            marks += SPACE
    return [*words, marks + parts[-1]]


class PieceCodec:
    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.words = WordTable(
            lambda words: encode_words(self.model, [SPACE + w for w in words]), KEPT_WORDS
        )

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text with begin and end ids."""
        model, parts = self.model, []
        counts = []
        for text in texts:
            own = words_of(text, model.splits_at_spaces)
            parts += own
            counts.append(len(own))
        ids, sizes = self.words.ids(parts)
        ends = np.r_[0, np.cumsum(sizes)][np.cumsum(counts)] if counts else []
        pieces = np.split(ids, ends[:-1]) if len(counts) else []
        return [np.r_[model.begin, p, model.end] for p in pieces]

    def decode(self, ids: np.ndarray) -> str:
        """The text of one document's ids; broken bytes become replacement characters."""
        model = self.model
        ids = np.asarray(ids, np.int64)
        ids = ids[~model.silent[ids]]
        if not len(ids):
            return ""
        parts = list(map(model.bytes_of.__getitem__, ids.tolist()))
        if model.leading_space[ids[0]]:
            parts[0] = parts[0][1:]
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids, parts)

    def _decode_runs(self, ids, parts):
        is_byte = self.model.is_byte[ids]
        cuts = np.flatnonzero(np.diff(is_byte)) + 1
        out = []
        for run in np.split(np.arange(len(ids)), cuts):
            data = b"".join(parts[run[0] : run[-1] + 1])
            out.append(_each_bad_byte(data) if is_byte[run[0]] else data.decode())
        return "".join(out)


def _each_bad_byte(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(REPLACEMENT)
            size = 1
        at += size
    return "".join(out)


def encode_texts(df: DataFrame, model_path: str, id: str = "doc_id", text: str = "text"):
    """One row (id, ids array) for each text."""

    def run(texts):
        codec = cached(("piece", model_path), lambda: PieceCodec(model_path))
        return None, [[x.astype(np.int32) for x in codec.encode(texts)]]

    return map_texts(df, [id], text, run, "ids array<int>")


def round_trip(df: DataFrame, model_path: str, id: str = "doc_id", text: str = "text"):
    """Encode and decode every whole text; digests of both results, one row for each text."""

    def run(texts):
        codec = cached(("piece", model_path), lambda: PieceCodec(model_path))
        encoded = codec.encode(texts)
        return None, [
            [len(x) for x in encoded],
            [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in encoded],
            [
                hashlib.sha256(codec.decode(x).encode("utf-8", "surrogatepass")).hexdigest()
                for x in encoded
            ],
        ]

    return map_texts(
        df, [id], text, run, "n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
