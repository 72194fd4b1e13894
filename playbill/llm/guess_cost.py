"""Secrets in texts: fixed patterns, and credential values that would cost many guesses.

The patterns find assigned credentials, access keys and long hexadecimal runs. Values that stand
after other credential words are then judged by how many guesses they would take: dynamic
programming finds the cheapest way to cut a value into known words, dates, repeats, keyboard walks
and spans of brute force. A value that costs at least ``10 ** least_guesses`` guesses is a secret.
Known words are common parts of passwords, then the corpus' own words by the number of documents
that hold them, of which at most ``MOST_WORDS`` go to the tasks.

Offsets count code points, ends are exclusive. A null text is an empty one and has no secrets.
Whole texts of any length are searched, in time linear in the text but for the values' own length.
Repeated rows are searched each for itself. An empty table gives no rows. Other columns play no
part, whatever their names.
"""

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Mapping
from itertools import accumulate, pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.support import map_texts, stored

KINDS = ("assign", "access", "hex", "guess")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
LEAST_GUESSES = 8.0
#: Words of the corpus that guessing knows: at most so many, of so many letters, each in at least
#: so many documents. All documents are counted.
MOST_WORDS, SHORTEST_WORD, LONGEST_WORD, LEAST_DOCUMENTS = 20_000, 3, 24, 3

# Credential words before a value, and patterns of secrets.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}")
CONTEXT_WORDS = ("pass", "pwd", "pin", "login", "auth", "bearer", "credential", "key", "secret",
                 "token")
CONTEXT = re.compile(
    r"\b(?:pass(?:word|wd|phrase|code)?|pwd|pin|login|auth(?:orization)?|bearer|credentials?"
    r"|(?:access|private|secret|signing|encryption|api)[ _-]?key|secret|token)\b"
    r"(?:\x20+is\b|[\"']?\x20*(?:[:=]|=>|:=))\x20*[\"']?([^\s\"'<>,;]{6,})",
    re.IGNORECASE | re.ASCII,
)

# Common parts of passwords, most common first, and keyboard rows.
COMMON = (
    "password", "qwerty", "admin", "welcome", "letmein", "monkey", "dragon", "master", "login",
    "princess", "solo", "sunshine", "shadow", "football", "baseball", "superman", "batman",
    "trustno", "iloveyou", "love", "hello", "freedom", "whatever", "ninja", "mustang", "access",
    "michael", "jordan", "hunter", "harley", "ranger", "jennifer", "thomas", "robert", "soccer",
    "hockey", "killer", "george", "charlie", "andrew", "michelle", "jessica", "pepper", "daniel",
    "joshua", "maggie", "summer", "winter", "spring", "autumn", "ashley", "nicole", "chelsea",
    "matthew", "secret", "token", "test", "guest", "root", "user", "example", "changeme",
    "default", "system", "server", "database", "service", "public", "private", "company",
    "january", "february", "march", "april", "june", "july", "august", "september", "october",
    "november", "december", "monday", "friday", "sunday", "blue", "red", "green", "black",
    "white", "orange", "silver", "golden", "flower", "computer", "internet", "cookie", "cheese",
    "banana", "apple", "coffee", "tiger", "eagle", "horse", "correct", "battery", "staple",
    "pass", "word", "the", "and", "you", "this", "that", "with", "from", "have", "your", "key",
)
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")

RANKS = {w: i + 1 for i, w in enumerate(dict.fromkeys(COMMON))}
PLAIN = str.maketrans("@430!1$57", "aaeoiisst")
DATE = re.compile(
    r"(?:19|20)\d\d|(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])[-/.](?:0?[1-9]|1[0-2])[-/.](?:(?:19|20)\d\d|\d\d)",
    re.ASCII,
)
NEXT_TO = {
    (a, b)
    for row in KEY_ROWS
    for x, y in pairwise(row)
    for a, b in ((x, y), (y, x))
}


def _variations(text: str) -> float:
    """Guesses for the capitals of a word."""
    capitals = sum(c.isupper() for c in text)
    if not capitals:
        return 1
    if capitals == len(text) or (capitals == 1 and text[0].isupper()):
        return 2
    return sum(math.comb(len(text), i) for i in range(1, min(capitals, len(text) - capitals) + 1))


def _alphabet(c: str) -> int:
    if c.isdigit():
        return 10
    if c.isalpha():
        return 26
    return 33


def ranked_words(df: DataFrame, text: str = "text", most: int = MOST_WORDS) -> dict[str, int]:
    """The ranks of known words: common parts of passwords, then words of the whole corpus.

    Words of letters alone, in lower case, by the number of documents they stand in.
    """
    letters = F.split(F.lower(F.col(text)), r"[^\p{L}]+")
    word = F.explode(F.array_distinct(letters)).alias("word")
    fits = F.length("word").between(SHORTEST_WORD, LONGEST_WORD)
    counts = df.select(word).filter(fits).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    often = counts.filter(F.col("n") >= LEAST_DOCUMENTS).orderBy(F.desc("n"), "word").limit(most)
    ranks = dict(RANKS)
    # A collected top-k would bring ``most`` rows of every task to the driver.
    for row in stored(often, "ranked-words").orderBy(F.desc("n"), "word").collect():
        ranks.setdefault(row.word, len(ranks) + 1)
    return ranks


def log_guesses(value: str, ranks: Mapping[str, int] = RANKS) -> float:
    """log10 of the guesses the cheapest segmentation of a value takes.

    Each segment adds its own guesses and, as its place has to be guessed too, a factor of its
    number; brute force spans cost their alphabet for each character.
    """
    n = len(value)
    low = value.lower()
    if len(low) != n:
        low = value
    plain = low.translate(PLAIN)
    alphabet = max(10, sum({_alphabet(c): _alphabet(c) for c in value}.values()))
    if any(c.isupper() for c in value) and any(c.islower() for c in value):
        alphabet += 26
    per_character = math.log10(alphabet)
    walk = [0] * n
    repeat = [0] * n
    for i in range(1, n):
        walk[i] = walk[i - 1] + 1 if (low[i - 1], low[i]) in NEXT_TO else 0
        repeat[i] = repeat[i - 1] + 1 if value[i] == value[i - 1] else 0
    dates: dict[int, list[int]] = {}
    for i in range(n):
        if value[i].isascii() and value[i].isdigit():
            for size in (4, 6, 8, 9, 10):
                if i + size <= n and DATE.fullmatch(value, i, i + size):
                    dates.setdefault(i + size, []).append(i)
    best = [0.0] + [math.inf] * n
    parts = [0] * (n + 1)
    brute = [math.inf] * (n + 1)  # cheapest that ends in a brute force span
    brute_parts = [0] * (n + 1)
    for end in range(1, n + 1):
        opened = best[end - 1] + math.log10(parts[end - 1] + 1) + per_character
        longer = brute[end - 1] + per_character
        brute[end] = min(opened, longer)
        brute_parts[end] = parts[end - 1] + 1 if opened <= longer else brute_parts[end - 1]
        options = [(brute[end], brute_parts[end])]

        def add(start, guesses, end=end, options=options):
            count = parts[start] + 1
            options.append((best[start] + math.log10(guesses) + math.log10(count), count))

        for size in range(SHORTEST_WORD, min(LONGEST_WORD, end) + 1):
            start = end - size
            for form, extra in ((low, 1), (plain, 2)):
                rank = ranks.get(form[start:end])
                if rank:
                    add(start, rank * extra * _variations(value[start:end]))
                    break
        for start in dates.get(end, ()):
            add(start, 120 if end - start == 4 else 120 * 365 * 4)
        if repeat[end - 1] >= 2:
            run = repeat[end - 1] + 1
            add(end - run, _alphabet(value[end - 1]) * run)
        if walk[end - 1] >= 2:
            run = walk[end - 1] + 1
            add(end - run, 47 * 2 * run)
        best[end], parts[end] = min(options)
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the fixed patterns, leftmost and apart for each kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_VALUE:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                found.append((m.start(), 1, m.end()))
    for m in HEX.finditer(text):
        found.append((m.start(), 2, m.end()))
    return sorted(found)


def guessed_spans(
    text: str, base, least_guesses: float, ranks: Mapping[str, int] = RANKS
) -> list[tuple[int, int, int]]:
    """Costly credential values that no pattern has found; ``base`` is in order."""
    low = text.lower()
    if not any(w in low for w in CONTEXT_WORDS):
        return []
    found = []
    starts = [s for s, _, _ in base]
    reached = list(accumulate((e for _, _, e in base), max))  # the furthest end so far
    for m in CONTEXT.finditer(text):
        start, end = m.span(1)
        while end > start and text[end - 1] in ".!?)]}":
            end -= 1
        before = bisect_left(starts, end)
        apart = not before or reached[before - 1] <= start
        if apart and end - start >= LEAST_VALUE:
            if log_guesses(text[start:end], ranks) >= least_guesses:
                found.append((start, 3, end))
    return found


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret_spans(
    df: DataFrame, id: str = "doc_id", text: str = "text", least_guesses: float = LEAST_GUESSES
) -> DataFrame:
    """Counts, a digest of the pattern spans, and all spans of every whole text."""
    ranks = ranked_words(df, text)

    def run(texts):
        base = [base_spans(t) for t in texts]
        every = [
            sorted(b + guessed_spans(t, b, least_guesses, ranks)) for t, b in zip(texts, base)
        ]
        counts = [[sum(k == kind for _, k, _ in b) for b in base] for kind in range(3)]
        return None, [
            *counts,
            [hashlib.sha256(_written(b).encode()).hexdigest() for b in base],
            [_written(s) for s in every],
            [len(s) - len(b) for s, b in zip(every, base)],
        ]

    fields = (
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long"
    )
    return map_texts(df, [id], text, run, fields)
