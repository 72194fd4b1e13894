"""Quality rules as a short-circuit cascade.

The base figures of every whole text come from array functions over its words. Further rules are
conditions over those figures and the words. Their cost and their share of rejected rows are
measured on a sample of ``sample_rows`` rows; they then run in order of rejections per cost, each
only on rows that every rule before it let pass. The order changes the work, never the verdict.

Windows of words are compared by a 64-bit hash. The hash of a window is made of those of its two
halves, so a word is hashed once and not once for each window that it stands in.

Null and empty texts have no words and fail the base rule. Repeated rows and rows with null ids
are judged one by one. An empty table gives no rows. Other columns may have any names. Only
Spark's own functions are used.
"""

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.llm.support import WORD_GAP, stored

LEAST_WORDS = 20
REPEAT_PERCENT = 30
WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2_000


@dataclass(frozen=True)
class Rule:
    """A row is rejected where ``rejects`` holds; null counts as no."""

    name: str
    rejects: str


#: Conditions over the columns of ``figures``; shares are held against whole numbers.
RULES = (
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines and n_dup_lines > 2"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("no_letters", "5 * size(filter(words, w -> w rlike '\\\\p{L}')) < 4 * n_words"),
    Rule(
        "shouting",
        "2 * size(filter(words, w -> length(w) > 2 and w = upper(w) and w <> lower(w))) > n_words",
    ),
    Rule("one_word", "3 * n_words > 10 * size(array_distinct(words)) and n_words < 100"),
    Rule(
        "same_in_a_row",
        "10 * size(filter(sequence(2, greatest(2, n_words)), "
        "i -> get(words, i - 1) = get(words, i - 2))) > 2 * n_words",
    ),
    Rule("ellipsis", "10 * size(filter(words, w -> w like '%...')) > 3 * n_words"),
)


def word_figures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add words, n_words, word_chars, n_symbols, n_lines and n_dup_lines."""
    text = F.coalesce(F.col(text), F.lit(""))
    gap = F.lit(WORD_GAP)
    df = df.withColumns(
        {
            "words": F.array_remove(F.split(text, WORD_GAP), ""),
            "word_chars": F.char_length(F.regexp_replace(text, gap, F.lit(""))).cast("long"),
            "n_symbols": (
                F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))
            ).cast("long"),
            "__lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    return df.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        }
    ).drop("__lines")


def with_repeats(df: DataFrame, where: Column, size: int = WINDOW_WORDS) -> DataFrame:
    """Add n_repeat_words to ``word_figures``: words in windows of ``size`` words that are found
    twice or more; 0 where ``where`` does not hold, without looking."""
    windows = F.size("words") - size + 1
    long_enough = where & (windows > 0)
    df = df.withColumn(
        "__windows", F.when(long_enough, F.transform("words", lambda w: F.xxhash64(w)))
    )
    span = 1
    while span < size:
        # The hash at i of twice the words, or of as many more as are missing, overlapping.
        step = min(span, size - span)
        later = F.slice("__windows", F.lit(step + 1), F.size("words"))
        both = F.zip_with("__windows", later, lambda a, b: F.xxhash64(a, b))
        df = df.withColumn("__windows", both)
        span += step
    # What is cut off began within ``size`` words of the end.
    whole = F.when(long_enough, F.slice("__windows", F.lit(1), windows))
    df = df.withColumn("__windows", whole)
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    with_place = F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("__sorted", F.when(repeats, F.sort_array(with_place)))
    # Neighbours in the sorted list with equal hashes are windows found twice or more.
    again = F.expr(
        "transform(filter(__sorted, (s, k) -> s.h = get(__sorted, k - 1).h "
        "or s.h = get(__sorted, k + 1).h), s -> s.i)"
    )
    df = df.withColumn("__again", F.when(F.col("__sorted").isNotNull(), F.sort_array(again)))
    covered = F.expr(
        f"aggregate(__again, named_struct('last', -{size}, 'n', 0), (a, p) -> "
        f"named_struct('last', p, 'n', a.n + least({size}, p - a.last))).n"
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return df.drop("__windows", "__sorted", "__again")


def figures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add words, n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words."""
    return with_repeats(word_figures(df, text), F.lit(True))


def too_short() -> Column:
    return F.col("n_words") < LEAST_WORDS


def base_failed() -> Column:
    return too_short() | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def best_order(seconds: Sequence[float], patterns: Sequence[tuple]) -> list[int]:
    """Numbers of rules by rejections per second, counted on the rows that those before let pass.

    ``patterns`` are (which rules reject, rows).
    """
    order, left = [], list(patterns)
    while len(order) < len(seconds):
        rest = [i for i in range(len(seconds)) if i not in order]
        hits = {i: sum(n for rejected, n in left if rejected[i]) for i in rest}
        order.append(max(rest, key=lambda i: (hits[i] / max(seconds[i], 1e-3), -seconds[i], -i)))
        left = [(rejected, n) for rejected, n in left if not rejected[order[-1]]]
    return order


def measured_order(rows: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second of work on a sample, best first.

    The sample is at most ``sample_rows`` rows and decides about speed alone.
    """
    total = rows.count()
    if not total:
        return list(rules)
    share = min(1.0, 1.5 * sample_rows / max(1, total))
    sample = stored(figures(rows.sample(share, seed=1)).limit(sample_rows), "rule-sample")
    sample = sample.filter(~base_failed())

    def seconds(condition):
        start = time.perf_counter()
        sample.agg(F.count_if(condition)).first()
        return time.perf_counter() - start

    seconds(F.lit(True))
    nothing = seconds(F.lit(True))
    spent = [seconds(F.expr(rule.rejects)) - nothing for rule in rules]
    rejected = F.array(*[F.coalesce(F.expr(r.rejects), F.lit(False)) for r in rules])
    # As many rows as the sample has at most.
    patterns = sample.groupBy(rejected.alias("rejected")).count().collect()
    return [rules[i] for i in best_order(spent, [tuple(p) for p in patterns])]


def first_rejection(rules) -> Column:
    """The name of the first rule that rejects a row, or null; later rules are not evaluated."""
    chain = F.when(F.expr(rules[0].rejects), F.lit(rules[0].name))
    for rule in rules[1:]:
        chain = chain.when(F.expr(rule.rejects), F.lit(rule.name))
    return chain


def judged(rows: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``figures`` with base_failed, rejected_by and kept.

    Store it before filtering: Spark pushes a filter on these columns below the figures, where
    each rule would compute all of them again.
    """
    found = figures(rows, text).withColumn("base_failed", base_failed())
    by = F.when(~F.col("base_failed"), first_rejection(rules))
    found = found.withColumn("rejected_by", by)
    return found.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())


def apply_rules(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, the figures, base_failed, kept) of every text."""
    rows = df.select(F.col(id).alias("__id"), F.col(text).alias("text"))
    found = judged(rows, measured_order(rows))
    found = found.select(
        F.col("__id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept",
    )
    return stored(found, "verdicts")


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that every rule lets pass, with all their columns.

    Repeated words cost the most, so they are looked for last, in the texts that are left.
    Verdicts are stored before rows are dropped, see ``judged``."""
    rows = df.select(F.struct(*df.columns).alias("__row"), F.col(text).alias("text"))
    order = measured_order(rows)
    found = word_figures(rows)
    passed = ~too_short() & first_rejection(order).isNull()
    found = found.withColumn("__passed", passed)
    found = with_repeats(found, F.col("__passed"))
    found = found.select("__row", (F.col("__passed") & ~base_failed()).alias("kept"))
    return stored(found, "verdicts").filter("kept").select("__row.*")
