import random

import pytest
from pyspark.sql import functions as F

from playbill.llm.support import stored

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = "abcdefghijklmnop"


def made_text(rng, words):
    return " ".join(
        "".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 8))) for _ in range(words)
    )


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty, odd and very long texts, and repeated rows,
    beside columns whose names clash with those the operators make."""
    rng = random.Random(11)
    base = made_text(rng, 300)
    texts = [
        None,
        "",
        " \t\r\n\x0b\x0c ",
        "\x00",
        "one",
        "two words",
        "  leading and  double   spaces \n next\tline ",
        "ÀÉ ß ﬁ 漢字 \U0001f600   \xa0 \x85 ▁ <s> <|endoftext|> \\N",
        "x" * 30_000,
        "word " * 12_000,
        made_text(rng, 15_000),
        base,
        base,
        base.upper(),
        base + " more",
        *[made_text(rng, rng.randint(1, 400)) for _ in range(30)],
    ]
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[11], rows[11], (None, base, None, None, None), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    clashing = {n: F.lit(1) for n in ("score", "kept", "size", "shard", "key", "fp", "id", "words",
                                      "length", "offset", "h", "v", "node", "count", "spans",
                                      "t", "held_out")}
    return stored(frame.withColumns(clashing), "awkward")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
