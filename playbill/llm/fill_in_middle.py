r"""Fill-in-the-middle: texts cut in three at two places and put together in another order.

A text is a run of units, by default code points. Counting the matches of the unit gives n; two
numbers hashed from the document's id give the cuts a <= b. Each row then has a pattern of its
own with counted possessive groups, ``(unit{a}+)(unit{b-a}+)(unit*+)``, whose one match captures
prefix, middle and suffix and writes them in the new order. Counted possessive quantifiers on a
single unit run in a loop, so neither long texts nor late cuts need a deeper stack.

A null text is an empty one. Empty texts, texts that hold one of the marks, and a share of the
others stay as they are (form ``plain``). A null id is hashed as no characters. Repeated rows
come out alike, as all choices depend on the id alone; an empty table gives no rows. Other
columns of the input go along; those named like a made one (``n``, ``form``, ``prefix_chars``,
``middle_chars``, ``output``) are replaced by it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK = "<P>", "<S>", "<M>"
CODE_POINT = "."
#: Units are first counted by this many at once, so that no row becomes a list of single ones.
COUNTED_AT_ONCE = 1024
PLAIN_PERCENT, SPM_PERCENT = 10, 20
MADE = ("n", "form", "prefix_chars", "middle_chars", "output")


def count_units(text: Column, unit: str = CODE_POINT) -> Column:
    """How many units a text holds, from matches of many units and then of the single ones left."""
    many = F.lit(f"(?s){unit}{{{COUNTED_AT_ONCE}}}+")
    rest = F.regexp_replace(text, many, F.lit(""))
    single = F.lit(f"(?s){unit}")
    return F.regexp_count(text, many).cast("long") * COUNTED_AT_ONCE + F.regexp_count(rest, single)


def id_hashes(id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers: the first digits of the SHA-256 of ``seed:id``."""
    known = F.coalesce(id.cast("string"), F.lit(""))
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), known).cast("binary"), 256)
    return [F.conv(F.substring(digits, at, 8), 16, 10).cast("long") for at in (1, 9, 17, 25)]


def fill_in_middle(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    unit: str = CODE_POINT,
    seed: int = 1,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    r"""Add n, form, prefix_chars, middle_chars (in units; null if plain) and the output text.

    ``unit`` is one atom of a pattern, such as ``.``, ``\X`` or ``(?:\S+\s*+|\s+)``, that cuts any
    text without a gap. Marks go before each part: psm is prefix, suffix, middle, and spm suffix,
    prefix, middle.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    h1, h2, h3, h4 = id_hashes(F.col(id), seed)
    others = [c for c in df.columns if c not in MADE or c in (id, text)]
    rows = df.select(
        *others,
        source.alias("__text"),
        count_units(source, unit).alias("__n"),
        *[h.alias(f"__h{i}") for i, h in enumerate((h1, h2, h3, h4), 1)],
    )
    marked = F.lit(False)
    for mark in (PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK):
        marked = marked | F.contains("__text", F.lit(mark))
    stays = (F.col("__n") == 0) | marked | (F.col("__h3") % 100 >= 100 - plain_percent)
    form = (
        F.when(stays, "plain").when(F.col("__h4") % 100 < spm_percent, "spm").otherwise("psm")
    )
    places = [F.col(h) % (F.col("__n") + 1) for h in ("__h1", "__h2")]
    rows = rows.withColumns(
        {"__form": form, "__a": F.least(*places), "__b": F.greatest(*places)}
    )
    counted = F.format_string(
        rf"(?s)\A({unit}{{%d}}+)({unit}{{%d}}+)({unit}*+)\z",
        "__a",
        F.col("__b") - F.col("__a"),
    )
    order = F.when(
        F.col("__form") == "psm", f"{PREFIX_MARK}$1{SUFFIX_MARK}$3{MIDDLE_MARK}$2"
    ).otherwise(f"{SUFFIX_MARK}$3{PREFIX_MARK}$1{MIDDLE_MARK}$2")
    is_plain = F.col("__form") == "plain"
    made = {
        "n": F.col("__n"),
        "form": F.col("__form"),
        "prefix_chars": F.when(~is_plain, F.col("__a")),
        "middle_chars": F.when(~is_plain, F.col("__b") - F.col("__a")),
        "output": F.when(is_plain, F.col("__text")).otherwise(
            F.regexp_replace(F.col("__text"), counted, order)
        ),
    }
    kept = [c for c in others if c not in MADE]
    return rows.select(*kept, *[column.alias(name) for name, column in made.items()])


def restored(output: Column, form: Column) -> Column:
    """The text that an output of that form was made from.

    Texts with marks stay plain, so each mark's first place in an output is the one put there.
    """
    p, s, m = PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
