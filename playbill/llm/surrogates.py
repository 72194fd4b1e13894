"""Surrogates for personal data: keyed, of the same type and format, one for each entity.

E-mail addresses, network addresses, card, phone, social security and bank account numbers, and
names after a title or a common given name are detected by one pattern. Every entity becomes a
replacement from a keyed hash of its normal form: digits stay digits in the same places, names
keep script, capitals and gender, addresses their shape, card and account numbers their check
digits. So an entity has the same replacement wherever and however it is written. All different
entities of the corpus are then held against each other: where two would get the same
replacement, or one would get another real entity, the later one is hashed again until none
collide. Only these exceptions are joined back to documents.

A name is replaced word by word, so a surname alone and with a given name agree. Whether a word
is a surname, or a given name of which gender, is decided by the majority of its mentions in the
corpus, unless it is a listed given name; it shapes the replacement, not its hash. Where a surname
was found in a document, it is replaced without title or given name too, unless the document has
the same word in small letters. Null and empty
texts stay as they are, as does everything outside the entities. Rows keep all their columns;
repeated rows and null ids are no special case; an empty table gives no rows. Patterns are linear
in the text, whatever it holds. Only Spark's own functions are used.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.llm.support import stored

MOST_ROUNDS = 60

# Titles and given names by gender, and syllables by script.
TITLES_M = ("Mr", "Herr", "Monsieur", "Sr", "Señor", "Mister", "Г-н", "Господин", "Κύριος")
TITLES_F = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Madame", "Sra", "Señora", "Г-жа",
            "Госпожа", "Κυρία")
TITLES_N = ("Dr", "Prof")
GIVEN_M = ("John", "James", "Robert", "Michael", "William", "David", "Thomas", "Daniel", "Peter",
           "Hans", "Jürgen", "Wolfgang", "Stefan", "Pierre", "Jean", "Michel", "Philippe",
           "Carlos", "José", "Juan", "Miguel", "Luis", "Иван", "Сергей", "Дмитрий",
           "Γιώργος")
GIVEN_F = ("Mary", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Anna", "Emma",
           "Ursula", "Monika", "Sabine", "Claudia", "Marie", "Sophie", "Isabelle", "Camille",
           "María", "Carmen", "Ana", "Laura", "Мария", "Елена", "Ольга", "Μαρία")
SYLLABLES = {
    "latin": ("ba", "be", "bri", "ca", "co", "da", "del", "do", "fa", "fen", "ga", "gor", "ha",
              "hol", "ja", "ka", "kel", "la", "len", "lo", "ma", "mi", "mor", "na", "nel", "pa",
              "ra", "ro", "sa", "sten", "ta", "vel"),
    "cyrillic": ("ба", "ве", "га", "до", "жа", "за", "ко", "ла", "ма", "не", "по", "ра", "со",
                 "та", "фе", "ша"),
    "greek": ("βα", "γα", "δο", "ζα", "θε", "κα", "λα", "μα", "νε", "πα", "ρα", "σα", "τα", "φα",
              "χα", "ψα"),
}
ENDINGS = {
    "latin": {"m": ("ric", "ton", "bert", "us"), "f": ("ina", "ella", "ita", "ia"),
              "s": ("man", "ley", "dorf", "ard")},
    "cyrillic": {"m": ("слав", "мир", "ник", "тин"), "f": ("ина", "лия", "ера", "яна"),
                 "s": ("нов", "кин", "чук", "ко")},
    "greek": {"m": ("νος", "κης", "μος", "τος"), "f": ("νη", "λια", "να", "ρα"),
              "s": ("ίδης", "άκης", "ου", "έας")},
}

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Possessive repeats run in a loop; a name or address of any length needs no deeper stack.
WORD = r"\p{Lu}\p{Ll}++(?:[-'’]\p{Lu}?+\p{Ll}++)*+"
#: A domain name has at most so many labels, and a local part so many characters; a surrogate
#: follows the first ones of a longer part.
MOST_LABELS, MOST_LOCAL = 127, 64
_TITLE = "|".join(TITLES_M + TITLES_F + TITLES_N)
_GIVEN = "|".join(GIVEN_M + GIVEN_F)
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\p{L}\p{M}\p{N}-])[A-Za-z0-9._%+\p{L}\p{M}\p{N}-]++"
    rf"@(?:[A-Za-z0-9\p{{L}}\p{{M}}\p{{N}}-]++\.){{1,{MOST_LABELS}}}(?:[A-Za-z]{{2,}}+|[\p{{L}}\p{{M}}]{{2,}}+)",
    "ip": rf"(?<![\w.]){OCTET}(?:\.{OCTET}){{3}}(?!\d|\.\d|[A-Za-z_])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\w+])(?:\d{4}(?<gap>[ -]?)\d{4}\k<gap>\d{4}\k<gap>\d{4}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3} ?\(\d{1,4}\) ?\d{2,4}[ .-]?\d{2,4}(?:[ .-]\d{2,4})?"
    r"|\+\d{1,3}(?:[ .-]?\d{2,4}){3,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
    "name": rf"(?<![\p{{L}}-])(?:(?:{_TITLE})\.? {WORD}(?: {WORD}){{0,2}}|(?:{_GIVEN}) {WORD})",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _is(match: Column, kind: str) -> Column:
    return match.rlike(f"^(?:{PATTERNS[kind]})$")


def _kind(match: Column) -> Column:
    shape = F.when(F.contains(match, F.lit("@")), "email").when(_is(match, "ip"), "ip")
    for kind in ("iban", "card", "ssn", "phone"):
        shape = shape.when(_is(match, kind), kind)
    return shape.otherwise("name")


def _plain(match: Column, kind: Column) -> Column:
    """The normal form: what is written differently but means the same is equal."""
    signs = F.regexp_replace(match, r"[^0-9A-Za-z+]", "")
    return F.when(kind == "email", F.lower(match)).when(kind == "ip", match).otherwise(signs)


def _script(word: Column) -> Column:
    return (
        F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic")
        .when(word.rlike(r"\p{IsGreek}"), "greek")
        .otherwise("latin")
    )


def _parts(match: Column) -> Column:
    """The entities of a match: (kind, normal form, as written, sort of name that it speaks for).

    A name has one for each word.
    """
    kind = _kind(match)
    words = F.split(match, " ")
    titled = F.get(words, F.lit(0)).rlike(rf"^(?:{_TITLE})\.?$")
    named = F.when(titled, F.slice(words, 2, 9)).otherwise(words)
    title = F.regexp_replace(F.get(words, F.lit(0)), r"\.$", "")
    sex = (
        F.when(title.isin(*TITLES_M), "m")
        .when(title.isin(*TITLES_F), "f")
        .otherwise(F.lit(None).cast("string"))
    )

    def word(w, i):
        last = i == F.size(named) - 1
        return F.struct(
            F.concat(F.lit("name_"), _script(w)).alias("kind"),
            F.lower(w).alias("plain"),
            w.alias("written"),
            F.when(last, "s").otherwise(sex).alias("sort"),
        )

    single = F.array(
        F.struct(
            kind.alias("kind"),
            _plain(match, kind).alias("plain"),
            match.alias("written"),
            F.lit(None).cast("string").alias("sort"),
        )
    )
    return F.when(kind == "name", F.transform(named, word)).otherwise(single)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once; lambdas below would compute it each time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _byte(stream: Column, i) -> Column:
    """The i-th number from 0 to 255 of a hash, again from the start after 64."""
    at = (i % 64) * 2 + 1
    return F.conv(F.substring(stream, at, F.lit(2)), 16, 10).cast("int")


def _letters(text: Column, stream: Column, keep_first_digit: Column) -> Column:
    """Each digit and letter becomes another of its sort, counted without other signs."""
    state = F.struct(F.lit("").alias("made"), F.lit(0).alias("n"))

    def step(a, c):
        number = _byte(stream, a["n"])
        digit = F.when(keep_first_digit & (a["n"] == 0), c).otherwise((number % 10).cast("string"))
        letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), number % 26 + 1, F.lit(1))
        new = (
            F.when(c.rlike("^[0-9]$"), digit)
            .when(c.rlike("^[a-z]$"), letter)
            .when(c.rlike("^[A-Z]$"), F.upper(letter))
        )
        return F.struct(
            F.concat(a["made"], F.coalesce(new, c)).alias("made"),
            (a["n"] + F.when(new.isNotNull(), 1).otherwise(0)).alias("n"),
        )

    return F.aggregate(F.split(text, ""), state, step)["made"]


def _syllable(syllables, stream):
    pool = F.array(*[F.lit(s) for s in syllables])
    return lambda i: F.get(pool, _byte(stream, i) % len(syllables))


def _listed(plain: Column) -> Column:
    """The gender of a listed given name in small letters, else null."""
    men, women = ([n.lower() for n in names] for names in (GIVEN_M, GIVEN_F))
    return F.when(plain.isin(men), "m").when(plain.isin(women), "f")


def _usual_sort(plain: Column) -> Column:
    return F.coalesce(_listed(plain), F.lit("s"))


def _with_luhn_digit(number: Column) -> Column:
    """A card number, with any separators, whose last digit is made to check."""

    def check(digits):
        size = F.length(digits)

        def add(total, i):
            digit = F.substring(digits, i, F.lit(1)).cast("int")
            double = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
            return total + F.when((size - i) % 2 == 1, double).otherwise(digit)

        total = F.aggregate(F.sequence(F.lit(1), size - 1), F.lit(0), add)
        return F.pmod(-total, F.lit(10)).cast("string")

    return _bound(number, lambda n: F.concat(
        n.substr(F.lit(1), F.length(n) - 1), _bound(F.regexp_replace(n, "[^0-9]", ""), check)
    ))


def _with_check_digits(account: Column) -> Column:
    """An account number whose two digits after the country are made to check (remainder of 97)."""

    def add(rest, c):
        letter = (rest * 100 + F.ascii(c) - 55) % 97
        return F.when(c.rlike("[A-Z]"), letter).otherwise((rest * 10 + F.ascii(c) - 48) % 97)

    def checked(a):
        signs = F.regexp_replace(a, " ", "")
        country = F.substring(signs, 1, 2)
        moved = F.concat(signs.substr(F.lit(5), F.length(signs)), country, F.lit("00"))
        rest = F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), add)
        check = F.lpad((98 - rest).cast("string"), 2, "0")
        return F.concat(F.substring(a, 1, 2), check, a.substr(F.lit(5), F.length(a)))

    return _bound(account, checked)


def _name(script: Column, sort: Column, written: Column, stream: Column, tries: Column) -> Column:
    """A made-up name of the same script and sort, longer after many tries."""
    made = F.lit(None).cast("string")
    for name, syllables in SYLLABLES.items():
        stem = F.transform(
            F.sequence(F.lit(0), F.lit(1) + F.floor(tries / 4).cast("int")),
            _syllable(syllables, stream),
        )
        ending = F.lit(None).cast("string")
        for sex, ends in ENDINGS[name].items():
            own = F.get(F.array(*[F.lit(e) for e in ends]), _byte(stream, F.lit(40)) % len(ends))
            ending = F.when(sort == sex, own).otherwise(ending)
        made = F.when(script == name, F.concat(F.array_join(stem, ""), ending)).otherwise(made)
    loud = (F.upper(written) == written) & (F.length(written) > 1)
    return F.when(loud, F.upper(made)).otherwise(F.initcap(made))


def _surrogate(
    kind: Column, plain: Column, written: Column, tries: Column, sort: Column, key: str
) -> Column:
    secret = F.concat_ws("|", F.lit(key), kind, plain, tries.cast("string"))
    made = lambda stream: _made_from(stream, kind, written, tries, sort)
    return _bound(F.sha2(secret.cast("binary"), 512), made)


def _made_from(stream: Column, kind: Column, written: Column, tries: Column, sort: Column) -> Column:
    # Letters and digits beyond ASCII become letters; small first, as in the normal form.
    local = F.lower(F.substring(F.substring_index(written, "@", 1), 1, MOST_LOCAL))
    local = F.regexp_replace(local, r"[^\x00-\x7F]", "x")
    at = F.concat(_letters(local, stream, F.lit(False)), F.lit("@"))
    place = _letters(F.lit("aaaaaa"), F.reverse(stream), F.lit(False))
    email = F.lower(F.concat(at, place, F.lit(".example.org")))
    octets = [_byte(stream, F.lit(0)) % 223 + 1, *[_byte(stream, F.lit(i)) for i in (1, 2, 3)]]
    numbers = F.concat_ws(".", *[o.cast("string") for o in octets])
    first = (kind == "card") | ((kind == "phone") & written.startswith("+"))
    rest = _letters(written.substr(F.lit(3), F.lit(1 << 20)), stream, F.lit(False))
    account = _with_check_digits(F.concat(F.substring(written, 1, 2), rest))
    script = F.substring_index(kind, "_", -1)
    name = _name(script, sort, written, stream, tries)
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", numbers)
        .when(kind == "iban", account)
        .when(kind == "card", _with_luhn_digit(_letters(written, stream, F.lit(True))))
        .when(F.startswith(kind, F.lit("name")), name)
        .otherwise(_letters(written, stream, first))
    )


def entities(found: DataFrame) -> DataFrame:
    """(kind, plain, sort): the different entities of arrays of matches ``found``.

    The sort of a name is what most of its mentions say; of as many, surname, then female.
    """
    matches = found.select(F.explode("found").alias("match")).groupBy("match").count()
    parts = matches.select(F.explode(_parts(F.col("match"))).alias("p"), "count")
    votes = [F.sum(F.when(F.col("p.sort") == x, F.col("count")).otherwise(0)).alias(x) for x in "sfm"]
    each = parts.groupBy("p.kind", "p.plain").agg(*votes)
    most = F.greatest("s", "f", "m")
    by_vote = F.when(most == 0, None).when(F.col("s") == most, "s").when(F.col("f") == most, "f")
    by_vote = F.when(most > 0, F.coalesce(by_vote, F.lit("m")))
    sort = F.coalesce(_listed(F.col("plain")), by_vote, F.lit("s"))
    return each.select("kind", "plain", sort.alias("sort"))


def collision_free(found: DataFrame, key: str, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(kind, plain, sort, tries): how often each entity is to be hashed, counted from 0."""
    found = stored(found, "entities")
    state = found.withColumn("tries", F.lit(0))
    for _ in range(most_rounds):
        made = _plain_of(F.col("kind"), F.col("plain"), F.col("tries"), F.col("sort"), key)
        state = stored(state.withColumn("made", made), "surrogates")
        real = found.select("kind", F.col("plain").alias("made"), F.lit(True).alias("real"))
        rank = F.struct("tries", "plain")
        first = state.groupBy("kind", "made").agg(F.min(rank).alias("first"))
        first = first.join(real, ["kind", "made"], "left")
        judged = state.join(first, ["kind", "made"])
        again = F.coalesce("real", F.lit(False)) | (rank != F.col("first"))
        judged = stored(judged.withColumn("again", again), "judged")
        if judged.filter("again").isEmpty():
            return judged.select("kind", "plain", "sort", "tries")
        tries = F.col("tries") + F.col("again").cast("int")
        state = judged.select("kind", "plain", "sort", tries.alias("tries"))
    raise RuntimeError(f"surrogates still collide after {most_rounds} rounds")


def _plain_of(kind, plain, tries, sort, key):
    made = _surrogate(kind, plain, plain, tries, sort, key)
    return F.when(F.startswith(kind, F.lit("name")), F.lower(made)).otherwise(made)


def _pattern_with_surnames(text: Column, found: Column) -> Column:
    """The entities' pattern, and the surnames among a text's matches wherever they stand.

    Words that the text also has in small letters are left out.
    """
    parts = F.flatten(F.transform(found, _parts))
    surnames = F.transform(F.filter(parts, lambda p: p["sort"] == "s"), lambda p: p["plain"])
    small = F.split(text, r"[^\p{L}\p{M}'’-]+")
    words = F.array_join(F.array_except(F.array_distinct(surnames), small), "|")
    alone = F.concat(
        F.lit(ENTITY + r"|(?<![\p{L}\p{M}-])(?=\p{Lu})(?iu:"), words, F.lit(r")(?![\p{L}\p{M}-])")
    )
    return F.when(words == "", ENTITY).otherwise(alone)


def _rewritten(text: Column, pattern: Column, known: Column | None, key: str) -> Column:
    """The text with all matches replaced.

    ``known`` maps 'kind|plain' to the tries and sort of unusual entities, or is null.
    """
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)

    def replaced(p):
        tries, sort = F.lit(0), _usual_sort(p["plain"])
        if known is not None:
            own = F.element_at(known, F.concat_ws("|", p["kind"], p["plain"]))
            tries, sort = F.coalesce(own["tries"], tries), F.coalesce(own["sort"], sort)
        return _surrogate(p["kind"], p["plain"], p["written"], tries, sort, key)

    def new_match(match):
        made = F.array_join(F.transform(_parts(match), replaced), " ")
        title = F.when(_kind(match) == "name", F.regexp_extract(match, rf"^(?:{_TITLE})\.? ", 0))
        return F.concat(F.coalesce(title, F.lit("")), made)

    # Pieces and replacements in turn; the last piece has no replacement.
    both = F.zip_with(
        between, F.transform(found, new_match), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))
    )
    return F.array_join(both, "")


def replace_entities(df: DataFrame, key: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with a surrogate for every entity in ``text``; all other columns as they are."""
    matches = F.regexp_extract_all(F.col(text), F.lit(ENTITY), F.lit(0))
    whole = df.select(F.struct(*df.columns).alias("row"), matches.alias("found"))
    # Texts are searched once; only those with a match are worked on further.
    whole = stored(whole, "searched")
    some = whole.filter(F.size("found") > 0)
    state = stored(collision_free(entities(some), key), "known")
    unusual = state.filter((F.col("tries") > 0) | (F.col("sort") != _usual_sort(F.col("plain"))))
    unusual = stored(unusual, "exceptions")
    some = some.withColumn("text", F.col("row").getField(text))
    some = some.withColumn("pattern", _pattern_with_surnames(F.col("text"), F.col("found")))
    if unusual.isEmpty():
        made = some.withColumn("new", _rewritten(F.col("text"), F.col("pattern"), None, key))
    else:
        # Only texts with such an entity meet a map of them.
        some = some.withColumn("hash", F.xxhash64("text"))
        parts = F.explode(F.array_distinct(F.flatten(F.transform("found", _parts))))
        each = some.select("hash", parts.alias("p")).select("hash", "p.kind", "p.plain").distinct()
        name = F.concat_ws("|", "kind", "plain")
        maps = each.join(unusual, ["kind", "plain"]).groupBy("hash").agg(
            F.map_from_entries(F.collect_list(F.struct(name, F.struct("tries", "sort")))).alias("known")
        )
        made = some.join(maps, "hash", "left")
        new = _rewritten(F.col("text"), F.col("pattern"), F.col("known"), key)
        made = made.withColumn("new", new)
    others = whole.filter("size(found) is null or size(found) <= 0")

    def columns(new):
        return [new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in df.columns]

    unchanged = others.select(*columns(F.col("row").getField(text)))
    return made.select(*columns(F.col("new"))).unionByName(unchanged)
