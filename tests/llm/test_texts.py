"""Operators that turn each text into rows: codec, packing, secrets, rules, classifier."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playbill.llm import guess_cost, packing, piece_codec, quality_model, rule_cascade

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def strange_texts(count, seed):
    rng = random.Random(seed)
    parts = ["a", "b", "th", "ing", " ", "  ", "\n", "\t", "<s>", "<0x0A>", "▁", "▁▁", "é", "漢",
             "\U0001f600", "\x00", "aaaa", "1", "٣", "'s", "\x1c", "\x85", "\xa0", "!", "$$",
             "<|endoftext|>", "Ⅳ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(count)]


def test_pieces_equal_the_library():
    codec, library = piece_codec.PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(PIECES)
    texts = strange_texts(3000, 1)
    for text, ids in zip(texts, codec.encode(texts)):
        expected = library.encode(text, add_bos=True, add_eos=True)
        assert ids.tolist() == expected
        assert codec.decode(ids) == library.decode(expected)


def test_decoding_any_ids_equals_the_library():
    codec, library = piece_codec.PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(PIECES)
    rng = random.Random(2)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(259), rng.randrange(32000), 259]) for _ in range(8)]
        assert codec.decode(np.array(ids)) == library.decode(ids)


def test_round_trip_of_awkward_documents(awkward, nothing):
    library = sentencepiece.SentencePieceProcessor(PIECES)
    rows = piece_codec.round_trip(awkward, PIECES).collect()
    expected = collections.Counter()
    for r in awkward.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = hashlib.sha256(library.decode(ids).encode()).hexdigest()
        expected[r.doc_id, len(ids), digest, text] += 1
    assert collections.Counter(map(tuple, rows)) == expected
    assert piece_codec.round_trip(nothing, PIECES).count() == 0


def test_a_full_word_table_forgets_and_stays_right():
    codec = piece_codec.PieceCodec(PIECES)
    codec.words.limit = 50
    library = sentencepiece.SentencePieceProcessor(PIECES)
    for seed in range(6):
        texts = strange_texts(100, seed)
        assert [x.tolist() for x in codec.encode(texts)] == [
            library.encode(t, add_bos=True, add_eos=True) for t in texts
        ]


def test_byte_ids_equal_the_library():
    own, library = packing.ByteBpe(BYTES), Tokenizer.from_file(BYTES)
    assert own.ranked is not None
    texts = strange_texts(3000, 3)
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_byte_ids_of_cut_and_gappy_texts_equal_the_library(monkeypatch):
    own, library = packing.ByteBpe(BYTES), Tokenizer.from_file(BYTES)
    gap = packing.LONG_GAP
    long = [" " * 200_000, "\n" * 200_000, "x" + " " * (gap - 1) + "y", "x" + "\n" * gap + "y z",
            "one two " * 100_000, "a" * 300_000, "x \x1c y" * 50_000]
    assert len(list(own.parts(long[4]))) == 4
    for text, ids in zip(long, own.encode(long)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    whole = own.parts
    monkeypatch.setattr(own, "parts", lambda text: whole(text, 3))
    texts = strange_texts(2000, 5)
    for text, ids in zip(texts, own.encode(texts)):
        assert "".join(whole(text, 3)) == text
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_packed_pieces(awkward, nothing):
    library, window = Tokenizer.from_file(BYTES), 512
    rows = packing.pack_documents(awkward, BYTES, window).toPandas()
    pieces = collections.Counter()
    for r in awkward.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), window):
            part = np.array(ids[at : at + window], "<u4")
            pieces[str(r.doc_id), at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    found = zip(rows.doc_id, rows.start, rows.length, rows.ids_crc32, rows.doc_tokens)
    found = [("None" if d != d else str(int(d)), *rest) for d, *rest in found]
    assert collections.Counter(found) == pieces
    assert sorted(set(rows.sequence_id)) == list(range(rows.sequence_id.nunique()))
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert own.length.sum() <= window
    empty = packing.pack_documents(nothing, BYTES, window)
    assert empty.count() == 0 and "sequence_id" in empty.columns


def test_plan_uses_every_piece_once_with_little_padding():
    rng = random.Random(4)
    counts = collections.Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(20000))
    lengths = sorted(counts)
    plan = packing.plan_windows(lengths, [counts[n] for n in lengths], 2048)
    used = collections.Counter()
    for combination, repeats in plan:
        assert sum(combination) <= 2048 and repeats > 0
        for n in combination:
            used[n] += repeats
    assert used == counts
    tokens = sum(n * c for n, c in counts.items())
    sequences = sum(r for _, r in plan)
    assert sequences * 2048 < 1.01 * tokens


def base_spans(text):
    """The base patterns as the contract writes them."""
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c + "?" for c in w)
                    for w in ("password", "passwd", "secret", "token", "api_key"))
    assign = rf"({word})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text)
                  if len(m[0]) >= least]
    return sorted(found)


def test_base_patterns_against_the_plain_ones():
    rng = random.Random(5)
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "=", ": ", '"', "'", " ",
             "abc", "deadbeef", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "x", "\n", "K",
             "é", "="]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert guess_cost.base_spans(text) == base_spans(text), text


def test_guess_costs():
    cost = guess_cost.log_guesses
    assert cost("password") < cost("Password") < cost("hunter1999") < cost("Xk9#mQ2vLz")
    assert cost("aaaaaaaa") < 3 and cost("qwertyuiop") < 4 and cost("20210314") < 7
    assert cost("p@ssw0rd") < 2
    for value in ("zx", "q1w2", "Tr0ub4dor&3", "ÀÉİß漢"):
        assert 0 <= cost(value) < 40
    # Never dearer than brute force over the whole value.
    assert cost("kdjfhgie") <= 8 * np.log10(26) + 1e-9


def plain_log_guesses(value, ranks):
    """The cheapest of all segmentations, by trying each one."""
    from functools import cache

    per_character = np.log10(max(10, sum({10 if c.isdigit() else 26 if c.isalpha() else 33
                                          for c in value})
                                 + 26 * (value.lower() != value != value.upper())))
    low, plain = value.lower(), value.lower().translate(guess_cost.PLAIN)

    def options(a, b):
        """Guesses of the span as a whole, other than by brute force."""
        size, text = b - a, value[a:b]
        for form, extra in ((low, 1), (plain, 2)):
            if 3 <= size <= 24 and form[a:b] in ranks:
                yield ranks[form[a:b]] * extra * guess_cost._variations(text)
                break
        if size in (4, 6, 8, 9, 10) and guess_cost.DATE.fullmatch(text) and text[0].isdigit():
            yield 120 if size == 4 else 120 * 365 * 4
        whole_run = a == 0 or value[a - 1] != value[a]
        if size >= 3 and len(set(text)) == 1 and whole_run:
            yield guess_cost._alphabet(text[0]) * size
        steps = [(low[i], low[i + 1]) in guess_cost.NEXT_TO for i in range(a, b - 1)]
        if size >= 3 and all(steps) and (a == 0 or (low[a - 1], low[a]) not in guess_cost.NEXT_TO):
            yield 47 * 2 * size

    @cache
    def best(end):
        """{parts: cost} of cutting the first ``end`` characters."""
        found = {} if end else {0: 0.0}
        for start in range(end):
            spans = [(end - start) * per_character, *map(np.log10, options(start, end))]
            for parts, cost in best(start).items():
                more = cost + min(spans) + np.log10(parts + 1)
                found[parts + 1] = min(found.get(parts + 1, np.inf), more)
        return found

    return min(best(len(value)).values())


def test_segmentation_against_all_segmentations():
    rng = random.Random(12)
    parts = ["password", "tiger", "P4ss", "1999", "20210314", "aaaa", "qwerty", "xk", "Q9", "#", "zz",
             "monday", "7"]
    dearer = 0
    for _ in range(150):
        value = "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))[:14]
        exact, found = plain_log_guesses(value, guess_cost.RANKS), guess_cost.log_guesses(value)
        # The dynamic program keeps one number of parts for each end, so it may be a little dearer.
        assert exact - 1e-9 <= found <= exact + 0.5, value
        dearer += found > exact + 1e-9
    assert dearer < 15


def test_words_of_the_corpus_are_no_secrets(spark):
    said = ["secret: understanding", "token is Wednesday", "pin: absolutely", "auth: javascript",
            "bearer: permission"]
    rows = [(i, t) for i, t in enumerate(said)]
    rows += [(100 + i, " ".join(t.split()[-1] for t in said)) for i in range(3)]
    rows += [(200, "auth: Xk9mQ2vLz7Tq"), (201, None)]
    found = guess_cost.secret_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_guess for r in found if r.n_guess} == {200: 1}


def test_many_hits_in_one_text_take_linear_time():
    import time

    text = "password=abcdef12 auth: Xk9mQ2vLz7Tq " * 50_000
    start = time.process_time()
    base = guess_cost.base_spans(text)
    assert len(base) == 50_000
    assert len(guess_cost.guessed_spans(text, base, 99.0)) == 0
    assert time.process_time() - start < 30


def test_secrets_of_documents(spark, awkward, nothing):
    extra = spark.createDataFrame(
        [(900, "pwd: Xk9mQ2vLz7Tq and login = qwertyuiop, password=abcdef123", None, None, None)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    rows = guess_cost.secret_spans(extra).collect()
    assert rows[0].spans == "guess:5:17,assign:42:60" and rows[0].n_guess == 1
    found = collections.Counter()
    for r in guess_cost.secret_spans(awkward).collect():
        found[r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256] += 1
    expected = collections.Counter()
    for r in awkward.select("doc_id", "text").collect():
        spans = base_spans(r.text or "")
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected[(r.doc_id, *[sum(k == n for _, k, _ in spans) for n in range(3)], digest)] += 1
    assert found == expected
    assert guess_cost.secret_spans(nothing).count() == 0


def rule_figures(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered),
            failed)


def test_rules_against_plain_counting(spark, awkward, nothing):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += ["\n".join(rng.choice(["a b", "a b", "c", " ", ""]) for _ in range(12)) for _ in range(40)]
    more = spark.createDataFrame(list(enumerate(texts, 5000)), "doc_id long, text string")
    docs = awkward.select("doc_id", "text").union(more)
    found = rule_cascade.apply_rules(docs).collect()
    expected = collections.Counter((r.doc_id, *rule_figures(r.text)) for r in docs.collect())
    assert collections.Counter(tuple(r)[:-1] for r in found) == expected
    assert not any(r.kept and r.base_failed for r in found)
    assert rule_cascade.apply_rules(nothing).count() == 0
    kept = rule_cascade.keep_good(awkward)
    assert kept.columns == awkward.columns
    good = {r.doc_id for r in found if r.kept}
    assert {r.doc_id for r in kept.collect()} == good & {r.doc_id for r in awkward.collect()}


def test_the_order_of_rules_changes_no_verdict(awkward):
    rows = awkward.select("doc_id", "text")
    verdicts = [
        sorted(map(str, rule_cascade.judged(rows, list(rules)).select("doc_id", "kept").collect()))
        for rules in (rule_cascade.RULES, rule_cascade.RULES[::-1])
    ]
    assert verdicts[0] == verdicts[1]


def test_rules_are_ordered_by_what_is_left_to_reject():
    # The second rule rejects most, and all that the first one does; the third one is dear.
    patterns = [((True, True, False), 30), ((False, True, True), 10), ((False, False, True), 20)]
    assert rule_cascade.best_order([1.0, 1.0, 2.0], patterns) == [1, 2, 0]
    assert rule_cascade.best_order([0.5, 1.0, 2.0], patterns) == [0, 2, 1]
    assert sorted(rule_cascade.best_order([1.0, -1.0, 0.0], [])) == [0, 1, 2]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 11])
def test_repeated_windows_of_any_size(spark, size):
    rng = random.Random(size)
    rows = [(i, [rng.choice("ab") for _ in range(rng.randint(0, 30))]) for i in range(80)]
    frame = spark.createDataFrame(rows, "i int, words array<string>")
    found = rule_cascade.with_repeats(frame, rule_cascade.F.col("i") % 4 > 0, size).collect()
    for i, words in rows:
        windows = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]
        often = collections.Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(size)}
        assert (i, len(covered) if i % 4 else 0) in {(r.i, r.n_repeat_words) for r in found}


def test_rules_reject_what_they_name(spark):
    rng = random.Random(7)
    clean = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    texts = {
        "clean": clean,
        "symbols": clean.replace(" ", "$$$ "),
        "shouting": clean.upper(),
        "no_letters": clean.replace(" ", " | "),
        "short_words": " ".join(c for c in clean if c != " ")[:200],
        "long_words": " ".join(clean.replace(" ", "")[i : i + 40] for i in range(0, 300, 10)),
        "duplicate_lines": "\n".join([" ".join(clean.split()[:7])] * 3 + clean.split()[:2]),
    }
    rows = spark.createDataFrame(list(texts.items()), "name string, text string")
    kept = rule_cascade.keep_good(rows).select("name").collect()
    assert [r.name for r in kept] == ["clean"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(400):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
                 for _ in range(rng.randint(30, 200))]
        good = i % 4 != 0
        text = " ".join(words if good else [w.upper() + "!!" for w in words])
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good), 0))
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    return (
        spark.createDataFrame(docs, columns),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_classifier_on_held_out_rows(labelled):
    docs, labels = labelled
    machine = quality_model.train(docs, labels)
    rows = quality_model.score(docs, machine).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 40
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    expected = {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert {r.doc_id for r in rows} == expected


def test_scores_are_the_sum_over_all_pairs():
    rng = np.random.default_rng(9)
    size = quality_model.BUCKETS + 2 * quality_model.BINS
    machine = quality_model.Machine(
        np.tile(np.linspace(0, 1, quality_model.BINS - 1), (2, 1)), 0.3,
        rng.normal(0, 0.1, size), rng.normal(0, 0.1, (size, 3)),
    )
    flat, sizes, stats = np.array([3, 9, 700, 5]), np.array([3, 1]), rng.random((2, 2))
    at, value, owner = machine.inputs(flat, sizes, stats)
    for i, score in enumerate(machine.scores(flat, sizes, stats)):
        own = np.flatnonzero(owner == i)
        total = 0.3 + sum(machine.weights[at[k]] * value[k] for k in own)
        for p, k in enumerate(own):
            for m in own[:p]:
                both = machine.vectors[at[k]] @ machine.vectors[at[m]]
                total += both * value[k] * value[m]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9


def test_classifier_on_awkward_rows(awkward, nothing, labelled):
    docs, labels = labelled
    machine = quality_model.train(docs, labels)
    scored = quality_model.score(awkward, machine).collect()
    assert len(scored) == awkward.count() and all(0 <= r.score <= 1 for r in scored)
    kept = quality_model.keep_good(awkward, labels)
    assert kept.columns == awkward.columns
    none = labels.limit(0)
    assert {r.score for r in quality_model.score(docs, quality_model.train(docs, none)).collect()} == {0.5}
    one = labels.filter("quality = 1")
    always = quality_model.score(docs, quality_model.train(docs, one))
    assert always.filter("predicted = 0").count() == 0
    assert quality_model.score(nothing, machine).count() == 0
    unknown = labels.withColumn("quality", F.lit(None).cast("int"))
    assert quality_model.train(docs, unknown).bias == quality_model.train(docs, none).bias
