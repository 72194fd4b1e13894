"""Operators that make training input: token files, whitened vectors, fill-in-the-middle texts."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playbill.llm import fill_in_middle, token_files, whitening
from playbill.llm.support import stored
from playbill.session import fresh_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def rising(rng):
    count = rng.choice([0, 1, 2, 7, 4095, 4096, 4097, 9000])
    universe = rng.choice([0, 1, count, 10 * count, 2**20, 2**40, 2**63, 2**64 - 1])
    return np.sort(np.array([rng.randint(0, universe) for _ in range(count)], np.uint64)), universe


def test_elias_fano_finds_every_number_in_little_space():
    rng = random.Random(21)
    for _ in range(200):
        values, universe = rising(rng)
        count = len(values)
        data = token_files.EliasFano.encode(values, universe).to_bytes()
        read, end = token_files.EliasFano.read(memoryview(data), 0, count, universe)
        assert end == len(data)
        assert [x for _, own in read.blocks() for x in own.tolist()] == values.tolist()
        if not count:
            continue
        first = rng.randint(0, count)
        past = rng.randint(first, count)
        assert read.between(first, past).tolist() == values[first:past].tolist()
        place = rng.randrange(count)
        assert read.select(place) == int(values[place])
        sought = rng.randint(0, universe)
        assert read.first_at_least(sought) == int(np.searchsorted(values, np.uint64(sought)))
        share = max(0, math.log2(universe / count)) if universe else 0
        marks = 32 * (count // token_files.SELECT_EVERY + 1)
        assert 8 * len(data) <= count * (3 + share) + marks + 24


def tokens_of(rows):
    """(doc_id, start, n_tokens, crc) as the library gives them, for rows in order."""
    library, start, made = Tokenizer.from_file(BYTES), 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        made.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return made


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.fixture(scope="module")
def numbered(spark):
    rng = random.Random(22)
    rows = [(i * 3 - 50, " ".join(rng.choice(["one", "two,", "é漢", "\n", "<|endoftext|>"])
                                   for _ in range(rng.randint(0, 80)))) for i in range(200)]
    rows += [(-(2**63), "lowest"), (2**63 - 1, "highest"), (700, None), (701, "")]
    rows += [(800, "long " * 20_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return rows, stored(frame.repartition(5), "numbered")


def test_token_files_give_back_every_document(spark, numbered):
    rows, frame = numbered
    expected = tokens_of(in_order(rows))
    for tokens, task_bytes in ((2**24, 2**25), (500, 5000)):
        path = fresh_path(spark, "token-files")
        token_files.write_token_files(frame, path, BYTES, 2, "doc_id", "text", tokens, task_bytes)
        found = token_files.read_documents(spark, path).collect()
        assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    files = token_files.file_index(spark, path).orderBy("first_start").collect()
    assert len(files) > 30 and files[0].first_start == 0
    for a, b in zip(files, files[1:]):
        assert a.first_start + a.tokens == b.first_start and a.last_doc <= b.first_doc
    long = token_files.look_up(spark, path, [800, -(2**63), 2**63 - 1, 12345]).collect()
    library = Tokenizer.from_file(BYTES)
    texts = dict(rows)
    assert {r.doc_id for r in long} == {800, -(2**63), 2**63 - 1}
    for r in long:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
    assert token_files.look_up(spark, path, [12345]).count() == 0


def test_token_files_of_awkward_documents(awkward, nothing):
    found = sorted(map(tuple, token_files.token_round_trip(awkward, BYTES).collect()),
                   key=lambda r: r[1])
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    library = tokens_of(rows)
    # Rows that share an id may come in any order of their texts.
    assert collections.Counter((d, *rest) for d, _, *rest in found) == collections.Counter(
        (d, *rest) for d, _, *rest in library)
    ids = [r[0] for r in found]
    assert ids == [r[0] for r in in_order(rows)]
    ends = [r[1] + r[2] for r in found]
    assert [r[1] for r in found] == [0, *ends[:-1]]
    assert token_files.token_round_trip(nothing, BYTES).count() == 0


def test_a_hot_document_id_is_shared_by_tasks(spark):
    rows = [(9, "the same text")] * 600 + [(1, "first"), (12, "last")]
    path = fresh_path(spark, "token-files")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    token_files.write_token_files(frame, path, BYTES, 2, task_bytes=2000)
    index = token_files.file_index(spark, path).collect()
    assert len(index) > 5 and max(r.docs for r in index) < 300
    assert token_files.look_up(spark, path, [9]).count() == 600


def spectrum_of(rows):
    seen = whitening.Spectrum.empty(rows.shape[1])
    for row in rows:
        seen.add(row)
    return seen


def awkward_matrices():
    rng = np.random.default_rng(23)
    yield rng.normal(size=(200, 12))
    yield rng.normal(size=(200, 12)) * np.logspace(0, -8, 12)  # far apart
    yield np.repeat(rng.normal(size=(6, 10)), 30, 0)  # few different rows
    yield rng.integers(0, 2, size=(200, 8)).astype(float)
    yield np.eye(9)[rng.integers(0, 9, 300)] * 7  # equal eigenvalues
    yield np.r_[np.eye(5), -np.eye(5), np.eye(5)]
    yield np.ones((30, 6))
    yield np.zeros((3, 4))
    yield rng.normal(size=(100, 2)) @ rng.normal(size=(2, 11))  # two directions only
    yield rng.normal(size=(50, 1))
    yield rng.normal(size=(1, 5))


@pytest.mark.parametrize("rows", list(awkward_matrices()))
def test_updated_and_combined_spectra_equal_the_scatter(rows):
    away = rows - rows.mean(0)
    scatter = away.T @ away
    scale = max(np.abs(scatter).max(), 1e-300)
    parts = [spectrum_of(p) for p in np.array_split(rows, 4)]
    merged = whitening.Spectrum.empty(rows.shape[1])
    for part in parts:
        merged.combine(part)
    for found in (spectrum_of(rows), merged):
        assert found.n == len(rows) and np.allclose(found.mean, rows.mean(0))
        rebuilt = (found.vectors * found.values) @ found.vectors.T
        assert np.abs(rebuilt - scatter).max() <= 1e-12 * scale
        square = found.vectors.T @ found.vectors
        assert np.abs(square - np.eye(len(square))).max(initial=0) < 1e-12
        assert (np.diff(found.values) >= 0).all()


def test_secular_roots_lie_between_the_poles():
    rng = np.random.default_rng(24)
    for n in (1, 2, 3, 20):
        for spread in (1.0, 1e-6, 1e6):
            poles = np.sort(rng.random(n)) * spread
            weights = rng.random(n) ** 8 + 1e-9
            delta = whitening.secular_roots(poles, weights)
            roots = poles - np.diag(delta)
            assert (roots >= poles).all() and (roots[:-1] <= poles[1:]).all()
            exact = np.linalg.eigvalsh(np.diag(poles) + np.sqrt(np.outer(weights, weights)))
            assert np.allclose(roots, exact, rtol=1e-10, atol=1e-12 * exact[-1])


def check_whitened(frame, found, shown=8):
    rows = [(r.vec_id, r.embedding) for r in frame.collect() if r.embedding is not None
            and all(c is not None and math.isfinite(c) for c in r.embedding)]
    whole = np.array([[math.floor(1024 * c) + 100_000 for c in own] for _, own in rows], object)
    n, sums = len(whole), whole.sum(0)
    away = n * whole - sums
    exact = (away / n).astype(float)
    covariance = exact.T @ exact / n
    values, vectors = np.linalg.eigh(covariance)
    shown = min(shown, len(values))
    deviations = collections.Counter(
        (i, int(sum(x * x for x in row))) for (i, _), row in zip(rows, away))
    for k in range(1, shown + 1):
        own = [r for r in found if r.component == k]
        assert collections.Counter((r.vec_id, int(r.deviation)) for r in own) == deviations
        value, vector = values[-k], vectors[:, -k]
        expected = exact @ vector / math.sqrt(value)
        by_id = collections.defaultdict(list)
        for (i, _), x in zip(rows, expected):
            by_id[i].append(x)
        misses = [max(min(abs(sign * r.whitened - x) for x in by_id[r.vec_id]) for r in own)
                  for sign in (1, -1)]
        assert min(misses) < 1e-9
        assert {r.n for r in own} == {n}
        assert all(abs(r.explained - value / np.trace(covariance)) < 1e-10 for r in own)
        assert all(r.identity_error < 1e-10 for r in own)
    assert len(found) == n * shown


def test_whitening_against_a_whole_decomposition(spark):
    rng = random.Random(25)
    rows = [(i, [rng.gauss(0, 1 + j) for j in range(10)], 1) for i in range(200)]
    rows += [(77, [0.25] * 10, 2)] * 100 + [(None, [0.5] * 10, None)] * 2 + [
        (301, None, 1), (302, [None] * 10, 1), (303, [float("nan")] * 10, 1),
        (304, [1.0] * 9 + [float("-inf")], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")
    frame = stored(frame.repartition(20).withColumn("component", F.lit("x")), "vectors")
    for at_once in (3, 16):
        check_whitened(frame, whitening.whiten(frame, at_once=at_once).collect())
    assert whitening.whiten(frame.limit(0)).count() == 0
    large = whitening.whiten(frame.withColumn("embedding", F.transform("embedding", lambda c: c * 1e8)))
    assert large.agg(F.max("deviation")).first()[0] > 2**64  # exact beyond 64 bits


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(1, [0.5, 1.5])], schema)
    assert [tuple(r)[3:] for r in whitening.whiten(one).collect()] == [(0, None, None, None)] * 2
    rows = [(i, [0.5 * i, 1.5, 2.0]) for i in range(4)]
    flat = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert [r.whitened is None for r in sorted(flat, key=lambda r: r.component)] == [False] * 4 + [True] * 8
    with pytest.raises(ValueError, match="different lengths"):
        whitening.whiten(one.union(spark.createDataFrame(rows, schema)))
    assert whitening.whiten(spark.createDataFrame([(1, [])], schema)).count() == 0


def plain_fim(doc_id, text):
    """The contract, by slices."""
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(text), "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(text), "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle_against_slices(spark, awkward, nothing):
    texts = ["a<P>b", "x<S", "<M>", "<" * 300, "<P<S<M" * 50, "$1\\$2\\Q", "a\u0301\U0001f600" * 400,
             "\r\n\u0085\u2028" * 9, "ab" * 700_000, "x" * 1023, "x" * 1024, "x" * 1025]
    rows = [(1000 + 7 * i + j, t) for j in range(7) for i, t in enumerate(texts)]
    frame = awkward.select("doc_id", "text").union(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    made = fill_in_middle.fill_in_middle(frame)
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    found = made.withColumn("same", back == F.coalesce("text", F.lit(""))).collect()
    expected = collections.Counter((r.doc_id, *plain_fim(r.doc_id, r.text)) for r in frame.collect())
    assert collections.Counter(
        (r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found) == expected
    assert all(r.same for r in found)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(nothing).count() == 0
    # Columns that clash are replaced, others stay.
    clashing = fill_in_middle.fill_in_middle(awkward.withColumn("n", F.lit("x")))
    assert "score" in clashing.columns and clashing.columns.count("n") == 1


def test_fill_in_middle_by_words(spark):
    frame = spark.createDataFrame([(i, " one two\nthree  four " * 5) for i in range(30)], "doc_id long, text string")
    unit = r"(?:\S+\s*+|\s+)"
    made = fill_in_middle.fill_in_middle(frame, unit=unit, plain_percent=0)
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    rows = made.withColumn("back", back).collect()
    assert all(r.back == r.text and r.n == 21 for r in rows)
    for r in rows:
        prefix = r.output.split("<P>")[1].split("<S>" if r.form == "psm" else "<M>")[0]
        assert r.text.startswith(prefix)
        # The space before the first word is a unit of its own.
        assert len(prefix.split()) == max(0, r.prefix_chars - 1)
