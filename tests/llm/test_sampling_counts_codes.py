"""Importance resampling, token counts and vector codes against brute force and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import compare
from tidemark.llm import resampling, token_counts, vector_codes
from tidemark.llm.common import read

DATA = "/root/testdata/sf0.01"


# --- importance resampling ------------------------------------------------------------------------

def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def grams_of(text, n):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("ngram", [1, 2, 3])
@pytest.mark.parametrize("scan", [1, 7, 64, 1 << 20])
def test_prefix_crcs_give_every_ngram(ngram, scan):
    rnd = random.Random(ngram * scan)
    for _ in range(60):
        texts = [None if rnd.random() < 0.1 else "".join(
            rnd.choice("aAbZ09éñ中 \n.,  _\U0001f600\x00") for _ in range(rnd.choice([0, 1, 5, 30, 400])))
            for _ in range(rnd.randint(0, 8))]
        if texts:  # words as long as, and longer than, what has a table of its own
            texts[0] = "x" * rnd.choice([63, 64, 65, 300, 5000]) + " y"
        found, words = [[] for _ in texts], [0] * len(texts)
        for crcs, owners, new in resampling.ngrams(pa.array(texts, pa.string()), ngram, scan):
            for crc, owner in zip(crcs.tolist(), owners.tolist()):
                found[owner].append(crc)
            for owner, n in enumerate(new.tolist()):
                words[owner] += n
        assert [sorted(x) for x in found] == [sorted(grams_of(t, ngram)) for t in texts]
        assert words == [len(words_of(t)) for t in texts]


def test_one_long_text_is_scanned_in_stretches():
    rnd = random.Random(2)
    text = " ".join("w" * rnd.choice([1, 3, 9]) + str(rnd.randint(0, 99)) for _ in range(60_000)) + " " * 5000 + "z" * 5000
    pieces = list(resampling.ngrams(pa.array(["a b", text, None, "c"]), 2, 1 << 12))
    assert len(pieces) > 50 and max(len(c) for c, _, _ in pieces) < 20_000
    found = Counter(c for crcs, owners, _ in pieces for c in crcs[owners == 1].tolist())
    assert found == Counter(grams_of(text, 2))


def brute_resample(docs, target, percent, min_words, seed):
    counts = {k: np.zeros(10_000) for k in "st"}
    for kind, texts in (("s", [t for _, t in docs]), ("t", target)):
        for text in texts:
            for crc in grams_of(text, 2):
                counts[kind][crc % 10_000] += 1
    s, t = counts["s"], counts["t"]
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10_000) / ((a + 1) * (t.sum() + 10_000)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text in docs:
        found = [gain[c % 10_000] for c in grams_of(text, 2)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(found), weight, score, len(words_of(text)) >= min_words))
    able = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[1]))
    drawn = [(*x[:4], i + 1 if i < percent * len(able) // 100 else None) for i, x in enumerate(able)]
    return drawn + [(*x[:4], None) for x in out if not x[4]]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


def test_resample_against_brute_force(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rnd.choice(vocab[:rnd.choice([20, 300])]) for _ in range(rnd.randint(0, 60)))) for i in range(400)]
    docs += [docs[7]] * 300 + [(7, "another text of this id " * 9), (None, "no id " * 30), (None, None), (500, None), (501, ""),
             (502, " \n "), (503, "Ünï CÖDE " * 2000), (504, "- " * 50)]  # a row that is over a third of the table
    target = ["w1 w2 w3 w4 w1 w2", None, "", "Ünï code"]
    table = spark.createDataFrame([(i, t, "x", 9) for i, t in docs], "doc_id long, text string, rank string, score int")
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    out = resampling.resample(table.repartition(5), aim)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert in_order(map(tuple, out.collect())) == in_order(brute_resample(docs, target, 25, 20, 7))
    again = resampling.resample(table.repartition(3), aim)
    assert in_order(map(tuple, again.collect())) == in_order(map(tuple, out.collect()))


def test_resample_keeps_columns_and_takes_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 20, "s"), (2, "c d " * 20, None)], "doc_id int, text string, `odd.name` string")
    none = docs.limit(0).select("text")
    out = resampling.resample(docs, none, percent=50, keep=docs.columns, min_words=1).collect()
    assert sorted((r["odd.name"] or "", r["text"]) for r in out) == [("", "c d " * 20), ("s", "a b " * 20)]
    assert sorted(r["rank"] or 0 for r in out) == [0, 1]
    assert resampling.resample(docs.limit(0), docs).count() == 0


def test_resampling_query_against_sql(spark):
    assert compare.check(resampling.query(spark, DATA), compare.connect(DATA), resampling.SQL) is None


def test_a_target_draws_its_like(spark):
    """Documents with the target's words are drawn more often than their share."""
    docs = [(i, " ".join(f"{'law' if i % 4 == 0 else 'chat'}{(i * 7 + k) % 40}" for k in range(30))) for i in range(1200)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    aim = spark.createDataFrame([(" ".join(f"law{k}" for k in range(40)),)] * 20, "text string")
    drawn = [r.doc_id for r in resampling.resample(table, aim).filter("rank is not null").collect()]
    assert len(drawn) == 300 and sum(i % 4 == 0 for i in drawn) > 200


# --- token counts ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    return token_counts.public_model()


def odd_texts(n, seed):
    rnd = random.Random(seed)
    words = ["the", "tokenization", "aaaa", "   ", "\n\n", "中文字", "亗", "\U0001f600", "€", "é", "ab" * 7, "x" * 40, "▁", "<s>", "12345"]
    for _ in range(n):
        yield rnd.choice([
            lambda: "a" * rnd.randint(1, 300),
            lambda: " " * rnd.randint(1, 300) + "".join(rnd.choice("ab ") for _ in range(50)),
            lambda: "".join(rnd.choice(words) + rnd.choice(["", " "]) for _ in range(60)),
            lambda: "".join(chr(rnd.choice([rnd.randint(32, 126), rnd.randint(0x4E00, 0x9FFF), rnd.randint(0xE000, 0xE010)]))
                            for _ in range(200)),
            lambda: "".join(rnd.choice("=-a\n") * rnd.randint(1, 20) for _ in range(30))])()


def test_spliced_counts_are_the_library_s(model):
    """Chunks far too short for the texts: every splice and every widening must come out right."""
    spliced = widened = 0
    counters = {(c, o): token_counts.Counter(model, c, o) for c in (3, 7, 20, 64) for o in (1, 2, 10) if o < c}
    for at, text in enumerate(odd_texts(600, 3)):
        counter = list(counters.values())[at % len(counters)]
        assert counter.counts([text, "", text]) == [len(counter.whole.encode(x)) for x in (text, "", text)], text
    for counter in counters.values():
        spliced, widened = spliced + counter.spliced, widened + counter.widened
    assert spliced > 1000 and widened > 1000


def test_huge_texts(model):
    counter = token_counts.Counter(model)
    for text in ("a" * 300_000, " " * 100_000, "\x00" * 70_000, "中" * 100_000, "one two  three\n" * 20_000):
        assert counter.counts([text]) == [len(counter.whole.encode(text))]
    assert counter.spliced > 10
    with pytest.raises(ValueError):
        token_counts.Counter(model, 10, 10)


def test_token_counts_with_odd_rows(spark, model):
    texts = [None, "", " ", "<s> </s> <unk>", "é中", "word " * 10_000, *odd_texts(40, 8)]
    rows = [(i, t, i, "x") for i, t in enumerate(texts)] + [(5, texts[5], 1, None), (None, "no id", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, `odd.name` string")
    out = token_counts.count_tokens(docs, model, limit=100, chunk=64, overlap=8)
    assert out.columns == ["doc_id", "text", "odd.name", "n_bytes", "n_tokens", "over_limit"]
    library = token_counts.Counter(model).whole
    wanted = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 100) for i, t, _, _ in rows]
    assert in_order((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect()) == in_order(wanted)
    assert token_counts.count_tokens(docs.limit(0), model).count() == 0


def test_token_count_query(spark, model):
    library = token_counts.Counter(model).whole
    wanted = [(r.doc_id, len(r.text.encode()), n := len(library.encode(r.text)), n > 4096) for r in read(spark, DATA, "documents").collect()]
    out = token_counts.query(spark, DATA)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert sorted(map(tuple, out.collect())) == sorted(wanted)


# --- vector codes ---------------------------------------------------------------------------------

def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Every part against every entry, in Python's whole numbers."""
    kept = [(i, label, [math.floor(x * scale) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) and abs(x) < 32768 for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    cut = lambda v: [x.tolist() for x in np.array_split(np.array(v, object), parts)]
    pieces = [cut(v) for _, _, v in kept]
    books = [[p[k] for p in pieces[:entries]] for k in range(parts)]
    def assigned():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[k])) for k, x in enumerate(p)] for p in pieces]
    for _ in range(rounds):
        found = assigned()
        for k in range(parts):
            for n in range(len(books[k])):
                mine = [p[k] for p, f in zip(pieces, found) if f[k][1] == n]
                if mine:
                    books[k][n] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(i, "".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f), label) for (i, label, _), f in zip(kept, assigned())]
    by_label = Counter()
    for _, _, error, label in out:
        by_label[label] += error
    return [(i, code, error, by_label[label], digest) for i, code, error, label in out]


def coded(df):
    return in_order((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def test_codes_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(16).tolist(), int(i % 3)) for i in range(300)]
    rows += [rows[20]] * 150 + [(20, rng.standard_normal(16).tolist(), None), (None, rng.standard_normal(16).tolist(), None),
             (900, None, 1), (901, [float("nan")] * 16, 1), (902, [1.0] * 15 + [None], 1), (903, [float("-inf")] * 16, 1),
             (904, [40000.0] * 16, 1), (905, [1.0, 2.0], 1), (906, [0.0] * 16, None), (907, [-30000.0] * 16, 2), (908, [], 2)]
    # ties: vectors on a coarse grid
    rows += [(1000 + i, rng.integers(-1, 2, 16).astype(float).tolist(), 5) for i in range(200)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, code string")
    out = vector_codes.compress(df.repartition(6))
    assert coded(out) == in_order(brute_codes(rows))


@pytest.mark.parametrize("size, n", [(13, 40), (3, 40), (0, 5), (16, 5), (8, 1)])
def test_codes_of_odd_lengths_and_few_rows(spark, size, n):
    rng = np.random.default_rng(size + n)
    rows = [(i, rng.standard_normal(size).tolist(), None) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert coded(vector_codes.compress(df)) == in_order(brute_codes(rows))


def test_codes_of_an_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compress(none).count() == 0
    with pytest.raises(ValueError):
        vector_codes.compress(none, entries=300)


def test_pivots_spare_evaluations_and_lose_none():
    rng = np.random.default_rng(9)
    for spread, most in ((1, 1 << 26), (1, 30), (1000, 20)):
        centres = rng.integers(-most, most, (16, 8)) * spread
        parts = centres[rng.integers(0, 16, 3000)] + rng.integers(-max(1, most // 40), max(2, most // 40), (3000, 8))
        pivots = vector_codes.pivots_of(centres)
        near = vector_codes._distances(parts, pivots).astype(np.float32).astype(np.float64)
        code, distance, evaluated = vector_codes.nearest(parts, near, centres, pivots)
        exact = ((parts[:, None, :] - centres[None]) ** 2).sum(2)
        assert (code == exact.argmin(1)).all() and (distance == exact.min(1)).all()
        assert evaluated < 0.6 * exact.size


def test_codes_query_against_sql(spark):
    assert compare.check(vector_codes.query(spark, DATA), compare.connect(DATA), vector_codes.SQL) is None
    evaluated = vector_codes.compress(read(spark, DATA, "embeddings")).agg(F.avg("evaluated")).first()[0]
    assert evaluated < 8 * 16
