"""Quality, fill-in-the-middle and phrases against plain Python versions, and on odd input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sumweave.llm import fill_in_middle, phrases, quality

CLASHING = ("n", "form", "output", "stats", "y", "half", "run", "words", "w1", "pair", "level", "size", "phrase", "rank", "lang_", "draw_0", "score")


def frame(spark, rows, schema="doc_id long, text string, lang string"):
    df = spark.createDataFrame(rows, schema).repartition(5)
    for name in CLASHING:
        df = df.withColumn(name, F.lit("clash"))
    return df


# Fill in the middle.

@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aBcdé漢\n <P1", max_size=120), st.sampled_from([1, 3, 120]), st.sampled_from([7, 64, 1 << 20]))
def test_rank_index_gives_every_boundary(text, error, piece):
    kept, fill_in_middle.PIECE = fill_in_middle.PIECE, piece
    try:
        index = fill_in_middle.RankIndex(text.encode(), error)
    finally:
        fill_in_middle.PIECE = kept
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    ends = np.cumsum([0, *(len(t.encode()) for t in tokens)]).tolist()
    assert index.tokens == len(tokens) and [index.offset(k) for k in range(len(tokens) + 1)] == ends


def test_rank_index_is_small_for_long_texts():
    rng = random.Random(2)
    text = " ".join("x" * rng.randint(1, 9) for _ in range(300_000))
    index = fill_in_middle.RankIndex(text.encode())
    assert index.residuals.nbytes == index.tokens + 1 and len(index.firsts) < index.tokens / 500


def middle_rows(rows):
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
        n = len(tokens)
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
        if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
            out.append((doc_id, n, "plain", None, None, text))
        elif h[3] % 100 < 20:
            out.append((doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"))
        else:
            out.append((doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))
    return out


def middle_texts():
    rng = random.Random(5)
    texts = ["".join(rng.choice(["ab", "Z", "é", "漢", " ", "\n", "<", ">", "P", "S>", "<S", "9"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    rows = [(i, t, "en") for i, t in enumerate([*texts, None, "", " ", "a <M> b", "<", "word " * 40_000])]
    return [*rows, (None, "null id here", "en"), (3, texts[3], "en"), (3, "another text", None)]


def test_fill_in_middle(spark):
    rows = middle_texts()
    got = fill_in_middle.transform(frame(spark, rows)).collect()
    want = middle_rows(rows)
    assert Counter((*r[:5], bytes(r["output"]).decode()) for r in got) == Counter(want)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    digests = fill_in_middle.digests(frame(spark, rows)).collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert Counter((r[0], r["output_sha256"], r["restored_sha256"]) for r in digests) == Counter(
        (w[0], sha(w[5]), sha(t or "")) for w, (_, t, _) in zip(want, rows))


def test_fill_in_middle_of_nothing_and_other_rates(spark):
    df = frame(spark, middle_texts())
    assert fill_in_middle.digests(df.limit(0)).count() == 0
    assert {r["form"] for r in fill_in_middle.transform(df, rate=0).collect()} == {"plain"}
    assert {r["form"] for r in fill_in_middle.transform(df, rate=100, spm=100).collect()} == {"plain", "spm"}


# Phrases.

def brute_phrases(rows, longest=4, least=30, top=2000, taken=80):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for s in range(len(words) - size + 1):
                    counts[lang][tuple(words[s:s + size])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        inner = defaultdict(int)
        for p, a in found.items():
            for size in range(2, len(p)):
                for s in range(len(p) - size + 1):
                    inner[p[s:s + size]] = max(inner[p[s:s + size]], a)
        kept = []
        for p, a in found.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * inner[p] < taken * a:
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return Counter(out)


def phrase_texts(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "b", "cé", "d", "漢", "e", "of", "The", "x", "~", "é"]
    weights = [9, 7, 6, 5, 4, 3, 3, 2, 2, 1, 1]
    ends = [" "] * 14 + ["  ", "\t", ", ", ".", "\n", "\r\n", ";x", " \x0b "]
    rows = [(i, "".join(rng.choices(words, weights)[0] + rng.choice(ends) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None, "und"]))
            for i in range(n)]
    return [*rows, (None, None, "en"), (7, "", None), (8, " .\t, ", "fr"), (9, "lone", "fr"), rows[0], rows[0]]


@pytest.mark.parametrize("seed,least,longest,top", [(1, 3, 4, 2000), (2, 5, 2, 2000), (3, 2, 5, 40), (4, 30, 4, 2000)])
def test_phrases(spark, seed, least, longest, top):
    rows = phrase_texts(seed)
    got = phrases.mine(frame(spark, rows), longest=longest, least=least, top=top).collect()
    want = brute_phrases(rows, longest, least, top)
    assert len(want) > 5 and Counter(tuple(r) for r in got) == want


def test_phrases_with_a_full_bitmap_and_small_chunks(spark, monkeypatch):
    # A bitmap of one byte holds no news: no window is cut, and the result is the same.
    rows = phrase_texts(6)
    want = brute_phrases(rows, 4, 3)
    everything = np.full(1 << (phrases.MAP_BITS - 3), 255, dtype=np.uint8)
    monkeypatch.setattr(phrases, "frequent_runs", lambda texts, size, least, maps: everything)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 50)
    assert Counter(tuple(r) for r in phrases.mine(frame(spark, rows), least=3).collect()) == want


def test_phrases_of_nothing(spark):
    assert phrases.mine(frame(spark, phrase_texts(1)).limit(0)).count() == 0
    assert phrases.mine(frame(spark, [(1, None, None), (2, "", "en"), (3, "one two", "en")])).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 1 << 61
    counts = spark.createDataFrame([("en", 0, "", big), ("en", 1, "a", big - 3), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 5)],
                                   "lang string, size int, phrase string, n long")
    row = phrases.scored(counts).collect()[0]
    assert row["score"] == 2_000_000 * (big - 5) // (2 * big - 4) and row["n"] == big
    assert phrases.without_taken(phrases.scored(counts), 80, 4).count() == 1


# Quality.

def good_text(rng):
    return " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(30, 200))) + "."


def bad_text(rng):
    kind = rng.randint(0, 2)
    if kind == 0:
        return "".join(rng.choice("#$%&*|<>") for _ in range(rng.randint(50, 400)))
    if kind == 1:
        return (rng.choice(["buy now", "click here", "free"]) + " ") * rng.randint(20, 90)
    return good_text(rng).upper().replace(" ", "!! ")


def quality_rows(seed, n=900):
    rng = random.Random(seed)
    labels = [(i, int(rng.random() < 0.7)) for i in range(n)]
    rows = [(i, good_text(rng) if y else bad_text(rng), "xx") for i, y in labels]
    return rows, labels


def test_quality_on_held_out_labels(spark):
    rows, labels = quality_rows(1)
    odd = [(None, "no id", "x"), (10_000, None, "x"), (10_001, "", "x"), (10_002, " \n ", "x"), (10_003, rows[0][1], "x"), rows[0], (10_004, "x" * 300_000, "x")]
    known = spark.createDataFrame([*labels, (None, 1), (3, None), (5, 1), (5, 0), (99_999, 1)], "doc_id long, quality int")
    got = quality.judged(frame(spark, rows + odd), known).collect()
    assert len(got) == len(rows) + len(odd)
    truth = dict(labels)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 100 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    same = [r["score"] for r in got if r["doc_id"] in (rows[0][0], 10_003)]
    assert len(same) == 3 and len(set(same)) == 1
    assert len({r["score"] for r in got if r["doc_id"] in (10_000, 10_001, 10_002)}) == 1


def test_quality_ignores_held_out_labels(spark):
    rows, labels = quality_rows(2, 300)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = ({r["doc_id"]: round(r["score"], 9) for r in quality.judged(
        frame(spark, rows), spark.createDataFrame(x, "doc_id long, quality int")).collect()} for x in (labels, turned))
    assert a == b


def test_quality_is_ridge_regression(spark):
    """The distributed fit against the same equations in one piece."""
    rows, labels = quality_rows(3, 400)
    stats = quality.described(frame(spark, rows))
    model = quality.fit(stats, spark.createDataFrame(labels, "doc_id long, quality int"))
    used = [(t, y) for (i, t, _), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 5]
    x = quality.statistics([t.encode() for t, _ in used]).astype("<f4").astype(float)
    y = np.array([y for _, y in used], float)
    np.testing.assert_allclose(model.centre, x.mean(axis=0), rtol=1e-9)
    z = model.features(x)
    ridge = np.full(z.shape[1], quality.RIDGE * len(y))
    ridge[-1] *= 1e-3
    np.testing.assert_allclose(z @ model.weights, z @ np.linalg.solve(z.T @ z + np.diag(ridge), z.T @ y), atol=1e-6)
    assert (np.diff(model.values) >= 0).all() and (np.diff(model.knots) > 0).all()


def test_random_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    k = len(quality.STATISTICS)
    model = quality.Model(0.5, np.zeros(k), np.ones(k))
    x = rng.standard_normal((40, k))
    z = model.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / 2 / quality.WIDTH ** 2)
    assert np.abs(z @ z.T - exact).max() < 0.3 and np.abs(z @ z.T - exact).mean() < 0.06


@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 9)), min_size=1, max_size=30))
@settings(max_examples=60, deadline=None)
def test_isotonic(cells):
    y, w = np.array([c[0] for c in cells], float), np.array([c[1] for c in cells], float)
    centres, values = quality.isotonic(np.arange(len(y), dtype=float), y, w)
    # The nearest rising function, by its max-min form.
    means = lambda i, j: (y[i:j + 1] * w[i:j + 1]).sum() / w[i:j + 1].sum()
    want = [max(min(means(i, j) for j in range(k, len(y))) for i in range(k + 1)) for k in range(len(y))]
    distinct = [v for k, v in enumerate(want) if k == 0 or abs(v - want[k - 1]) > 1e-9]
    np.testing.assert_allclose(values, distinct, atol=1e-9)


def test_quality_without_labels_or_rows(spark):
    rows, labels = quality_rows(4, 30)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.judged(frame(spark, rows), none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i, _ in labels], "doc_id long, quality int")
    assert {r["score"] for r in quality.judged(frame(spark, rows), ones).collect()} == {1.0}
    assert quality.judged(frame(spark, rows).limit(0), ones).count() == 0
