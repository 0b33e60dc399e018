"""Suffix-tree scores, spelling variants and whitening against brute force, with nulls, ties, repeats, long texts and clashing columns."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.llm import queries, spelling, suffix_tree, whitening

SF = "/root/testdata/sf0.001"


def with_extra(df):
    return df.selectExpr("*", "'r' as row", "1L as key", "2L as id", "'w' as word", "3L as n", "4L as block", "5 as part", "'x' as x", "'old' as whitened", "'s' as score")


# --- suffix tree


def plain_tree(docs, depth=2, least=4, threshold=18.0):
    """(id, held out, tokens, known, N, base, score) by counting all sequences in one place."""
    said = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in docs]
    held = [zlib.crc32(("null" if i is None else str(i)).encode()) % 7 == 2 for i, _ in said]
    count = collections.Counter()
    after = collections.defaultdict(collections.Counter)
    for (_, w), out in zip(said, held, strict=True):
        if not out:
            for k in range(depth + 1):
                for at in range(k, len(w)):
                    count[tuple(w[at - k : at + 1])] += 1
                    after[tuple(w[at - k : at])][w[at]] += 1
    total, distinct = sum(after[()].values()), len(after[()])
    states = {}
    for s, found in after.items():
        if s and count[s] >= least:
            shorter = s[1:]
            whole = count[shorter] if shorter else total
            llr = sum(n * math.log(n / count[s] / (after[shorter][x] / whole)) for x, n in found.items())
            if llr > threshold:
                states[s] = len(found)
    out = []
    for (i, w), h in zip(said, held, strict=True):
        base = score = 0.0
        for at, x in enumerate(w):
            p = (count[(x,)] + 1) / (total + distinct + 1)
            base += math.log10(p)
            for k in range(1, min(at, depth) + 1):
                s = tuple(w[at - k : at])
                if s in states:
                    p = (count[(*s, x)] + states[s] * p) / (count[s] + states[s])
            score += math.log10(p)
        out.append((i, h, len(w), sum(count[(x,)] > 0 for x in w), total, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


def scores(df, **more):
    return sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in suffix_tree.scored(df, **more).collect()], key=repr)


@pytest.mark.parametrize("depth, block_tokens, parts", [(2, 2_000_000, None), (2, 700, 3), (3, 5_000, 5), (1, 2_000_000, 2)])
def test_tree_equals_counting_in_one_place(spark, depth, block_tokens, parts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_tree([(r.doc_id, r.text) for r in docs.collect()], depth)
    assert scores(docs, depth=depth, block_tokens=block_tokens, parts=parts) == want
    assert any(x[5] != x[6] for x in want)


def test_tree_beats_its_root_on_texts_it_has_not_seen(spark):
    found = queries.QUERIES["op11_suffix_tree"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert found.s / found.n > found.b / found.n + 0.2


def test_tree_on_odd_tables(spark):
    long = " ".join(random.Random(1).choice("alpha beta gamma delta".split()) for _ in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "no id"), (4, "One one ONE"), (4, "one two"), (5, long), (6, long), (7, "x" * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert scores(with_extra(docs), block_tokens=3_000) == plain_tree(rows)
    assert scores(docs.limit(0)) == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    assert scores(spark.createDataFrame([(held, "all held out")], "doc_id long, text string")) == [(held, True, 4, 0, 0, 0.0, 0.0)]


def test_tree_sends_numbers_of_sequences_not_their_hashes(spark):
    def shuffled():
        found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
        return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = shuffled()
    suffix_tree.scored(docs)
    assert 0 < shuffled() - before < 2_000_000  # 64-bit hashes of word pairs and triples took 2.8 MB


def test_keys_of_sequences_are_exact_and_each_has_one_keeper():
    shares = suffix_tree.Shares(7, (5, 3))
    for order in (2, 3):
        context, word = (x.ravel() for x in np.meshgrid(np.arange(shares.numbers(order - 1)), np.arange(shares.numbers(1))))
        keys, limits = shares.keys(order, context, word), shares.limits(order)
        assert len(np.unique(keys)) == len(keys) and keys.max() < limits[-1] + shares.span(order)
        assert len(np.unique(np.searchsorted(limits, keys.astype(np.uint64), "right"))) == len(limits)
    words = np.concatenate([shares.number(1, part, np.arange(5)) for part in range(7)])
    assert sorted(words) == list(range(35)) and (np.diff(shares.by_keeper(1, words)) > 0).all()


def test_squeezed_values_come_back():
    v = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    for x in (v, v[:1], v[:0]):
        assert (suffix_tree.spread(suffix_tree.squeeze(x, True), True) == x).all() and (suffix_tree.spread(suffix_tree.squeeze(x)) == x).all()


# --- spelling variants


def plain_variants(docs, least_n=5, ratio=5):
    found = collections.Counter()
    for i, t in docs:
        for run in re.findall("[a-zÀ-ÿ]+", "".join(c.lower() if c.isascii() else c for c in t or "")):
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            found[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in found.items() if len(w) >= 6 and n >= least_n}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    by_size = collections.defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    others = {w: [v for d in (-1, 0, 1) for v in by_size[len(w) + d] if near(w, v)] for w in words}
    form = {}
    for w, vs in others.items():
        if vs:
            best = min(vs, key=lambda v: (-words[v], v))
            if words[best] >= ratio * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted([(w, form.get(w), root(w), n, len(others[w]), words.get(form.get(w))) for w, n in words.items()], key=repr)


def variants(df, **more):
    return sorted([(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(df, **more).collect()], key=repr)


def test_variants_equal_comparing_all_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert variants(docs) == want and any(x[1] for x in want)


def test_variants_of_planted_words(spark):
    base = ["letters", "lettters", "leters", "lettern", "étranger", "étrangers", "etranger", "aaaaaaaa", "aaaaaaa", "abababab", "babababa", "ababababa", "letter×s", "lettersx", "lettery", "xletters"]
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(base, weights=[500, 20, 60, 90, 300, 50, 9, 200, 30, 80, 80, 7, 6, 6, 100, 8], k=400)).upper().replace("É", "é")) for i in range(12)]
    rows += [(None, "letters " * 7), (3, None), (4, ""), (4, "leters-leters;leters"), (5, "x" * 30_000), (5, "y" + "x" * 29_999)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = plain_variants(rows)
    assert variants(with_extra(docs)) == want
    assert max(x[4] for x in want) >= 5
    assert variants(docs.limit(0)) == []


def test_chains_of_forms(spark):
    said = [("abcdefgh", 1000), ("abcdefg", 130), ("abcdeg", 25), ("abcdegz", 5)]
    docs = spark.createDataFrame([(1, " ".join(f"{w} " * n for w, n in said))], "doc_id long, text string")
    got = {x[0]: x for x in variants(docs, damaged=0)}
    assert got["abcdegz"][1:3] == ("abcdeg", "abcdefgh") and got["abcdeg"][2] == "abcdefgh" and got["abcdefgh"][1:3] == (None, "abcdefgh")


def test_colliding_keys_link_nothing(spark, monkeypatch):
    """With every key equal, only the rests themselves decide."""
    rows = [(1, "letters " * 50 + "lettars " * 6 + "unlikely " * 9 + "lettersy " * 7 + "nearby " * 8)]
    want = plain_variants(rows)
    group = [(i, tag, w, n) for i, (w, n) in enumerate([(x[0], x[3]) for x in want]) for tag in [spelling.WHOLE_TAG, *[2 * p for p in range(len(w)) if not p or w[p] != w[p - 1]], *[2 * p + 1 for p in range(len(w))]]]
    told = collections.Counter()
    for i, others, _, _ in spelling._told(group):
        told[i] += others
    assert [told[i] for i in range(len(want))] == [x[4] for x in want]


def test_deletion_keys_equal_hashes_of_the_rests():
    number, tag, key = spelling.deletion_keys(["banana", "banaa", "bananas", "panana", "ééé", "a"])
    by = {(int(n), int(t)): int(k) for n, t, k in zip(number, tag, key, strict=True)}
    assert by[0, 2 * 4] == by[1, -1] and by[2, 2 * 6] == by[0, -1] and by[0, 1] == by[3, 1] and len(set(by.values())) == len(by) - 4  # and banana and panana leave the same rest


# --- whitening


def plain_whitening(rows, components=16):
    kept = [(i, np.array([math.floor(64 * c) + 1_000_000 for c in v], object)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums).astype(np.float64) / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return {i: (n, int(((x * n - sums) ** 2).sum()), ((x * n - sums).astype(np.float64) / n) @ u / np.sqrt(e), e / np.trace(v)) for i, x in kept}


def test_whitening_equals_one_matrix(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    want = plain_whitening(rows)
    got = collections.defaultdict(dict)
    for r in queries.QUERIES["op13_whitening"](spark, SF).collect():
        got[r.vec_id][r.component] = r
    assert got.keys() == want.keys() and all(sorted(g) == list(range(1, 17)) for g in got.values())
    signs = np.sign([sum(got[i][k].whitened * want[i][2][k - 1] for i in want) for k in range(1, 17)])
    for i, (n, deviation, whitened, explained) in want.items():
        assert all(r.n == n and r.deviation == deviation and r.deviation_exact == str(deviation) and r.identity_error < 1e-9 for r in got[i].values())
        assert np.allclose([got[i][k].whitened for k in range(1, 17)], whitened * signs, rtol=1e-7, atol=1e-8)
        assert np.allclose([got[i][k].explained for k in range(1, 17)], explained, rtol=1e-9)


def test_whitening_of_odd_tables(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    good = [(i, [float(x) for x in rng.normal(0, 1, 3)]) for i in range(40)]
    rows = [*good, (100, None), (101, []), (102, [1.0, None, 2.0]), (103, [nan, 1.0, 1.0]), (104, [inf, 1.0, 1.0]), (5, good[5][1]), (None, good[6][1]), *[(200 + i, [1.0, 2.0, 3.0]) for i in range(500)], (3000, [1.0, 2.0])]
    df = with_extra(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7))
    out = whitening.whiten(df).collect()
    want = plain_whitening([r for r in rows if r[1] and len(r[1]) == 3])
    three = [r for r in out if r.vec_id != 3000]
    assert len(three) == 3 * (40 + 2 + 500) and {r.n for r in three} == {41}
    assert all(r.deviation == want[r.vec_id][1] and r.identity_error < 1e-9 for r in three if r.vec_id is not None)
    # one vector of its length has no variance
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in sorted(out, key=lambda r: r.component) if r.vec_id == 3000] == [(1, 1, 0, None, 0.0), (2, 1, 0, None, 0.0)]
    assert whitening.whiten(df.limit(0)).collect() == []
    with_column = whitening.whitened_column(df, whitening.fit(df))
    assert sorted(with_column.columns) == sorted(df.columns) and with_column.count() == len(rows)
    by_id = {r.vec_id: r.whitened for r in with_column.collect()}
    assert by_id[100] is None and by_id[3000] == [None, None] and np.allclose(by_id[7], [r.whitened for r in sorted(out, key=lambda r: r.component) if r.vec_id == 7])


def test_whitening_of_dependent_and_huge_entries(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(a), float(2 * a), 5.0]) for i, a in enumerate(rng.integers(-50, 50, 60))]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in out if r.whitened is not None} == {1} and all(r.identity_error < 1e-9 for r in out)
    rows = [(i, [float(a) * 1e15, float(i)]) for i, a in enumerate(rng.integers(-50, 50, 60))]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = plain_whitening(rows)
    assert all(r.deviation is None and r.deviation_exact == str(want[r.vec_id][1]) for r in out) and len(out) == 120


def test_merged_moments_equal_those_of_all():
    rng = np.random.default_rng(6)
    x = rng.integers(900_000, 1_100_000, (1000, 5))
    parts = [whitening.Moments.of(p, 1_000_000) for p in np.array_split(x, 7)]
    got = parts[0]
    for p in parts[1:]:
        got = got.merge(p)
    want = whitening.Moments.of(x, 1_000_000)
    assert got.n == 1000 and list(got.sums) == list(x.sum(axis=0)) and np.allclose(got.scatter, want.scatter, rtol=1e-12) and np.allclose(got.mean, want.mean)
