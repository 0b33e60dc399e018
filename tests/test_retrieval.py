"""Lexical index, vector index and fusion against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from loomline.operators import retrieval, vectors


def words(t):
    return re.sub("[^a-z0-9]+", " ", (t or "").lower()).split()


def plain_bm25(docs, asked, k):
    counts = {i: Counter(words(t)) for i, t in docs}
    size = {i: sum(c.values()) for i, c in counts.items()}
    mean, n = sum(size.values()) / len(size), len(size)
    df = Counter(w for c in counts.values() for w in c)
    out = {}
    for q, terms in asked.items():
        scores = {}
        for i, c in counts.items():
            hit = [w for w in terms if c[w]]
            if hit and i != q:
                scores[i] = sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * size[i] / mean)) for w in hit)
        out[q] = sorted(scores, key=lambda i: (-round(scores[i], 9), i))[:k]
    return out


def by_query(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.document_id)
    return out


@pytest.mark.parametrize("block_docs", [3, 50, 4096])
def test_lexical_search_skips_no_better_document(spark, tmp_path, block_docs):
    rng = random.Random(block_docs)
    vocabulary = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(40)], k=rng.choice([1, 3, 10, 80])))) for i in range(300)]
    docs += [(300 + i, "w39 w38 w0") for i in range(30)] + [(400, None), (401, ""), (402, "!!"), (403, "W7, w7; W8")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as term", "1 as block")
    asked = {q: rng.sample(vocabulary, rng.randint(1, 5)) for q in range(0, 300, 20)} | {7: ["nowhere"], 403: ["w7", "w39"]}
    rows = spark.createDataFrame([(q, t) for q, ts in asked.items() for t in ts], "query_id long, term string")
    index = retrieval.lexical_index(df, block_docs=block_docs)
    want = {q: r for q, r in plain_bm25(docs, asked, 10).items() if r}
    assert by_query(retrieval.search(index, rows, k=10)) == want
    index.write(str(tmp_path))
    assert by_query(retrieval.search(retrieval.LexicalIndex.read(spark, str(tmp_path)), rows, k=10)) == want
    if block_docs == 3:
        assert index.tops.where("term = 'w0'").count() > 20  # no list of a frequent word in one place
        assert index.postings.groupBy("term", "block").count().agg({"count": "max"}).first()[0] <= 30


def test_lexical_search_on_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a")], "query_id long, term string")
    assert retrieval.search(retrieval.lexical_index(none), asked).collect() == []
    some = retrieval.lexical_index(spark.createDataFrame([(2, "a b"), (None, "a a")], "doc_id long, text string"))
    assert by_query(retrieval.search(some, asked)) == {1: [2]} and retrieval.search(some, asked.limit(0)).collect() == []


def test_fusion_adds_reciprocal_ranks(spark):
    a = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (2, 1, 12)], "query_id long, rank int, document_id long")
    b = spark.createDataFrame([(1, 1, 11), (1, 2, 13)], "query_id long, rank int, document_id long")
    got = {(r.query_id, r["rank"]): (r.document_id, round(r.score, 9), r.a_rank, r.b_rank) for r in retrieval.fuse({"a": a, "b": b}).collect()}
    assert got == {
        (1, 1): (11, round(1 / 62 + 1 / 61, 9), 2, 1), (1, 2): (10, round(1 / 61, 9), 1, None), (1, 3): (13, round(1 / 62, 9), None, 2), (2, 1): (12, round(1 / 61, 9), 1, None),
    }


def clustered(seed, n=900, width=16):
    rng = np.random.default_rng(seed)
    tops = rng.normal(size=(30, width))
    return [(i, [float(x) for x in tops[rng.integers(30)] + 0.15 * rng.normal(size=width)]) for i in range(n)]


def plain_nearest(rows, asked, k):
    ids = np.array([i for i, v in rows if v is not None])
    m = np.array([v for _, v in rows if v is not None])
    m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    out = {}
    for q, v in asked:
        s = np.round(m @ (np.array(v) / (np.linalg.norm(v) or 1)), 9)
        out[q] = [int(ids[j]) for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
    return out


@pytest.mark.parametrize("cell_rows, query_rows", [(20_000, 20_000), (40, 5)])
def test_all_cells_are_exact_and_few_recall_most(spark, cell_rows, query_rows):
    rows = clustered(1) + [(1000 + i, [1.0] * 16) for i in range(300)] + [(5000, None), (5001, [0.0] * 16)]  # a third are one vector
    df = spark.createDataFrame(rows, "document_id long, embedding array<double>")
    asked = [(i, v) for i, v in rows if v and i % 50 == 0]
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    index = vectors.vector_index(df, cells=24, cell_rows=cell_rows)
    exact = vectors.vector_search(index, queries, 20, query_rows=query_rows)
    assert by_query(exact) == plain_nearest(rows, asked, 20)
    few = vectors.recall(vectors.vector_search(index, queries, 20, probes=6, query_rows=query_rows), exact).collect()
    assert len(few) == len(asked) and sum(r.recall for r in few) / len(few) >= 0.9
    if cell_rows == 40:
        assert index.parts.agg({"parts": "max"}).first()[0] >= 7 and index.rows.groupBy("cell", "part").count().agg({"count": "max"}).first()[0] < 150


def test_vector_search_on_empty_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "document_id long, embedding array<double>")
    queries = df.withColumnRenamed("document_id", "query_id")
    assert vectors.vector_search(vectors.vector_index(df.limit(0)), queries).collect() == []
    assert by_query(vectors.vector_search(vectors.vector_index(df), queries)) == {1: [2], 2: [1]}
    assert vectors.vector_search(vectors.vector_index(df), queries.limit(0)).collect() == []


def test_embeddings_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, "one two two"), (2, None), (3, ""), (4, "one two two"), (None, "x")], "doc_id long, text string")
    got = {r.document_id: r.embedding for r in vectors.embed(docs).collect()}
    assert got.keys() == {1, 2, 3, 4} and got[1] == got[4] and not any(got[2]) and not any(got[3]) and sum(x != 0 for x in got[1]) == 2


def test_recall_of_the_registered_index(spark):
    from loomline.plans.queries import QUERIES

    found = QUERIES["vector_recall"](spark, "/root/testdata/sf0.1").collect()
    assert len(found) >= 20 and sum(r.recall for r in found) / len(found) >= 0.9


@pytest.mark.parametrize("queries, parts", [(7, 3), (1 << 14, 1)])
def test_known_queries_need_no_postings_in_shuffles(spark, queries, parts):
    rng = random.Random(queries)
    vocabulary = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(40)], k=rng.choice([1, 3, 10, 80])))) for i in range(300)]
    docs += [(300 + i, "w39 w38 w0") for i in range(30)] + [(-5, "w1 w2"), (400, None), (401, ""), (402, "!!"), (403, "W7, w7; W8"), (None, "w1")]
    asked = {i: set(rng.sample(vocabulary, 3)) for i in range(0, 300, 11)} | {400: {"w0", "nowhere"}, 403: {"nowhere"}}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    terms = spark.createDataFrame([(q, t) for q, ts in asked.items() for t in ts], "query_id long, term string")
    got = retrieval.best_documents(retrieval.document_terms(df), terms, 10, queries, parts)
    want = plain_bm25([d for d in docs if d[0] is not None], asked, 10)
    assert by_query(got) == {q: ids for q, ids in want.items() if ids}
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert retrieval.best_documents(retrieval.document_terms(df), terms.limit(0), 10).collect() == []
    assert retrieval.best_documents(retrieval.document_terms(df.limit(0)), terms, 10).collect() == []


def test_lexical_results_shuffle_no_postings(spark):
    from loomline.plans.queries import QUERIES

    plan = QUERIES["lexical_results"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_fused_results_keep_vectors_once_and_no_words(spark):
    import os

    from loomline.operators.lineage import scratch_root
    from loomline.plans.oracles import SQL
    from loomline.plans.queries import QUERIES
    from tests.compare import compare

    root = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    assert compare(spark, "/root/testdata/sf0.001", QUERIES["fused_results"], SQL["fused_results"]) == ""
    columns = [set(spark.read.parquet(f"file:{root}/{d}").columns) for d in set(os.listdir(root)) - before]
    assert sum("v" in c for c in columns) == 1 and not any("counts" in c or "f" in c for c in columns)
