"""Steps that must not grow faster than their input."""

import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from loomline.functions.arrays import most_common
from loomline.functions.text import clip_text, collapse, collapsed_start, is_substantive, short_text, tag_words, top_tags
from loomline.operators import chunking, hierarchy, packing, positions, reduction, retrieval, topics, vectors
from loomline.operators.lineage import cut


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tag_words_are_counted_in_their_row(spark):
    texts = ["alpha beta Alpha_ beta-- gammaKelvin cafés", "", None, "because because thin this this x_y-z abcd-_ abcd"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in d.select(top_tags("text", 3)["tag"].alias("a"), most_common(tag_words("text"), 3).alias("b")).collect():
        assert r.a == r.b
    assert "Exchange" not in plan(chunking.topic_tags(d, ["doc_id"]))
    twice = d.union(d.where("doc_id = 0"))
    assert {(r.tag, r.n) for r in chunking.topic_tags(twice, ["doc_id"]).where("doc_id = 0").collect()} >= {("alpha", 4), ("beta", 4)}


def test_words_of_a_document_are_one_row(spark):
    d = spark.createDataFrame([(1, "a b a"), (2, None), (3, "c")], "doc_id long, text string")
    terms = retrieval.document_terms(d)
    assert "Exchange" not in plan(terms)
    assert {r.document_id: {c.term: c.n for c in r.counts} for r in terms.collect()} == {1: {"a": 2, "b": 1}, 2: {}, 3: {"c": 1}}
    twice = retrieval.document_terms(d.union(spark.createDataFrame([(1, "b"), (None, "a")], d.schema)))
    assert {r.document_id: {c.term: c.n for c in r.counts} for r in twice.collect()} == {1: {"a": 2, "b": 2}, 2: {}, 3: {"c": 1}}


def test_an_index_of_the_asked_words_finds_the_same(spark):
    rng = random.Random(3)
    d = spark.createDataFrame([(i, " ".join(rng.choices("abcdefgh", k=rng.randint(1, 9)))) for i in range(60)], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a"), (1, "c"), (2, "h"), (2, "none")], "query_id long, term string")
    terms = cut(retrieval.document_terms(d))
    part, whole = (retrieval.index_of(terms, a, 16) for a in (asked, None))
    assert part.postings.count() < whole.postings.count()
    found = [sorted(map(tuple, retrieval.search(i, asked, 5).collect())) for i in (part, whole)]
    assert found[0] == found[1] and len(found[0]) == 10


def test_a_cut_is_columns(spark):
    df = cut(spark.range(5).withColumn("x", F.array(F.col("id"))))
    assert "parquet" in plan(df).lower() and sorted(r.id for r in df.collect()) == list(range(5))
    assert cut(df.where("id < 0")).collect() == []


def test_the_length_of_a_vector_is_worked_out_once(spark):
    d = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "e array<double>")
    assert [r.v for r in d.select(vectors.unit("e").alias("v")).collect()] == [[0.6, 0.8], [0.0, 0.0]]
    text = d.select(vectors.unit("e").alias("v"))._jdf.queryExecution().analyzed().toString()
    assert text.count("aggregate(") == 1


def test_copies_are_one_while_pairs_are_sought(spark):
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(base)) for i in range(6)] + [(6, " ".join(reversed(base))), (7, " ".join([*base, "extra"])), (8, "other words"), (9, ""), (10, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert hierarchy.like_pairs(hierarchy.token_sets(d, [], "doc_id", "text"), 0.92).count() == 1
    found = {(r.a, r.b): round(r.similarity, 6) for r in hierarchy.near_pairs(d, [], "doc_id", "text").collect()}
    assert found == {(i, j): 1.0 if j < 7 else round(40 / 41, 6) for i in range(8) for j in range(i + 1, 8)}


def test_greedy_duplicates_hold_no_source_whole(spark):
    words = [f"w{i}" for i in range(100)]
    # each text is like the next two of its chain, so that the third is kept again
    rows = [("s", i, " ".join(words[i * 3 : i * 3 + 70])) for i in range(6)] + [("s", 6, ""), ("s", 7, ""), (None, 8, "one two"), (None, 9, "two one")]
    d = spark.createDataFrame(rows, "source string, doc_id long, text string")
    kept: list[set[str]] = []
    want = set()
    for _, i, t in rows[:6]:
        s = set(t.split())
        if any(len(s & k) / len(s | k) >= 0.9 for k in kept):
            want.add(i)
        else:
            kept.append(s)
    out = hierarchy.near_duplicates(d.where("source is not null"), ["source"], "doc_id", "text", 0.9)
    assert "InPandas" not in plan(out)
    assert {r.doc_id for r in out.where("duplicate").collect()} == want | {7} and want and len(want) < 5


def test_clusters_hold_no_square_of_distances():
    x = np.random.default_rng(1).normal(size=(3000, 5))
    tracemalloc.start()
    hierarchy.density_clusters(x, 8)
    assert tracemalloc.get_traced_memory()[1] < 250e6
    tracemalloc.stop()


def test_excerpts_are_cut_once_a_node(spark):
    n = spark.createDataFrame([("p", "P", "e", "E", "2026-01-01", 1, "1", "position_card", ["alpha", "beta"], ["alpha"], "", "S", "some  text", "d")], "podcast_id string, podcast_name string, episode_key string, episode_title string, episode_date string, seq long, node_id string, node_type string, topic_tags array<string>, keywords array<string>, claim string, speaker string, page_content string, stable_document_id string")
    hits = topics.topic_hits(n)
    assert "shown" in hits.columns and {(r.raw_label, r.excerpt) for r in hits.collect()} == {("alpha", "some text"), ("beta", "some text")}


def test_the_start_of_a_text_is_collapsed_alone(spark):
    odd = ["", None, " ", "a b", " \t\n" * 90 + "word, and. more; " * 9, "x" * 300, "one. " * 80 + " " * 500, " lead" + " " * 200 + "tail. " * 9, "a" * 20 + " " * 5, "a" * 21 + "\u00a0é \U0001f600" * 30]
    d = spark.createDataFrame([(t,) for t in odd], "text string")
    whole = collapse("text")
    for most in (1, 20, 21, 100):
        start = collapsed_start("text", most)
        r = d.select(whole.alias("w"), start.alias("s"), is_substantive("text", most).alias("i"), short_text("text", most + 3).alias("t"), clip_text("text", most).alias("c"), clip_text(collapse("text"), most).alias("d")).collect()
        for x in r:
            assert x.w.startswith(x.s) and (x.s == x.w or len(x.s) > most) and x.i == (len(x.w) >= most) and x.c == x.d
            assert x.t == (x.w if len(x.w) <= most + 3 else x.w[:most] + "...")


def test_long_texts_are_split_in_the_pass_that_reads_them(spark):
    d = spark.createDataFrame([(1, 0, "short"), (2, 0, None), (3, 0, "some words, and more of them. " * 12), (4, 0, "x" * 130 + " " * 90)], "k long, place long, text string")
    out = reduction.split_blocks(d, 100, 20)
    assert "Union" not in plan(out)
    found = {k: [r.text for r in out.where(F.col("k") == k).orderBy("part").collect()] for k in (1, 2, 3, 4)}
    assert found == {1: ["short"], 2: [], 3: [p for p in reduction.parts_of("some words, and more of them. " * 12, 100, 20) if len(p) >= 40], 4: ["x" * 100]}


def test_evidence_is_joined_as_excerpts(spark):
    n = spark.createDataFrame([("e", "1", 0.0, 1.0, "some  text " * 90, ["1"], [0.5])], "episode_id string, node_id string, start_time double, end_time double, page_content string, source_segment_ids array<string>, source_spans array<double>")
    p = spark.createDataFrame([("p", "e", ["none", "1"]), ("q", "e", ["none"])], "position_id string, episode_id string, evidence_node_ids array<string>")
    out = positions.resolve_evidence(p, n)
    said = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("page_content" in x for x in said.split("\n") if "Aggregate" in x)
    assert {r.position_id: r.evidence and [(e.node_id, len(e.excerpt)) for e in r.evidence] for r in out.collect()} == {"p": [("1", 362)], "q": None}


def test_positions_count_no_tags(spark):
    from loomline.plans import queries

    assert "Python" not in plan(queries.position_cards(spark, "/root/testdata/sf0.001"))


def test_texts_are_tagged_once_however_often_hits_are_read(spark):
    from loomline.plans import queries, tables

    sf = "/root/testdata/sf0.001"
    hits = topics.topic_hits(tables.nodes(spark, sf))
    assert "Python" not in plan(hits)
    contribs = topics.contributions(hits)
    depths, index = topics.topic_depths(contribs), topics.topic_index(contribs)
    assert "Exchange hash" not in plan(depths) and "m_evidence" not in depths.columns
    same = ["podcast_id", "normalized_label", "depth_score", "episode_count", "document_count"]
    assert sorted(map(tuple, depths.select(*same).collect())) == sorted(map(tuple, index.select(*same).collect())) != []
    assert {"evidence", "related_doc_ids", "representative_episode_title", "representative_excerpt", "latest_evidence"} <= set(index.columns)
    short = topics.topic_index(contribs, proof=False)
    assert sorted(map(tuple, short.select("normalized_label", "label", "summary").collect())) == sorted(map(tuple, index.select("normalized_label", "label", "summary").collect()))


def test_a_node_of_one_tag_counts_it_as_its_sql_does(spark, tmp_path):
    from loomline.plans import oracles, queries
    from tests.compare import compare

    texts = ["heit lich", "lich", "heit sich lich", "heit sich lich"]
    d = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    assert compare(spark, str(tmp_path), queries.topic_contributions, oracles.SQL["topic_contributions"]) == ""
    top = {r.normalized_label: r.top_keywords for r in queries.topic_contributions(spark, str(tmp_path)).collect()}
    assert top["lich"].startswith("Lich|Heit")


def leaves_of(spark, n, episodes):
    return spark.range(n).select(
        F.element_at(F.array(*[F.lit(e) for e in episodes]), (F.col("id") % len(episodes) + 1).cast("int")).alias("episode_id"), F.format_string("n%03d", "id").alias("node_id"), F.lit("leaf_chunk").alias("node_type"), F.lit("leaf").alias("level"),
        F.concat(F.lit("harbour market talk of the town, number "), F.col("id").cast("string"), F.lit(".")).alias("page_content"), F.col("id").cast("double").alias("start_time"), (F.col("id") + 1.0).alias("end_time"),
        F.lit("Ann").alias("speaker"), F.array(F.lit("Ann")).alias("speakers"), F.lit("single").alias("speaker_scope"), F.array(F.col("id").cast("string")).alias("source_segment_ids"),
        F.array(F.struct(F.col("id").alias("a"))).alias("source_spans"), F.lit("s").alias("source"), F.lit("2026-01-02").alias("episode_date"),
    )


def test_the_rows_of_a_group_are_not_copied_for_each_range(spark):
    d = spark.range(30).select(F.lit("e").alias("k"), F.col("id").alias("place"), F.lit(0).alias("part"), F.repeat(F.lit("x"), 7).alias("text"))
    packed = packing.pack(d, ["k"], [F.col("place")], F.length("text"), 28, 2)
    batches = reduction.batches(d, ["k"], 30)
    for out in (packed, batches):
        assert "slice(" not in out._jdf.queryExecution().optimizedPlan().toString()
    rows = packed.orderBy("chunk").collect()
    assert [m.place for m in rows[0].members] == [0, 1, 2, 3] and [m.place for m in rows[1].members] == [2, 3, 4, 5]
    assert all([m.place for m in r.members] == list(range(r["first"] - 1, r["last"])) for r in rows) and rows[-1]["last"] == 30
    assert [r.prompt for r in batches.orderBy("batch").collect()] == ["\n\n".join(["x" * 7] * 3)] * 10


def test_a_group_keeps_the_text_of_its_members_once(spark):
    leaves = hierarchy.assign_groups(leaves_of(spark, 12, ["e"]))
    measured = hierarchy.group_measures(leaves, ["episode_id", "group"], ["start_time", "node_id"])
    assert "page_content" not in measured.schema["members"].simpleString() and "prompt" not in measured.columns
    out = {r.seq: r for r in hierarchy.summarise(leaves.withColumn("page_content", F.when(F.col("group") == 1, "x").otherwise(F.col("page_content"))), 1).collect()}
    assert out[0].page_content.startswith("- Fake summary 1: ") and out[1].page_content.startswith("- Fallback summary") and len(out[1].child_ids) == 6


def test_a_thesis_reads_the_texts_of_leaves_only_where_no_summary_has_a_line(spark):
    leaves = leaves_of(spark, 12, ["a", "b"])
    tops = leaves.where("episode_id = 'a'").withColumn("page_content", F.lit("- one line"))
    out = hierarchy.theses(leaves, tops)
    said = {r.episode_id: r.page_content for r in out.collect()}
    assert said["a"] == hierarchy.HEADING + "- [20260102; Ann] one line"
    assert said["b"].split("\n")[0] == "- Fallback summary: harbour market talk of the town, number 1." and said["b"].count("\n") == 5
    kept = hierarchy.group_measures(leaves, ["episode_id"], ["start_time", "node_id"]).schema["members"].simpleString()
    assert "page_content" not in kept and "rendered" not in kept


def test_one_repeated_key_shuffles_the_words_of_its_rows_only(spark):
    rows = [(i, f"common common word{i:03d}x") for i in range(60)] + [(7, "word007x word007x"), (None, "null row"), (None, "null null")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    out = chunking.topic_tags(d, ["doc_id"])
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString() and "Python" in plan(out) and "BroadcastHashJoin" in plan(out) and "SortMergeJoin" not in plan(out)
    found = {}
    for r in out.orderBy("doc_id", "rank").collect():
        found.setdefault(r.doc_id, []).append((r.tag, r.n))
    assert found == {i: [("common", 2), (f"word{i:03d}x", 1)] for i in range(60)} | {7: [("word007x", 3), ("common", 2)], None: [("null", 3)]}
    half = chunking.topic_tags(d.where("doc_id is null or doc_id = 7"), ["doc_id"])
    assert {(r.doc_id, r.tag, r.n, r.rank) for r in half.collect()} == {(7, "word007x", 3, 1), (7, "common", 2, 2), (None, "null", 3, 1)}


def test_fingerprints_are_made_in_one_pass_of_each_row(spark):
    from loomline.plans import queries

    text = plan(queries.representation_fingerprints(spark, "/root/testdata/sf0.001"))
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1
