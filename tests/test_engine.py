"""Sources, plans, governance and streaming of the engine on small fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from loomline import cli, config
from loomline.functions import arrays, dates, hashing, text
from loomline.operators import corrections, delta, hierarchy, metrics, model, representations, topics, validation
from loomline.plans import jobs, queries, tables
from loomline.sources import caches, judgments, transcripts
from loomline.streaming import jobs as streams


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def write(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")


@pytest.fixture
def talks(tmp_path):
    said = [{"text": f"We should discuss inflation and housing policy part {i}. It matters a lot.", "start": i * 10, "end": i * 10 + 9, "speaker": ["Host", "Guest"][i % 2]} for i in range(120)]
    write(tmp_path / "in/a/Show 2025-03-04_speaker_transcript.json", {"segments": said, "schema_version": "2"})
    write(tmp_path / "in/b_speaker_transcript.json", {"episode_date": "20260101", "items": [{"content": "hello there", "timestamp_start": "1.5", "words": [{"speaker": "SPEAKER_0"}, {"speaker": "Ann"}]}, {"content": " "}]})
    write(tmp_path / "in/c_speaker_transcript.json", {"text": "only the whole text", "metadata": {"date": "2026-02-03"}})
    write(tmp_path / "in/d_speaker_transcript.json", [{"text": "bare list", "start": "bad"}])
    write(tmp_path / "in/e_speaker_transcript.json", "{not json")
    return tmp_path


def test_transcripts(spark, talks):
    files = transcripts.read_files(spark, str(talks / "in"))
    rows = transcripts.segments(files).collect()
    by = {}
    for r in rows:
        by.setdefault(r.source.rsplit("/", 1)[-1][0], []).append(r)
    assert {k: len(v) for k, v in by.items()} == {"S": 120, "b": 1, "c": 1, "d": 1}
    assert (by["b"][0].speaker, by["b"][0].start_time, by["b"][0].episode_date) == ("Ann", 1.5, "2026-01-01")
    assert (by["c"][0].text, by["c"][0].episode_date) == ("only the whole text", "2026-02-03")
    assert by["d"][0].start_time is None and by["S"][0].episode_date == "2025-03-04"
    assert transcripts.schema_versions(files).where("schema_version = '2'").count() == 1


def test_process_and_inspect(spark, talks, capsys):
    nodes = jobs.process_transcripts(spark, str(talks / "in"), str(talks / "out"), config.Config(min_docs_to_cluster=3))
    kinds = {r.node_type: r["count"] for r in nodes.groupBy("node_type").count().collect()}
    assert kinds["leaf_chunk"] > 4 and kinds["episode_thesis"] == 4 and kinds["cluster_summary"] >= 1
    assert nodes.select("node_id").distinct().count() == nodes.count()
    again = jobs.process_transcripts(spark, str(talks / "in"), str(talks / "out2"), config.Config(min_docs_to_cluster=3))
    assert {r.node_id for r in nodes.collect()} == {r.node_id for r in again.collect()}


def test_metrics_of_a_known_run(spark, tmp_path):
    query = {"query_id": "q", "query": "x", "category": "c", "relevance": {"a": 3, "b": 1}, "expected_speakers": ["Host"], "acceptable_node_types": ["leaf_chunk"], "date_range": {"start": "2026-01-01", "end": "2026-01-31"}}
    write(tmp_path / "q.jsonl", "# note\n\n" + json.dumps(query) + "\n" + json.dumps({"query_id": "d", "status": "draft"}))
    meta = {"node_type": "leaf_chunk", "speaker": "Host", "episode_id": "e1", "episode_date": "2026-01-05"}
    results = [{"document_id": "a", "text": "one", "metadata": meta}, {"document_id": "b", "text": "two", "metadata": meta}, *[{"document_id": "c", "text": "same", "metadata": meta | {"speaker": "Guest", "episode_id": "e2", "episode_date": "2025-01-05"}}] * 1, {"document_id": "x", "text": " Same ", "metadata": meta}]
    write(tmp_path / "run.json", {"run_id": "r", "queries": [{"query_id": "q", "latency_seconds": 0.0125, "results": results}]})
    per_query, means = jobs.evaluate(spark, str(tmp_path / "q.jsonl"), str(tmp_path / "run.json"))
    r = per_query.first()
    assert (r.recall_at_5, r.precision_at_5, r.mrr_at_10, r.ndcg_at_10) == (1.0, 0.4, 1.0, 1.0)
    assert (r.speaker_constraint_accuracy_at_10, r.date_constraint_accuracy_at_10, r.node_constraint_accuracy_at_10) == (0.75, 0.75, 1.0)
    assert (r.duplicate_rate_at_10, r.source_diversity_at_10) == (0.25, 0.5)
    assert means.count() == 2 and jobs.markdown(means).startswith("| category")
    assert judgments.read_run(spark, str(tmp_path / "run.json")).first().latency_ms == 12.5


def test_bad_query_sets(spark, tmp_path):
    write(tmp_path / "g.jsonl", json.dumps({"query_id": "q", "relevance": {"a": 4}}))
    write(tmp_path / "t.jsonl", json.dumps({"query_id": "q"}) + "\n" + json.dumps({"query_id": "q"}))
    for name in ("g", "t"):
        with pytest.raises(judgments.QuerySetError):
            judgments.read_queries(spark, str(tmp_path / f"{name}.jsonl"))


def cache(tmp_path, child="leaf"):
    base = {"level": "leaf", "source": "s", "episode_id": "e", "episode_title": "t", "episode_date": "2026-01-01", "source_type": "p", "speaker_scope": "single", "speaker": "Host"}
    docs = [{"page_content": "leaf text", "metadata": base | {"node_id": "leaf", "node_type": "leaf_chunk", "parent_id": "top", "segment_indices": ["0"], "start_time": 0.0, "end_time": 1.0}}]
    docs.append({"page_content": "thesis text", "metadata": base | {"node_id": "top", "node_type": "episode_thesis", "child_ids": [child]}})
    write(tmp_path / "c/x.processed_documents.json", {"schema_version": "2.0", "source_fingerprint": "f", "documents": docs})
    return str(tmp_path / "c")


def test_validation_backfill_export(spark, tmp_path):
    envelopes = caches.read(spark, cache(tmp_path))
    filled = caches.backfill(envelopes)
    nodes = caches.nodes(filled)
    assert validation.violations(nodes).count() == 0 and validation.envelope_violations(caches.envelope_rows(filled)).count() == 0
    assert nodes.where("node_id = 'leaf'").first().source_segment_ids == ["e:segment:0"]
    assert representations.dense_export(caches.envelope_rows(envelopes), caches.nodes(envelopes)).count() == 2
    with pytest.raises(Exception, match="no evidence for leaf"):
        lost = envelopes.withColumn("documents", F.transform("documents", lambda d: d.withField("metadata.segment_indices", F.array().cast("array<string>"))))
        caches.nodes(caches.backfill(lost)).collect()
    bad = caches.nodes(caches.read(spark, cache(tmp_path / "bad", "gone")))
    rules = {r.rule for r in validation.violations(bad).collect()}
    assert {"missing_child", "no_leaf_evidence"} <= rules
    assert cli.main(["inspect", cache(tmp_path / "bad2", "gone")]) == 1


def test_cycles_are_found(spark):
    rows = [("c", "a", "cluster_summary", ["b"]), ("c", "b", "cluster_summary", ["a"]), ("c", "l", "leaf_chunk", []), ("c", "d", "cluster_summary", ["l"])]
    n = spark.createDataFrame(rows, "cache_id string, node_id string, node_type string, child_ids array<string>")
    edge = validation.edges(n)
    assert {r.node_id for r in validation.revisits(edge, n).collect()} == {"a", "b"}
    assert {r.node_id for r in validation.evidence_closure(edge, n).collect()} == {"d"}


def test_delta(spark):
    old = spark.createDataFrame([(1, "a", "p1"), (2, "b", "p1"), (3, "c", "p2")], "doc int, text string, parent string")
    new = spark.createDataFrame([(1, "a", "p1"), (2, "B", "p1"), (4, "d", "p3")], "doc int, text string, parent string")
    status = delta.delta_status(old, new, "doc", ["doc", "text"])
    assert {r.doc: r.status for r in status.collect()} == {1: "unchanged", 2: "changed", 3: "removed", 4: "added"}
    assert {(r.doc, r.text) for r in delta.apply_delta(status, old, new, "doc").collect()} == {(1, "a"), (2, "B"), (4, "d")}
    record = delta.delta_record(status, old, "doc", {"ancestors": "parent"}, corpus="c", corrections="s", processing="p", representation="r")
    assert record["invalidated"]["ancestors"] == ["p1", "p2"]
    delta.check_record(record, "s")
    assert delta.apply_delta(status, old, new, "doc", record, "s").count() == 3
    for lacking in ((status, new.where("doc <> 4"), "s"), (status, new, "other"), (status.where("doc <> 2"), new, "s")):
        with pytest.raises(delta.DeltaError):
            delta.apply_delta(lacking[0], old, lacking[1], "doc", record, lacking[2])
    for broken, approved in (({**record, "added_document_ids": []}, None), (record, "other"), ({**record, "contract_version": "x"}, None)):
        with pytest.raises(delta.DeltaError):
            delta.check_record(broken, approved)


def test_corrections(spark):
    spans = spark.createDataFrame([("s1", "e", "Host", "a"), ("s2", "e", "Host", "b")], "span_id string, episode_id string, speaker string, text string")
    rows = [("s1", "text", "a", "A", None, None), ("s2", "text", "zzz", "B", None, "approved"), ("s2", "speaker", "Host", "Ann", "rejected", None), ("s9", "text", None, "x", None, None)]
    checked = corrections.guard_check(spark.createDataFrame(rows, "span_id string, field string, guard string, after string, status string, adjudication_state string"), spans, ["speaker", "text"])
    assert {(r.span_id, r.ok) for r in checked.collect()} == {("s1", True), ("s2", False), ("s9", False)}
    assert {r.span_id: r.text for r in corrections.apply(spans, checked, ["speaker", "text"], strict=False).collect()} == {"s1": "A", "s2": "b"}
    with pytest.raises(corrections.CorrectionError, match="guard: s2.text"):
        corrections.apply(spans, checked, ["speaker", "text"])
    twice = checked.where("span_id = 's1'").union(checked.where("span_id = 's1'").withColumn("after", F.lit("Z")))
    with pytest.raises(corrections.CorrectionError, match="conflict: s1.text"):
        corrections.apply(spans, twice, ["speaker", "text"])
    assert corrections.apply(spans, checked.where("ok"), ["speaker", "text"]).where("text = 'A'").count() == 1


def test_topics_incremental(spark):
    names = "podcast_id string, podcast_name string, episode_key string, episode_title string, episode_date string, seq int, node_id string, node_type string, topic_tags array<string>, keywords array<string>, claim string, speaker string, page_content string, stable_document_id string"
    rows = [("p", "P", f"e{i}", f"E{i}", f"2026-01-0{i + 1}", 0, f"n{i}", "position_card", ["Federal Reserve"], ["Fed", "policy"], "", "Host", "text", f"d{i}") for i in range(2)]
    rows.append(("p", "P", "e0", "E0", "2026-01-01", 1, "m", "cluster_summary", ["Speaker 02", "Using"], [], "", "", "text", "m"))
    nodes = spark.createDataFrame(rows, names)
    selected = spark.createDataFrame([("e0", "s0"), ("e1", "s1")], "episode_key string, signature string")
    contributed, index = jobs.refresh_topics(None, nodes, selected)
    r = index.where("normalized_label = 'fed'").first()
    assert (r.label, r.topic_kind, r.episode_count, r.representative_episode_title, r.timespan_days) == ("Fed", "policy_theme", 2, "E1", 1)
    assert "Fed policy" in r.query_hints and r.earliest_evidence.node_id == "n0" and r.latest_evidence.node_id == "n1"
    again, index = jobs.refresh_topics(contributed, nodes.limit(0), selected.where("episode_key = 'e1'"))
    assert index.where("normalized_label = 'fed'").first().episode_count == 1
    assert topics.filtered_labels(topics.topic_hits(nodes)).count() == 2


def test_text_functions(spark):
    assert one(spark, text.token_estimate(F.lit("abcd"))) == 2
    assert one(spark, text.clip_text(F.lit("First part, second part; and then more words here"), 30)) == "First part, second part..."
    assert one(spark, text.summary_bullets(F.lit("intro\n- a\n  b\n* c"))) == ["- intro", "- a b", "- c"]
    assert one(spark, text.title_case(F.lit("low-maintenance u.s."))) == "Low-Maintenance U.S."
    assert one(spark, text.token_similarity(F.lit("a b c"), F.lit("A b d"))) == 0.5
    assert one(spark, text.fallback_summary(F.lit("[x | speakers=Ann | time=0-1]\nThis line is long enough to be used."))) == "- Fallback summary | speaker=Ann | time=0-1: This line is long enough to be used."
    assert one(spark, dates.episode_date(F.lit("show 2025_03_04 x"))) == "2025-03-04" and one(spark, dates.clock(F.lit(3725.9))) == "01:02:05"
    assert one(spark, arrays.most_common(F.array(*[F.lit(x) for x in "b a a c b".split()]), 2)) == ["b", "a"]
    assert hashing.canonical_json({"b": None, "a": "é"}) == '{"a":"é","b":null}'


def test_near_duplicates_are_greedy(spark):
    df = spark.createDataFrame([("e", 0, "one two three"), ("e", 1, "One, two three!"), ("e", 2, "other words")], "episode_id string, seq int, text string")
    assert {r.seq: r.duplicate for r in hierarchy.near_duplicates(df, ["episode_id"], "seq", "text").collect()} == {0: False, 1: True, 2: False}


def test_near_duplicates_of_any_length(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for g in range(12):
        base = [f"w{rng.randint(0, 4000)}" for _ in range([900, 60, 15, 3][g % 4])]
        for k in range(4):
            t = " ".join(w if rng.random() > 0.02 * k else f"x{rng.randint(0, 99)}" for w in base)
            rows.append((len(rows), t, "ab"[g % 2], None if g < 4 else len(t)))
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    sets = [set(r[1].split()) for r in rows]
    like = {(i, j): round(len(x & y) / len(x | y), 6) for i, x in enumerate(sets) for j, y in enumerate(sets) if i < j and len(x & y) / len(x | y) >= 0.92}
    assert any(len(rows[i][1]) >= 3000 for i, _ in like) and any(rows[i][3] is None for i, _ in like)
    assert {(r.a, r.b): r.similarity for r in queries.near_dup_pairs(spark, str(tmp_path)).collect()} == like
    kept = []
    for i, r in enumerate(rows):
        if not any((j, i) in like and rows[j][2] == r[2] for j in kept):
            kept.append(i)
    assert {r.doc_id for r in queries.near_dup_greedy(spark, str(tmp_path)).collect()} == set(range(len(rows))) - set(kept)


def test_whole_texts_are_read(spark, tmp_path):
    start = "Same opening words of both texts, which go on for more than sixty characters, "
    spark.createDataFrame([(1, 0, "user", start + "one"), (1, 1, "user", start + "two"), (2, 0, "user", start + "one")], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    said = start + "inflation inflation inflation"
    spark.createDataFrame([(1, said, "en", "a", len(said)), (2, None, "en", "a", None)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert [tuple(r) for r in queries.keep_first_claims(spark, str(tmp_path)).collect()] == [("user", 2)]
    titled = {r.doc_id: (r.title, r.slug) for r in queries.title_cases(spark, str(tmp_path)).collect()}[1]
    assert titled[0].endswith("Inflation Inflation Inflation") and titled[1].endswith("characters-inflation-inflation-inflation")
    tags = {r.node_id: (r.topic_tags, r.page_content) for r in tables.nodes(spark, str(tmp_path)).collect()}
    ranked = queries.topic_tags(spark, str(tmp_path)).where("doc_id = 1").orderBy("rank").collect()
    assert tags["1"][0] == [r.tag for r in ranked] and tags["1"][0][0] == "inflation" and tags["2"][0] == []
    assert queries._positions(spark, str(tmp_path))[1].where("position_id = '1'").first().claim == said


def test_every_hundredth_vector_is_asked(spark, tmp_path):
    rng = random.Random(1)
    v = {i: [rng.gauss(0, 1) for _ in range(4)] for i in [*range(60), *range(100, 1000, 50)]}
    spark.createDataFrame([(i, x, i % 3) for i, x in v.items()], "vec_id long, embedding array<float>, label long").write.parquet(str(tmp_path / "embeddings.parquet"))

    def cosine(x, y):
        return sum(a * b for a, b in zip(x, y, strict=True)) / (sum(a * a for a in x) * sum(b * b for b in y)) ** 0.5

    want = {(q, r, d) for q in range(0, 1000, 100) for r, d in enumerate(sorted((i for i in v if i != q), key=lambda i: -cosine(v[q], v[i]))[:20], 1)}
    results, _ = tables.ranked(spark, str(tmp_path), block=3)
    assert {(r.query_id, r["rank"], r.document_id) for r in results.collect()} == want
    assert {tuple(r) for r in queries.nearest_results(spark, str(tmp_path)).collect()} == want


def test_envelopes_of_all_documents(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(validation, "envelope_violations", lambda c: seen.append(c.count()))
    queries.envelope_violations(spark, "/root/testdata/sf0.001")
    assert seen == [200]


def test_envelopes_match_sql(spark):
    from loomline.plans.oracles import SQL
    from tests.compare import compare

    assert compare(spark, "/root/testdata/sf0.001", queries.envelope_violations, SQL["envelope_violations"]) == ""


def test_model_salvage(spark):
    assert model.salvage_json('```json\n{"a": 1}\n```') == {"a": 1} and model.salvage_json("no") is None
    cut = '{"positions": [{"claim": "x", "keywords": ["k"]}, {"claim": "y"}, {"cla'
    assert [p["claim"] for p in model.positions_of(cut)] == ["x", "y"]
    assert one(spark, model.parse_positions(F.lit('[{"claim": "c", "speaker": null, "keywords": "k"}]')))[0].keywords == ["k"]
    calls = model.call_model(spark.createDataFrame([("1", "p")], "request_id string, prompt string"), lambda prompt: prompt.upper(), tasks=2)
    assert calls.first().answer == "P"


def test_config(tmp_path):
    write(tmp_path / "c.json", {"leaf_chunk_size": 900, "unknown": 1})
    c = config.load(str(tmp_path / "c.json"), {"LM_STUDIO_MODEL": "m"})
    assert (c.leaf_chunk_size, c.model_name) == (900, "m")
    assert c.generation_fingerprint() == config.load(str(tmp_path / "c.json"), {"LM_STUDIO_MODEL": "m"}).generation_fingerprint() != config.Config().generation_fingerprint()
    write(tmp_path / "bad.json", '{\n"a": }')
    with pytest.raises(config.ConfigError, match="line 2"):
        config.load(str(tmp_path / "bad.json"))
    assert config.doctor(config.Config(leaf_chunk_size=9000)) and not config.doctor(config.Config())


def test_streams(spark, talks):
    seen = []
    stream = streams.new_transcripts(spark, str(talks / "in"))
    for _ in range(2):
        streams.run_available(stream, lambda batch, n: seen.append(batch.count()), str(talks / "check")).awaitTermination()
    assert sum(seen) == 5
    events = spark.createDataFrame([(i, f"2024-01-01 00:{i:02d}:00", "a", 1.0, 7) for i in range(30)], "event_id int, ts string, event_type string, value double, user_id int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    events.write.parquet(str(talks / "events"))
    live = spark.readStream.schema(events.schema).parquet(str(talks / "events"))
    q = streams.sliding_telemetry(live).writeStream.format("memory").queryName("rolled").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT max(n) FROM rolled").first()[0] == 5


def test_upsert_survives_a_crash(spark, tmp_path):
    path = str(tmp_path / "table")
    each = streams.upsert(path, ["k"])

    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "k int, v string")

    def there():
        return {(r.k, r.v) for r in streams.current(spark, path).collect()}

    assert streams.current(spark, path) is None
    each(rows((1, "a"), (2, "b")), 0)
    rows((3, "half")).write.parquet(f"{path}/v1")
    (tmp_path / "table/v1/_SUCCESS").unlink()  # a write that was never committed
    assert there() == {(1, "a"), (2, "b")}
    for _ in range(2):  # the batch is done again, also after its write
        each(rows((2, "B"), (3, "c")), 1)
        assert there() == {(1, "a"), (2, "B"), (3, "c")}


def test_topic_orders(spark):
    c = spark.createDataFrame([("p", "e", 2.0, 1, "b", "b"), ("p", "e", 3.0, 1, "c", "c"), ("p", "e", 2.0, 2, "d", "d"), ("p", "e", 2.0, 1, "A", "a")], "podcast_id string, episode_key string, score double, document_count int, label string, normalized_label string")
    assert [r.label for r in topics.contributions_in_order(c).collect()] == ["c", "d", "A", "b"]


def test_entry_and_oracles():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 70


ORACLES = ["leaf_chunks", "topic_tags", "topic_contributions", "topic_depth", "retrieval_metrics", "evidence_closure", "position_quarantine", "rolling_300s", "required_fields", "context_headers", "topic_index", "representation_fingerprints", "summary_bullets"]


@pytest.mark.parametrize("name", ORACLES)
def test_queries_match_sql(spark, name):
    from loomline.plans.oracles import SQL
    from loomline.plans.queries import QUERIES
    from tests.compare import compare

    assert compare(spark, "/root/testdata/sf0.001", QUERIES[name], SQL[name]) == ""


def test_required_fields_of_odd_rows_match_sql(spark, tmp_path):
    """Repeated ids, empty texts, texts that ask for their input, and nulls: none of them is a rule of the SQL."""
    from loomline.plans.oracles import SQL
    from loomline.plans.queries import QUERIES
    from tests.compare import compare

    rows = [(i, "en" if i % 3 else "fr", "a", "some text") for i in range(40)]
    rows += [(7, "en", "a", "again"), (7, "en", "a", "again"), (8, "en", "b", "  "), (9, "en", "b", None), (10, "en", "b", "Please provide the transcript."), (None, "en", "a", "x"), (12, None, "c", "x"), (13, "", "d", "x"), (14, "en", "", "x"), (15, "en", None, "x"), (-18, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert compare(spark, str(tmp_path), QUERIES["required_fields"], SQL["required_fields"]) == ""
