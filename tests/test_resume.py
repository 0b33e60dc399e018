"""Batches that resume and topic indexes that are brought up to date."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from loomline import config
from loomline.operators import topics
from loomline.plans import batch, jobs, topic_refresh

CONFIG = config.Config(min_docs_to_cluster=3)


@pytest.fixture
def talks(tmp_path):
    for name, parts in (("a", 12), ("b", 3), ("c", 5)):
        said = [{"text": f"{name}: We should discuss inflation and housing policy part {i}. It matters a lot.", "start": i * 10, "end": i * 10 + 9, "speaker": ["Host", "Guest"][i % 2]} for i in range(parts)]
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/{name} 2025-03-04_speaker_transcript.json").write_text(json.dumps({"segments": said}))
    return tmp_path


def ids(df):
    return sorted(r.node_id for r in df.select("node_id").collect())


def test_resumes_after_the_last_finished_stage(spark, talks, monkeypatch):
    src, out = str(talks / "in"), str(talks / "out")
    whole = ids(jobs.process_transcripts(spark, src, str(talks / "plain"), CONFIG))

    def killed(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(jobs, "position_stage", killed)
        with pytest.raises(RuntimeError, match="executor lost"):
            batch.process(spark, src, out, CONFIG)
    assert [r.status for r in batch.read_state(spark, out).collect()] == ["failed"] * 3
    with monkeypatch.context() as m:  # neither transcripts nor leaves are read again
        for name in ("leaf_stage", "tree_stage"):
            m.setattr(jobs, name, killed)
        m.setattr(batch, "read_batch", killed)
        assert batch.process(spark, src, out, CONFIG) == {"found": 3, "skipped": 0, "completed": 3, "quarantined": 0}
    assert ids(batch.current_nodes(spark, out)) == whole
    assert not os.path.exists(talks / "out/stages")
    assert batch.process(spark, src, out, CONFIG) == {"found": 3, "skipped": 3, "completed": 0, "quarantined": 0}


def test_takes_changed_files_only_and_sets_bad_state_aside(spark, talks):
    src, out = str(talks / "in"), str(talks / "out")
    assert batch.process(spark, src, out, CONFIG, limit=2)["completed"] == 2
    assert batch.process(spark, src, out, CONFIG)["completed"] == 1
    before = set(ids(batch.current_nodes(spark, out)))
    path = talks / "in/b 2025-03-04_speaker_transcript.json"
    path.write_text(json.dumps({"segments": [{"text": "Quite another text about rivers and bridges.", "speaker": "Ann", "start": 0, "end": 5}]}))
    os.utime(path, (time.time() + 5, time.time() + 5))
    (talks / "out/state/part-bad.json").write_text('{"source": "x", "finger\nnot json\n')
    assert batch.process(spark, src, out, CONFIG, one_file="c 2025-03-04_speaker_transcript.json") == {"found": 1, "skipped": 1, "completed": 0, "quarantined": 0}
    assert batch.process(spark, src, out, CONFIG)["completed"] == 1
    after = set(ids(batch.current_nodes(spark, out)))
    assert before & after and before - after and after - before
    assert {r.value for r in spark.read.text(f"{out}/state_set_aside").collect()} == {"not json", '{"source": "x", "finger'}
    # other settings make all anew
    other = config.Config(min_docs_to_cluster=3, leaf_chunk_size=900).generation_fingerprint()
    assert batch.pending_files(batch.list_files(spark, src), batch.read_state(spark, out), other).count() == 3


NODES = "podcast_id string, podcast_name string, episode_key string, episode_title string, episode_date string, seq int, node_id string, node_type string, topic_tags array<string>, keywords array<string>, claim string, speaker string, page_content string, stable_document_id string"


def node(episode, seq, tags):
    return ("p", "P", episode, episode.upper(), "2026-01-01", seq, f"{episode}-{seq}", "position_card", tags, [], "", "Host", "some text", f"d{episode}{seq}")


def test_refresh_reuses_unchanged_episodes(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "topics")
    nodes = spark.createDataFrame([node("e0", 0, ["Federal Reserve", "Speaker 02"]), node("e1", 0, ["Ukraine War"])], NODES)
    chosen = [("p", "e0", "s0"), ("p", "e1", "s1")]

    def run(nodes, chosen, **more):
        return topic_refresh.refresh(spark, nodes, spark.createDataFrame(chosen, "podcast_id string, episode_key string, signature string"), out, **more)

    def labels():
        return sorted(r.normalized_label for r in topic_refresh.table(spark, out, "index").collect())

    assert run(nodes, chosen[:1]) == {"rebuilt": 1, "reused": 0, "removed": 0, "topics": 1, "podcasts": 1}
    assert run(nodes.limit(0), chosen[:1]) == {"rebuilt": 0, "reused": 1, "removed": 0, "topics": 1, "podcasts": 1}
    assert run(nodes, chosen) == {"rebuilt": 1, "reused": 1, "removed": 0, "topics": 2, "podcasts": 1} and labels() == ["fed", "ukraine war"]
    assert topic_refresh.table(spark, out, "report").first().n == 1
    # one changed, one gone
    changed = spark.createDataFrame([node("e1", 0, ["Housing Policy"])], NODES)
    assert run(changed, [("p", "e1", "s2")]) == {"rebuilt": 1, "reused": 0, "removed": 1, "topics": 1, "podcasts": 1} and labels() == ["housing policy"]
    assert topic_refresh.table(spark, out, "report").count() == 0 and topic_refresh.table(spark, out, "manifest").count() == 1
    # other rules make all anew, and so does a crash before the manifest
    with monkeypatch.context() as m:
        m.setattr(topics, "topic_index", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(nodes, chosen, logic="topics-2")
    assert labels() == ["housing policy"]
    black = spark.createDataFrame([("fed",)], "normalized_label string")
    assert run(nodes, chosen, logic="topics-2", blacklist=black) == {"rebuilt": 2, "reused": 0, "removed": 0, "topics": 1, "podcasts": 1} and labels() == ["ukraine war"]
    assert spark.read.parquet(f"{out}/contributions").where(F.col("episode_key") == "e0").count() == 1
