"""Evidence closure and the roll-up against plain loops."""

from loomline.operators import topics, validation


def test_closure_of_any_depth_and_of_cycles(spark):
    children = {f"a{i}": [f"a{i + 1}"] for i in range(12)} | {"a12": ["leaf1", "leaf2"]}
    children |= {"top": ["a3", "b0", "gone"], "b0": ["b1"], "b1": ["b0", "leaf2", "leaf3"], "lost": ["c"], "c": ["lost"], "self": ["self"], "leaf1": [], "leaf2": [], "leaf3": []}
    children["twice"] = ["leaf1", "leaf1", "b1"]
    rows = [(cache, n, "leaf_chunk" if n.startswith("leaf") else "cluster_summary", c) for cache in ("x", "y") for n, c in children.items()]
    nodes = spark.createDataFrame(rows, "cache_id string, node_id string, node_type string, child_ids array<string>")
    got = {(r.cache_id, r.node_id): r.leaves for r in validation.evidence_closure(validation.edges(nodes), nodes).collect()}

    def leaves(start):
        seen, todo = set(), list(children[start])
        while todo:
            n = todo.pop()
            if n in children and n not in seen:
                seen.add(n)
                todo += children[n]
        return sum(n.startswith("leaf") for n in seen)

    expected = {n: leaves(n) for n in children if not n.startswith("leaf")}
    assert got == {(cache, n): k for cache in ("x", "y") for n, k in expected.items() if k}
    assert got["x", "a0"] == 2 and got["x", "top"] == 3 and ("x", "lost") not in got


def test_closure_of_nothing(spark):
    nodes = spark.createDataFrame([], "cache_id string, node_id string, node_type string, child_ids array<string>")
    assert validation.evidence_closure(validation.edges(nodes), nodes).count() == 0


def test_rollup_counts_labels_that_pass(spark):
    rows = [("p", "P", "e1", "housing policy"), ("p", "P", "e2", "housing policy"), ("p", "P", "e2", "market ledger"), ("q", "Q", "e1", "market ledger"), ("r", "R", "e9", "unknown")]
    c = spark.createDataFrame(rows, "podcast_id string, podcast_name string, episode_key string, normalized_label string")
    black = spark.createDataFrame([("market ledger",)], "normalized_label string")
    counts = {r.podcast_id: (r.episode_count, r.topic_count) for r in topics.podcast_rollup(c, topics.curated(c)).collect()}
    assert counts["p"] == (2, 2) and counts["q"] == (1, 1) and counts["r"][0] == 1
    without = {r.podcast_id: r.topic_count for r in topics.podcast_rollup(c, topics.curated(c, black)).collect()}
    assert without["p"] == 1 and without["q"] == 0
    white = {r.podcast_id: r.topic_count for r in topics.podcast_rollup(c, topics.curated(c, black, black)).collect()}
    assert white["q"] == 1
