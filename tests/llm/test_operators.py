"""Operators on small tables, against brute force, with nulls, ties, repeats, long texts and clashing columns."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomline.llm import chat, decontaminate, exact_dedup, jaccard, line_dedup, mixing, packing, quality, queries, secrets, suffix_dedup
from loomline.llm.common import Scratch

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, repeats, one long text, an id that stands twice."""
    words = [random.Random(i).choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(i % 97) for i in range(30_000)]
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \n ", "en", "a", 4), (4, "one", "en", None, 3), (5, "ONE", "en", "b", 3), (5, "two words\nTwo lines of text here", "en", "b", 9)]
    rows += [(6, " ".join(words), "en", "b", 0), (7, " ".join(words), "en", "c", 0), (8, " ".join(words[:400] + ["new"] + words[400:20_000]), "fr", "c", 0), (None, "no id at all", "en", "a", 1), (9, "x" * 50_000, "en", "a", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def clash(spark):
    """Columns with the names of outputs and of inner columns."""
    names = "doc_id long, text string, source string, item_id long, n_words long, kept boolean, size long, row string, c1 string, key string, mix_shard string, quality_score string, spans string, place int"
    return spark.createDataFrame([(1, "a b c", "s", 1, 1, True, 1, "r", "c", "k", "m", "q", "s", 0), (2, "d e f", "t", 1, 1, True, 1, "r", "c", "k", "m", "q", "s", 0)], names)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


OPERATORS = {
    "decontaminate": lambda d, b: decontaminate.contamination(d, b),
    "pack": lambda d, b: packing.pack(d, seq_len=128),
    "quality": lambda d, b: quality.classify(d),
    "mixture": lambda d, b: mixing.mixture(d),
    "exact": lambda d, b: exact_dedup.exact_groups(d),
    "suffix": lambda d, b: suffix_dedup.repeated_passages(d),
    "lines": lambda d, b: line_dedup.line_report(d),
    "jaccard": lambda d, b: jaccard.jaccard_components(d),
    "secrets": lambda d, b: secrets.scan_secrets(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_clashing_and_empty_tables(spark, odd, clash, name):
    items = spark.createDataFrame([(1, "one"), (None, "two words"), (3, None), (4, "")], "item_id long, text string")
    per_row = name not in ("pack", "lines")
    n = OPERATORS[name](odd, items).count()
    assert n == odd.count() if per_row else n > 0
    assert OPERATORS[name](clash, items).count() == (2 if per_row else OPERATORS[name](clash, items).count())
    assert OPERATORS[name](odd.limit(0), items).count() == 0
    assert OPERATORS[name](odd, items.limit(0)).count() == n


def test_filters_pass_all_columns_through(spark, odd, clash):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    kept = decontaminate.drop_contaminated(clash, items)
    assert kept.columns == clash.columns and [r.doc_id for r in kept.collect()] == [2]
    assert quality.keep_good(clash).count() == 2 and mixing.mix(clash).count() >= 1 and jaccard.keep_one(clash).count() == 2
    assert {r.doc_id for r in jaccard.keep_one(odd).collect()} >= {1, 2, 3, 4, 6, None}


#: Names that the plans of the stages use themselves.
INNER = (
    "row row_id row_text id gone node component key check n c1 c2 part counts signature text_id out0 in0 mix_source mix_size mix_slot mix_key mix_shard mix_order mix_copy mix_shards plan_source plan_slot "
    "source_size target full_shards last_shard last_key pick_key position block quality_score quality_posterior loomline_hit spans items kept size component_id weights run digest"
).split()


def test_no_name_clashes_in_the_pipeline(spark):
    said = "The committee met on Tuesday and talked at length about the new harbour, which {} people had asked for since the flood of {}."
    rows = [(i, said.format("many few some most all no other old young good".split()[i], 1900 + i) * (i + 1), "en", f"s{i % 2}", 0, *[f"{c}-{i}" for c in INNER]) for i in range(10)]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", {c} string" for c in INNER))
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, kept, SF)
        found = out.collect()
        assert out.columns == docs.columns and found
        assert all(r[c] == f"{c}-{r.doc_id}" for r in found for c in INNER)
        kept = spark.createDataFrame(found, docs.schema)
    assert corpus_pipeline.STAGES[4][1](spark, kept, SF).count() >= 1


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, odd.limit(0), SF).count() == 0
    stage(spark, odd, SF).count()


def test_query_blocks_merge(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    one = decontaminate.contamination(docs, bench).orderBy("doc_id").collect()
    many = decontaminate.contamination(docs, bench, max_query_words=300).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_words, r.n_hit, r["items"], r.near_items) for r in one] == [(r.doc_id, r.n_words, r.n_hit, r["items"], r.near_items) for r in many]
    assert sum(r.n_hit > 0 for r in one) > 0
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert kept == {r.doc_id for r in one if not r.n_hit}


def near_by_definition(words, window, slack):
    """Whether some start has each word of the window within slack of its place."""
    return any(all(x in words[max(0, s + o - slack) : max(0, s + o + slack + 1)] for o, x in enumerate(window)) for s in range(-slack, len(words) + slack))


def test_long_runs_are_encoded_as_one_would(spark):
    """Cutting before and inside runs of white space changes no token, and no run is too long."""
    ranks = packing.load_ranks(packing.DEFAULT_VOCABULARY)
    plain, rng = packing.Encoder(ranks).split.encode_ordinary, random.Random(3)
    pieces = ["a", "word", "'s", "12", "=", "é", " ", " ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\x85", "  ", "\n\n"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(1, 30))) for _ in range(3000)]
    for longest in (2, 3, 5):
        encode = packing.Encoder(ranks, longest)
        assert all(encode(t) == plain(t) for t in texts)
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "\n" * 2_000_000 + "end"), (3, "a" + " \t" * 1_000_000 + "b"), (4, "x" * 1_000_000), (5, "=" * 1_000_000)], "doc_id long, text string")
    ids = {r.doc_id: r.text for r in docs.collect()}
    found = collections.defaultdict(list)
    for r in packing.pack(docs).collect():
        tokens = [int.from_bytes(r.input_ids[2 * i : 2 * i + 2], "little") for i in range(len(r.input_ids) // 2)]
        for d, at, a, b in zip(r.doc_ids, r.piece_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            found[d].append((at, tokens[a:b]))
    decode = packing.encoder(ranks).decode
    assert {d: decode([t for _, x in sorted(v) for t in x][:-1]) for d, v in found.items()} == ids


def test_near_matches_are_returned(spark, tmp_path):
    said = [f"w{i}" for i in range(10)]
    texts = [(1, " ".join(said)), (2, " ".join([*said[:5], "put", "in", *said[5:]])), (3, "none of these")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, " ".join(said))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: (r.n_near_items, r.near_items, r.spans) for r in queries.QUERIES["op1_decontaminate"](spark, str(tmp_path)).collect()}
    assert got == {1: (1, "7", "0:10"), 2: (1, "7", ""), 3: (0, "", "")}


@pytest.mark.parametrize("block_words", [10_000_000, 300, 1])
def test_near_matches_do_not_know_their_block(spark, monkeypatch, block_words):
    build = decontaminate.build_index
    monkeypatch.setattr(decontaminate, "build_index", lambda d, i, t: build(d, i, t, block_words))
    rng = random.Random(9)
    items = [(k, [f"t{rng.randrange(12)}" for _ in range(rng.choice([3, 6, 12]))]) for k in range(6)]
    texts = []
    for i in range(60):
        w = [f"t{rng.randrange(14)}" for _ in range(rng.randrange(4))] + list(rng.choice(items)[1])
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = [f"t{rng.randrange(14)}" for _ in range(rng.randrange(2))]
            w = w or ["t1"]
        texts.append((i, w))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {r.doc_id: set(r.near_items) for r in decontaminate.contamination(docs, bench, window=6).collect()}
    windows = {k: [w[j : j + 6] for j in range(max(1, len(w) - 5))] for k, w in items}
    want = {i: {str(k) for k, ws in windows.items() if any(near_by_definition(w, x, 2) for x in ws)} for i, w in texts}
    assert got == want and any(want.values())


def test_index_serves_any_items(spark, docs):
    index = decontaminate.build_index(docs, block_words=5000)
    text = docs.where("length(text) > 200").first()
    words = decontaminate.ascii_lower_words(text.text)
    found = decontaminate.search_index(index, decontaminate.QuerySet([("x", words[:12])], 10), 0).where("n_hit >= 12").collect()
    assert text.doc_id in {r.doc_id for r in found}


def test_runs_are_sorted_and_merged(spark, docs):
    import numpy as np

    scanned = exact_dedup.scan(docs.repartition(5), 8, "min").where("range is not null").select("range", "run", "records")
    before, after = (x.collect() for x in (scanned, exact_dedup.merge_round(exact_dedup.merge_round(scanned, 4, "min", 4), 4, "min", 4)))
    for r in [*before, *after]:
        digests = np.frombuffer(bytes(r.records), exact_dedup.RECORD)["digest"]
        assert (digests[1:] > digests[:-1]).all() and set(exact_dedup._ranges(digests, 8)) == {r.range}
    assert len({(r.range, r.run) for r in after}) == len(after) == len({r.range for r in before}) and {r.run for r in after} == {0}


def test_packing_is_lossless(docs):
    packed = packing.pack(docs, seq_len=256).collect()
    pieces = collections.defaultdict(dict)
    import numpy as np

    for r in packed:
        ids = np.frombuffer(r.input_ids, "<u2")
        assert len(ids) == 256 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        for d, s, a, b in zip(r.doc_ids, r.piece_starts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            pieces[d][s] = ids[a:b]
    decode = packing.encoder(packing.load_ranks(packing.DEFAULT_VOCABULARY)).decode
    for d in docs.collect():
        tokens = np.concatenate([pieces[d.doc_id][s] for s in sorted(pieces[d.doc_id])])
        assert tokens[-1] == 50256 and decode(tokens[:-1].tolist()) == d.text


def test_quality_agrees_with_held_out_labels(spark):
    found = quality.classify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    both = found.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    right = both.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0]
    wrongly_gone = both.where("quality = 1 and not kept").count()
    assert right > 0.97 and wrongly_gone <= 2


def test_mixture_meets_targets(docs):
    rows = mixing.mixture(docs, shards=4).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        s = source[r.doc_id]
        sizes[s] += r["size"]
        taken[s] += r.taken
        target[s] = r.target
        assert r.taken == r["size"] * len(r.shards) <= 2 * r["size"] and all(0 <= x < 4 for x in r.shards)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    want, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        for s in over or free:
            want[s] = 2.0 * sizes[s] if over else share[s]
        left -= sum(want[s] for s in over)
        free = free - over if over else set()
    largest = {s: max(r["size"] for r in rows if source[r.doc_id] == s) for s in sizes}
    for s in sizes:
        assert abs(want[s] - target[s]) < 1e-6 * want[s] and abs(taken[s] - want[s]) <= largest[s] / 2 + 1
    again = {(r.doc_id, tuple(r.shards)) for r in mixing.mixture(docs, shards=4).collect()}
    assert again == {(r.doc_id, tuple(r.shards)) for r in rows}


def test_mix_is_placed_and_shuffled(spark, docs, tmp_path):
    mixed = mixing.mix(docs, shards=4)
    want = sorted((r.mix_shard, r.mix_order, r.doc_id) for r in mixed.select("mix_shard", "mix_order", "doc_id").collect())
    assert want == sorted((s, o, r.doc_id) for r in mixing.mixture(docs, shards=4).collect() for s, o in zip(r.shards, r.orders, strict=True))
    mixing.write_mix(mixed, str(tmp_path / "mix"), files=3)
    files = collections.defaultdict(list)
    for r in spark.read.parquet(str(tmp_path / "mix")).select(F.input_file_name().alias("f"), "mix_shard", "mix_order", "doc_id").collect():
        files[r.f].append((r.mix_shard, r.mix_order, r.doc_id))
    assert sorted(x for rows in files.values() for x in rows) == want and all(rows == sorted(rows) for rows in files.values())
    placed = mixing.shuffled(mixing.mix(docs)).select("doc_id", "mix_shard", "mix_order").rdd.glom().collect()
    assert all([r[1:] for r in part] == sorted(r[1:] for r in part) for part in placed)
    assert [[r.doc_id for r in part] for part in corpus_pipeline.mixing_stage(spark, docs, SF).select("doc_id").rdd.glom().collect()] == [[r.doc_id for r in part] for part in placed]


def test_splitting_tree_adds_up(spark):
    counts = spark.createDataFrame([([40, 0, 7, 1000],)], "counts array<long>")
    rows = mixing.shard_quotas(counts, 8, 1).collect()
    by_source, by_shard = collections.Counter(), collections.Counter()
    for r in rows:
        assert r.quota >= 0
        by_source[r.position] += r.quota
        by_shard[r.shard] += r.quota
    assert [by_source[i] for i in range(4)] == [40, 0, 7, 1000] and max(by_shard.values()) - min(by_shard.values()) <= 3


def test_exact_groups_match_brute_force(spark):
    texts = ["a", "A", "b", None, "", "É", "é", "a"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    groups = collections.defaultdict(list)
    low = "".join(map(chr, range(97, 123)))
    for i, t in enumerate(texts):
        groups[(t or "").translate(str.maketrans(low.upper(), low))].append(i)
    for r in exact_dedup.exact_groups(docs, keep="max", fan_in=2).collect():
        t = (texts[r.doc_id] or "").translate(str.maketrans(low.upper(), low))
        assert (r.keep_id, r.group_size, r.kept, bytes(r.digest)) == (max(groups[t]), len(groups[t]), r.doc_id == max(groups[t]), hashlib.sha256(t.encode()).digest())


def test_repeated_passages_match_brute_force(docs):
    least = 30
    found = {r.doc_id: r for r in suffix_dedup.repeated_passages(docs, least=least, gap=10, k=6).collect()}
    words = {r.doc_id: (r.text or "").encode().lower().split() for r in docs.collect()}
    count = collections.Counter(tuple(w[i : i + least]) for w in words.values() for i in range(len(w) - least + 1))
    left = collections.Counter()
    for d, w in words.items():
        want = {p for i in range(len(w) - least + 1) if count[tuple(w[i : i + least])] > 1 for p in range(i, i + least)}
        assert want == {p for s in found[d].repeated for p in range(s["start"], s["end"])}
        cut = {p for s in found[d].cut for p in range(s["start"], s["end"])}
        assert cut <= want and found[d].n_cut == len(cut)
        for i in range(len(w) - least + 1):
            if count[tuple(w[i : i + least])] > 1 and not cut >= set(range(i, i + least)):
                left[tuple(w[i : i + least])] += 1
    assert all(left[k] >= 1 for k, n in count.items() if n > 1)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def line_classes(lines, threshold):
    """Least line that each line is connected with, by brute force."""
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(lines):
        for j in range(i):
            if threshold >= abs(len(x) - len(lines[j])) and edits(x, lines[j]) <= threshold:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(lines))]


def changed(rng, base, most, put):
    c = list(base)
    for _ in range(rng.randint(1, most)):
        i = rng.randrange(len(c))
        c[i : i + rng.randint(0, 1)] = rng.choice(put)
    return "".join(c)


@pytest.mark.parametrize("threshold", [1, 2])
def test_line_verdicts_match_brute_force(spark, threshold):
    rng = random.Random(threshold)
    pairs = []
    for _ in range(400):
        base = "".join(rng.choice("abc é") for _ in range(rng.randint(4, 40)))
        pairs.append((base, changed(rng, base, 4, ["", "x", "ab", "é"])))
    pairs += [("abc", "abcde"), ("aaaa", "aaa"), ("abcabc", "abc"), ("ab", "")]
    got = spark.createDataFrame(pairs, "x string, y string").selectExpr("x", "y", line_dedup.texts_within("x", "y", threshold) + " as near").collect()
    assert [r.near for r in got] == [edits(x, y) <= threshold for x, y in pairs] and {r.near for r in got} == {True, False}


def test_line_classes_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    threshold, rng = 2, random.Random(2)
    lines = {"Read more >", "Read more >>", "twenty characters on", "twenty characters o", "ab", "a", "b"}
    lines |= {"".join(rng.choice("abcdefgh é") for _ in range(rng.randint(1, 9))) for _ in range(80)}
    for _ in range(20):
        base = [rng.choice("abc é") for _ in range(rng.randint(20, 28))]
        lines |= {"".join(base), *(changed(rng, base, 3, ["", "x", "ab"]) for _ in range(5))}
    common = "a start that many lines share, word for word "  # a hot segment of lines that differ at their ends, and some that don't
    lines |= {common + "".join(rng.choice("abcdefghij") for _ in range(22)) for _ in range(60)} | {common + "the same end" + c for c in "abcdef"}
    lines = sorted(lines)
    docs = spark.createDataFrame([(i, x, 0) for i, x in enumerate(lines)], "doc_id long, text string, component int")
    got = {r.doc_id: r for r in line_dedup.near_lines(docs, threshold).collect()}
    classes = line_classes(lines, threshold)
    assert {i: r.class_doc for i, r in got.items()} == dict(enumerate(classes))
    assert {i: r.dropped for i, r in got.items()} == {i: i != c and edits(lines[i], lines[c]) <= threshold for i, c in enumerate(classes)}
    assert len(set(classes)) < len(lines)


def test_large_groups_of_near_lines(spark):
    """Hundreds of texts near one: one class, and comparisons in proportion to their number."""
    base = "a line that stands on very many pages, each time with another number at its end: "
    lines = [f"{base}{a}{b}" for a in "0123456789abcdef" for b in "0123456789abcdefghijklmnopqrst"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    texts = docs.selectExpr("doc_id as id", "text as line")
    scratch = Scratch(spark, "test")
    asked, classes = line_dedup.linked_texts(texts, 2, scratch)
    assert asked.count() == len(lines) and classes.where("component = 0").count() == len(lines) - 1
    assert spark.read.parquet(scratch.path("stars")).count() <= 12 * len(lines)
    assert spark.read.parquet(scratch.path("apart")).count() == 0


def test_short_lines_are_linked(spark):
    """All lines of one or two characters are one class, and longer ones are of it by what is left of them."""
    rng = random.Random(11)
    lines = sorted({"".join(rng.choice("abcdé") for _ in range(rng.choice([1, 2, 3, 3, 4, 4, 5, 6]))) for _ in range(60)} | {"xyz", "wxyz", "zzzz", "qaq", "qqab"})
    for kept in (lines, [x for x in lines if len(x) > 2 or x in ("ab", "d")]):
        docs = spark.createDataFrame(list(enumerate(kept)), "doc_id long, text string")
        got = {r.doc_id: r.class_doc for r in line_dedup.near_lines(docs, 2).collect()}
        assert got == dict(enumerate(line_classes(kept, 2)))


def test_patterns_decide_for_short_lines():
    rng = random.Random(12)
    for threshold in (1, 2, 3):
        texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 2 * threshold))) for _ in range(150)]

        def keys(x, short):
            return {name + "".join("\n" if p < 0 else x[p] for p in places) for length, places, name in line_dedup.short_patterns(threshold, short) if length == len(x)}

        for x in {t for t in texts if len(t) <= threshold}:
            for y in {t for t in texts if len(t) > threshold}:
                assert (not keys(x, True).isdisjoint(keys(y, False))) == (edits(x, y) <= threshold), (x, y)


def test_line_report_counts(spark):
    a, b = "this is a line of some length", "this is a line of sum length"
    docs = spark.createDataFrame([(2, f"{a}\nshort\n{a}"), (1, f"{b}\nshort"), (3, None), (-5, f"x\n{a}"), (None, "nowhere else")], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_repeat, r.n_near, r.n_dropped, r.chars_kept) for r in line_dedup.line_report(docs).collect()}
    assert got == {None: (1, 0, 0, 0, 12), -5: (2, 0, 0, 0, 30), 1: (2, 0, 1, 1, 5), 2: (3, 3, 0, 3, 0)}


def test_lines_show_classes_and_drop(spark):
    a, b, c = "one line of text here", "one line of text her3", "one line of text her345"  # a-b and b-c are within 2 edits, a-c isn't
    docs = spark.createDataFrame([(1, f"{a}\n\nother words", "x"), (2, f"{b}\n{c}\n{a}", "y"), (3, None, "z"), (4, "", "w")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in line_dedup.line_report(docs, every=True).collect()}
    assert set(got) == {1, 2, 3, 4} and got[3].n_lines == got[3].n_near == got[3].chars_kept == 0
    assert [tuple(x) for x in got[2].classes] == [(0, 2, 0, 1, 0), (1, 2, 1, 1, 0), (2, 1, 0, 1, 0)] and not got[1].classes
    kept = {r.doc_id: (r.text, r.source) for r in line_dedup.drop_lines(docs).collect()}
    assert kept == {1: (f"{a}\n\nother words", "x"), 2: (c, "y"), 3: (None, "z"), 4: ("", "w")}


def test_components_match_brute_force(spark):
    rng = random.Random(11)
    texts = []
    for g in range(12):
        base = [f"w{rng.randint(0, 30)}" for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(1, 9)):
            c = list(base)
            for _ in range(rng.randint(0, 2)):
                c[rng.randrange(len(c))] = f"x{rng.randint(0, 99)}"
            texts.append(" ".join(c))
    texts += [None, "", "only four words here", "Only four words HERE", "only four words there"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for _ in root:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    root[i] = root[j] = min(root[i], root[j])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert got == {i: (len(s), r) for i, (s, r) in enumerate(zip(sets, root, strict=True))}


def test_chat_handles_null_rows(spark):
    log = spark.createDataFrame([(None, None, None, None), (1, 0, "user", None), (1, None, None, "x"), (1, 0, "user", None)], "conv_id long, seq long, role string, text string")
    out = {r.conv_id: r.n_turns for r in chat.read_back(chat.format_conversations(log)).collect()}
    assert out == {None: 1, 1: 3}
    assert chat.format_conversations(log.limit(0)).count() == 0


def test_pipeline_stages(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "benchmark", "mixing", "packing"]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns
        kept = spark.createDataFrame(out.collect(), docs.schema)
    ids = [r.doc_id for r in kept.collect()]
    assert len(set(ids)) == len(ids) and 0 < len(ids) < docs.count()
    mixed = corpus_pipeline.STAGES[3][1](spark, kept, SF)
    assert mixed.columns == docs.columns and max(collections.Counter(r.doc_id for r in mixed.collect()).values()) <= 2
    packed = corpus_pipeline.STAGES[4][1](spark, mixed, SF).collect()
    assert {d for r in packed for d in r.doc_ids} <= set(ids)
