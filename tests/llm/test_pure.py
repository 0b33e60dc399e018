"""The Python parts of the operators, without Spark."""

import hashlib
import random
import re

import numpy as np
import pytest

from loomline.llm import chat, decontaminate, exact_dedup, jaccard, packing, quality, secrets, suffix_dedup


def test_best_fit_is_best_fit_decreasing():
    def plain(sizes, width):
        room = []
        for size in sorted(sizes, reverse=True):
            fits = [(r, i) for i, r in enumerate(room) if r >= size]
            if fits:
                room[min(fits)[1]] -= size
            else:
                room.append(width - size)
        return sorted(room)

    rng = random.Random(1)
    for _ in range(200):
        width = rng.randint(5, 40)
        sizes = [rng.randint(1, width) for _ in range(50)]
        packed = packing.best_fit(sizes, width)
        assert sorted(i for s in packed for i in s) == list(range(50))
        assert sorted(width - sum(sizes[i] for i in s) for s in packed) == plain(sizes, width)


def test_position_ids_restart_at_segments():
    assert packing.position_ids([0, 3, 5], 7).tolist() == [0, 1, 2, 0, 1, 0, 1]


def test_scanner_agrees_with_regular_expressions():
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
    access, run = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")

    def plain(t):
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        found += [(m.start(), 1, m.end()) for m in access.finditer(t) if len(m[0]) >= 18] + [(m.start(), 2, m.end()) for m in run.finditer(t) if len(m[0]) >= 16]
        return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]

    parts = ["password", "secret", "token", "api_key", "APIKEY", "AKIA", "=", ":", " ", '"', "'", "é", "abcdef012345", "0123456789abcdef", "AKIAABCDEFGHIJKLMN", "ſecret", "\n", ".", "x"]
    rng, scanner = random.Random(3), secrets.compiled(secrets.BASE_RULES + secrets.MORE_RULES)
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert [s for s in scanner.scan(text) if s[0] in ("assign", "access", "hex")] == plain(text), text


def test_scanner_adds_spans_and_minimises():
    scanner = secrets.compiled(secrets.BASE_RULES + secrets.MORE_RULES)
    text = "é -----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18 + " Bearer " + "x" * 20
    assert [(k, text[a:b][:6]) for k, a, b in scanner.scan(text) if k not in ("hex", "assign")] == [("pem", "-----B"), ("forge", "ghp_a1"), ("bearer", "Bearer")]
    dfa = secrets.compile_rules([secrets._Parser("(ab|ac)*d{2,3}", False).parse()], False)
    assert len(dfa.table) == 6  # start, after a, one d, two d, three d, dead


def test_chat_round_trip_and_fold():
    rng = random.Random(5)
    alphabet = ["\\", "#", "<", ":", "### ", "</turn>", "\n", "é", "a", ""]
    for _ in range(300):
        turns = [("".join(rng.choices(alphabet, k=2)), "".join(rng.choices(alphabet, k=6))) for _ in range(3)]
        text, spans = chat.render(turns, frozenset({turns[0][0]}))
        assert chat.parse(text) == turns
        assert [chat.unescape(text[s["start"] : s["end"]]) for s in spans] == [t for r, t in turns if r == turns[0][0]]
    log = [(0, "message", "a", "user", "hi"), (1, "message", "b", "assistant", "he"), (2, "delta", "b", "", "llo"), (3, "edit", "a", "", "hey"), (4, "message", "c", "user", "x"), (5, "regenerate", "b", "", "new"), (6, "delta", "b", "", "er"), (7, "delete", "zz", "", "")]
    assert chat.fold(iter(log)) == [("user", "hey"), ("assistant", "newer")]
    assert chat.fold(iter([(0, "message", None, "user", "a"), (0, "message", None, "user", "b")])) == [("user", "a"), ("user", "b")]


def test_index_finds_exact_and_near_windows():
    rng = random.Random(7)
    words = [w.encode() for w in "a b c d e f g h".split()]
    for _ in range(60):
        items = [(str(i), [rng.choice(words) for _ in range(rng.randint(0, 5))]) for i in range(3)]
        docs = [[rng.choice(words) for _ in range(rng.randint(0, 30))] for _ in range(4)]
        queries = decontaminate.QuerySet(items, 3)
        for doc, (n, hit, spans, exact, near) in zip(docs, decontaminate.Block(*decontaminate.Block.build(docs), queries.vocabulary).results(queries, 1), strict=True):
            marks, found = set(), set()
            for item, w in items:
                k = min(3, len(w))
                windows = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
                for i in range(len(doc) - k + 1 if k else 0):
                    if tuple(doc[i : i + k]) in windows:
                        marks |= set(range(i, i + k))
                        found.add(item)
            assert (n, hit, exact) == (len(doc), len(marks), sorted(found))
            assert marks == {p for s in spans for p in range(s["start"], s["end"])} and set(exact) <= set(near)


def test_divide_skip_matches_counting():
    rng = random.Random(13)
    for _ in range(300):
        size = {y: rng.randint(20, 60) for y in range(40)}
        lists = []
        for _ in range(rng.randint(1, 12)):
            ids = np.array(sorted(rng.sample(range(40), rng.randint(1, 30))), np.int64)
            lists.append((ids, np.array([size[y] for y in ids.tolist()], np.int64)))
        n = rng.randint(20, 60)
        least = lambda m, n=n: np.maximum(1, jaccard.least_occurrences(n, m, 80) - 4)
        want = [y for y in range(40) if sum(y in ids for ids, _ in lists) >= least(np.int64(size[y]))]
        for long_list in (0, 8, 100):
            assert jaccard.divide_skip(lists, least, long_list).tolist() == want


def test_digest_runs_merge():
    rng = random.Random(17)
    rows = [(rng.choice([None, *range(60)]), bytes([rng.randrange(6)])) for _ in range(500)]
    for keep in (min, max):
        runs = []
        for part in (rows[i::7] for i in range(7)):
            run = exact_dedup.merged([exact_dedup._records([i for i, _ in part], [hashlib.sha256(t).digest() for _, t in part], [t for _, t in part])], keep.__name__)
            assert (run["digest"][1:] > run["digest"][:-1]).all()
            runs.append(run)
        while len(runs) > 1:
            runs = [exact_dedup.merged(runs[i : i + 3], keep.__name__) for i in range(0, len(runs), 3)]
        got = {bytes(r["digest"]).ljust(32, bytes(1)): (int(r["best"]), int(r["n"])) for r in runs[0]}
        texts = {t for _, t in rows}
        assert got == {hashlib.sha256(t).digest(): (keep(i for i, x in rows if x == t and i is not None), sum(x == t for _, x in rows)) for t in texts}
    broken = exact_dedup._records([1, 2], [b"d" * 32] * 2, [b"one", b"other"])
    with pytest.raises(ValueError):
        exact_dedup.merged([broken], "min")


def test_minimisers_and_shingles():
    words = [str(i % 7).encode() for i in range(200)]
    hashes = suffix_dedup.Hashes(words)
    runs = hashes.runs(10)
    assert len(runs) == 191 and runs[0] == runs[7] and runs[0] != runs[1]
    at = suffix_dedup.minimisers(runs, 20)
    assert all(np.any((at >= i) & (at < i + 20)) for i in range(len(runs) - 19))
    assert len(jaccard.shingles("a b c d e f", 5)) == 2 and len(jaccard.shingles("A b", 5)) == 1 and not len(jaccard.shingles(" ", 5)) and not len(jaccard.shingles(None, 5))
    assert jaccard.class_of(jaccard.shingles("A b", 5)) == jaccard.class_of(jaccard.shingles("a  B", 5))


def test_label_model_learns_kinds():
    good, bad = quality.GOOD, quality.BAD
    votes = np.array([[good] * 6, [good, good, good, bad, good, good], [bad, good, good, good, good, bad]])
    counts = dict(zip(quality.patterns(votes).tolist(), [900, 40, 60], strict=True))
    model = quality.fit_label_model(counts)
    assert (model.posterior(votes) > 0.5).tolist() == [True, False, False]
    assert all(0 <= a <= 1 and 0 <= b <= 1 for a, b in model.accuracies().values())
    assert quality.fit_label_model({}).posterior(votes).shape == (3,)
