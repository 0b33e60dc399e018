"""N-gram Jaccard join: exact links between word-shingle sets, by T-occurrence search with DivideSkip.

Two sets x and y link when 100 * |x and y| >= percent * |x or y|, that is when they share at least T(x, y) shingles.

* Documents with equal sets form one class; only classes are searched.
* Shingles have one global order, rare before frequent. Frequencies come from a counting sketch of fixed size over the
  whole corpus; any order gives right results, a good one short lists.
* Of a set of n, only the first p shingles have inverted lists, where p is such that a partner must occur on one of them. A pair that
  occurs c times on these can share at most c + max(n - p) shingles, so partners need t = T - max(n - p) occurrences at least.
  Places on a list that leave less than T to share don't count.
* DivideSkip: a query's lists are divided into short ones and L long ones. The short ones are merged by a heap, which counts occurrences;
  a partner with t > L has to occur t - L times there, and only such ones are looked up in the long lists, by binary search. Entries of long
  lists whose sizes make t <= L are merged with the short ones, so that none is missed.
  Partners with t occurrences are decided exactly: the shorter set is probed by binary search in the longer one.
* Lists grow with groups of near copies. So before lists are merged, classes are sorted by their min-hash signatures, in a
  few rotations, and each is compared with its next neighbours; verified links make components. Only pairs of different components are looked for on
  the lists, by the classes of the smaller one, so that m near copies cost some m comparisons, not m squared.
  No link between different components is lost; inside a component no link can change the result.

Defined results: a null, empty or blank text has an empty set, links with nothing and is its own component; with fewer
words than a shingle the whole text is one shingle; equal ids are one node of the graph; rows with a null id
take part in no link and have a null component; extra columns are ignored; an empty table gives no rows.
Sets are compared by 64-bit hashes of shingles, classes by two such hashes.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower_tokens, packed, pieces, unpacked
from .graph import components

#: Powers of an odd number: shingles of up to 64 words.
POWERS = np.multiply.accumulate(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
#: Counters of the frequency sketch, and how many of them make a row of it.
SKETCH_BITS, SKETCH_ROW = 21, 1 << 15
#: Min-hashes of a signature, its rotations that are sorted, neighbours that are compared, and min-hashes that these must share.
SIGNATURE, ROTATIONS, NEIGHBOURS, ALIKE = 32, 4, 5, 20
#: Entries of a list that a query reads at once.
LIST_ROWS = 65_536
#: Entries from which a list is long: it is probed, not merged.
LONG_LIST = 32
#: 64-bit words of the filter that spares sets which no pair asks for; a full filter only spares nothing.
FILTER_WORDS = 1 << 17


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    words = ascii_lower_tokens(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(width, len(words))
    total = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):  # a polynomial in an odd number, different for each place
        total += h[i : len(h) - k + 1 + i] * POWERS[i]
    return np.unique(_mix(total))


def _counter(found: np.ndarray) -> np.ndarray:
    """Counters of shingles in the sketch."""
    return (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def class_of(found: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit hashes of a set."""
    data = found.tobytes()
    return xxhash.xxh64_intdigest(data) - (1 << 63), xxhash.xxh64_intdigest(data, 7) - (1 << 63)


def text_id(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest((text or "").encode()) - (1 << 63)


def prefix_length(n, percent: int):
    """Short lists of a set of n: a partner shares at least ceil(n * percent / 100) shingles."""
    return n - (n * percent + 99) // 100 + 1


def _scan(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Rows of documents (id, size, class, min-hashes) and, with a null class, rows of the frequency sketch."""
    salts = _mix(POWERS[:SIGNATURE]) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = np.zeros(1 << SKETCH_BITS, np.uint32), set()

        def out(ids, n, c1, c2, text, lows, part, counts):
            longs = [pa.array(x, pa.int64()) for x in (ids, n, c1, c2, text)]
            arrays = [*longs, pa.array(lows, pa.binary()), pa.array(part, pa.int64()), pa.array(counts, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "c1", "c2", "text_id", "signature", "part", "counts"])

        for batch in pieces(batches):
            n, ones, twos, texts, lows, new = [], [], [], [], [], []
            for text in batch.column(1):
                text = text.as_py()
                found = shingles(text, width)
                c1, c2 = class_of(found)
                texts.append(text_id(text))
                n.append(len(found))
                ones.append(c1)
                twos.append(c2)
                lows.append(np.array([(found * s).min() >> np.uint64(32) for s in salts], ">u4").tobytes() if len(found) else None)
                if c1 not in seen:
                    seen.add(c1)
                    new.append(found)
            at, k = _counter(np.concatenate(new)) if new else np.empty(0, np.int64), len(n)
            at, times = np.unique(at, return_counts=True)
            sketch[at] += times.astype(np.uint32)
            yield out(batch.column(0), n, ones, twos, texts, lows, [None] * k, [None] * k)
        rows = sketch.reshape(-1, SKETCH_ROW)
        used = np.flatnonzero(rows.any(axis=1)).tolist()
        none = [None] * len(used)
        yield out(none, none, none, none, none, none, used, [zlib.compress(rows[i].tobytes(), 1) for i in used])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, n long, c1 long, c2 long, text_id long, signature binary, part long, counts binary")


def _sketch(scanned: DataFrame) -> np.ndarray:
    """The summed sketch, of fixed size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(zlib.decompress(counts), np.uint32)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([zlib.compress(c.tobytes(), 1) for c in total.values()], pa.binary())], ["part", "counts"])

    schema = "part long, counts binary"
    rows = scanned.where("part is not null").select("part", "counts").mapInArrow(add, schema).repartition(8, "part").mapInArrow(add, schema)
    sketch = np.zeros(((1 << SKETCH_BITS) // SKETCH_ROW, SKETCH_ROW), np.uint32)
    for r in rows.collect():
        sketch[r["part"]] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return sketch.ravel()


def _neighbours(classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes that stand near each other in a sorted rotation of the signatures and share most of them."""
    step = SIGNATURE // ROTATIONS * 4
    turned = F.explode(F.array(*[F.struct(F.lit(r).alias("rotation"), F.concat(F.substring("signature", r * step + 1, 4 * SIGNATURE), F.substring("signature", 1, r * step)).alias("key")) for r in range(ROTATIONS)]))
    rows = classes.select("c1", "n", turned.alias("t")).select("t.rotation", "t.key", "c1", "n").repartitionByRange("rotation", "key").sortWithinPartitions("rotation", "key", "c1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(-1, SIGNATURE)
            here = [batch.column(0).to_numpy(), keys, batch.column(2).to_numpy(), batch.column(3).to_numpy()]
            new = len(last[0]) if last else 0
            turn, key, c1, n = (np.concatenate([o, h]) for o, h in zip(last, here, strict=True)) if last else here
            found = []
            for lag in range(1, min(NEIGHBOURS, len(c1) - 1) + 1):
                first = max(0, new - lag)
                x, y = slice(first, len(c1) - lag), slice(first + lag, len(c1))
                fits = (n[x] * percent <= n[y] * 100) & (n[y] * percent <= n[x] * 100) & (turn[x] == turn[y])
                fits &= (key[x] == key[y]).sum(axis=1) >= ALIKE
                found.append(np.stack([np.maximum(c1[x], c1[y])[fits], np.minimum(c1[x], c1[y])[fits]]))
            last = [v[-NEIGHBOURS:] for v in (turn, key, c1, n)]
            if found:
                a, b = np.concatenate(found, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def _prefixes(docs: DataFrame, sketch: np.ndarray, text_col: str, width: int, percent: int) -> DataFrame:
    """(shingle, c1, n, place): the short lists' postings, one class at most once a partition."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = shared.value, set()
        for batch in pieces(batches):
            held: list[tuple[np.ndarray, int, int]] = []
            for text in batch.column(1):
                found = shingles(text.as_py(), width)
                c1 = class_of(found)[0]
                if c1 in seen or not len(found):
                    continue
                seen.add(c1)
                first = np.argsort(rank[_counter(found)], kind="stable")[: prefix_length(len(found), percent)]
                held.append((found[first].astype(np.int64), c1, len(found)))
            if held:
                sizes = np.array([len(x) for x, _, _ in held])
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([x for x, _, _ in held])),
                        pa.array(np.repeat(np.array([c for _, c, _ in held], np.int64), sizes)),
                        pa.array(np.repeat(np.array([n for _, _, n in held], np.int64), sizes)),
                        pa.array((np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)).astype(np.int64)),
                    ],
                    ["shingle", "c1", "n", "place"],
                )

    return docs.select(F.lit(0), F.col(text_col).cast("string")).mapInArrow(run, "shingle long, c1 long, n long, place long")


def _sets(docs: DataFrame, pairs: DataFrame, classes: DataFrame, text_col: str, width: int) -> DataFrame:
    """(c1, shingles) of the classes that pairs (a, b) ask for.

    Each class is read from one of its texts; a filter of fixed size over the texts' hashes spares shingling the others.
    """
    asked = pairs.select(F.explode(F.array("a", "b")).alias("c1")).distinct()
    words = classes.join(asked, "c1", "left_semi").selectExpr(f"shiftright(pmod(text_id, {FILTER_WORDS * 64}L), 6) as word", "shiftleft(1L, cast(pmod(text_id, 64L) as int)) as bits")
    filled = np.zeros(FILTER_WORDS, np.int64)
    for r in words.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        filled[r["word"]] = r["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bits = set(), shared.value
        for batch in pieces(batches):
            ones, sets = [], []
            for text in batch.column(1):
                text = text.as_py()
                slot = text_id(text) % (FILTER_WORDS * 64)
                if not int(bits[slot >> 6]) >> (slot & 63) & 1:
                    continue
                found = shingles(text, width)
                c1 = class_of(found)[0]
                if c1 not in seen:
                    seen.add(c1)
                    ones.append(c1)
                    sets.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ones, pa.int64()), pa.array(sets, pa.binary())], ["c1", "shingles"])

    found = docs.select(F.lit(0), F.col(text_col).cast("string")).mapInArrow(run, "c1 long, shingles binary")
    return found.join(asked, "c1", "left_semi").dropDuplicates(["c1"])


def _linked(docs: DataFrame, pairs: DataFrame, classes: DataFrame, scratch: Scratch, name: str, text_col: str, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link, decided on whole sets."""
    sets = scratch.table(_sets(docs, pairs, classes, text_col, width), f"{name}-sets")
    left = pairs.join(sets.withColumnsRenamed({"c1": "a", "shingles": "x"}), "a")
    both = left.join(sets.withColumnsRenamed({"c1": "b", "shingles": "y"}), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                short, long = sorted((np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)), key=len)
                at = np.minimum(np.searchsorted(long, short), len(long) - 1)
                common = int((long[at] == short).sum())
                keep.append(100 * common >= percent * (len(short) + len(long) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = scratch.table(both.mapInArrow(run, "a long, b long"), f"{name}-links")
    scratch.drop(f"{name}-sets")
    return links


def _folded(edges: DataFrame) -> DataFrame:
    return edges.repartition("b").mapInArrow(_forest, "a long, b long")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one partition as stars: each node with the least node of its part."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while root.get(x, x) != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
            root.setdefault(min(a, b), min(a, b))
    pairs = [(x, t) for x in root if (t := find(x)) != x]
    for at in range(0, len(pairs), 8192):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs[at : at + 8192], strict=True)], ["a", "b"])


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least id that is reachable by links, itself included)."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    scanned = scratch.table(_scan(docs, id_col, text_col, width), "scan")
    sketch = _sketch(scanned)
    rows = scanned.where("part is null").select("doc_id", "n", "c1", "c2", "text_id", "signature")
    folded = rows.where("n > 0 and doc_id is not null").groupBy("c1").agg(F.min("doc_id").alias("node"), F.min("n").alias("n"), F.min("c2").alias("c2"), F.max("c2").alias("other"), F.min("text_id").alias("text_id"), F.min("signature").alias("signature"))
    sure = F.when(F.col("c2") == F.col("other"), F.col("node")).otherwise(F.raise_error(F.lit("equal hashes of different sets")))
    classes = scratch.table(folded.select("c1", sure.cast("long").alias("node"), "n", "text_id", "signature"), "classes")

    stars = scratch.table(_neighbours(classes, percent), "stars")
    first = _linked(docs, stars, classes, scratch, "star", text_col, width, percent)
    near = components(first, scratch, "near", _folded)

    # Postings of the short lists whose shingle stands in more than one class.
    postings = scratch.table(_prefixes(docs, sketch, text_col, width, percent), "postings")
    many = postings.groupBy("shingle").agg(F.min("c1").alias("lo"), F.max("c1").alias("hi")).where("lo < hi").select("shingle")
    many = scratch.table(many, "many")
    shared = scratch.table(postings.join(many, "shingle").distinct(), "shared")
    scratch.drop("postings", "many")

    lists = _lists(shared, classes, near, scratch, "lists")
    scratch.drop("shared")

    candidates = scratch.table(_merged(lists, scratch, percent), "candidates")
    second = _linked(docs, candidates, classes, scratch, "list", text_col, width, percent)

    names = classes.select("c1", "node")
    links = first.union(second).join(names.withColumnsRenamed({"c1": "a", "node": "p"}), "a").join(names.withColumnsRenamed({"c1": "b", "node": "q"}), "b").select(F.col("p").alias("a"), F.col("q").alias("b"))
    final = components(_with_repeats(links, rows, names), scratch, "final", _folded)
    answer = names.join(final, "node", "left").select("c1", F.coalesce("component", "node").alias("component"))
    answer = scratch.table(answer, "answer")
    out = rows.join(answer, "c1", "left")
    own = F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))


def _need(x, y, percent: int):
    """Shingles that sets of x and of y must share."""
    return (percent * (x + y) + 99 + percent) // (100 + percent)


def least_occurrences(n, m, percent: int):
    """How often sets of n and m that link must meet on the lists of their first shingles."""
    return _need(n, m, percent) - np.maximum(n - prefix_length(n, percent), m - prefix_length(m, percent))


def divide_skip(lists: list[tuple[np.ndarray, np.ndarray]], least, long_list: int | None = None) -> np.ndarray:
    """The ids that occur on at least least(size) of the lists (sorted ids, their sizes): short lists are merged by a heap, long ones probed."""
    long_list = LONG_LIST if long_list is None else long_list
    merged = [x for x in lists if len(x[0]) <= long_list]
    probed = [x for x in lists if len(x[0]) > long_list]
    skipped = len(probed)
    for i, (ids, sizes) in enumerate(probed):  # those that need not be on a short list
        few = least(sizes) <= skipped
        merged.append((ids[few], sizes[few]))
        probed[i] = ids[~few]
    size: dict[int, int] = {}
    for ids, sizes in merged:
        size.update(zip(ids.tolist(), sizes.tolist(), strict=True))
    every = np.fromiter(heapq.merge(*[ids.tolist() for ids, _ in merged if len(ids)]), np.int64)
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
    ids, times = every[first], np.diff(np.append(first, len(every)))
    needed = least(np.array([size[y] for y in ids.tolist()], np.int64))
    ids, times, needed = (v[times >= needed - np.where(needed > skipped, skipped, 0)] for v in (ids, times, needed))
    for long in probed:
        if len(ids) and len(long):
            times = times + (long[np.minimum(np.searchsorted(long, ids), len(long) - 1)] == ids)
    return ids[times >= needed]


def _merged(lists: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Pairs (a, b) that meet on enough short lists: the T-occurrence search of each class among those of larger components.

    A list is a row of arrays, sorted by partner; where a list is longer than LIST_ROWS, all lists are dealt into buckets of partners. A query's
    lists of one bucket come together.
    """
    longest = lists.groupBy("shingle").agg(F.count("*").alias("k")).agg(F.max("k")).first()[0] or 1
    bucket = F.pmod("c1", F.lit(-(-longest // LIST_ROWS))).alias("bucket")
    entries = F.array_sort(F.collect_list(F.struct("c1", "n", "place", "part", "weight"))).alias("y")
    arrays = lists.groupBy("shingle", bucket).agg(entries).select("shingle", "bucket", *[F.col(f"y.{c}").alias(f"y_{c}") for c in ("c1", "n", "place", "part", "weight")])
    asking = lists.where("part <> main").select("shingle", *[F.col(c).alias(f"x_{c}") for c in ("c1", "n", "place", "part", "weight")])
    met = asking.join(scratch.table(arrays, "arrays"), "shingle").drop("shingle")
    dealt = met.repartition("x_c1", "bucket").sortWithinPartitions("x_c1", "bucket")
    names = ["x_c1", "bucket", "x_n", "x_place", "x_part", "x_weight", "y_c1", "y_n", "y_place", "y_part", "y_weight"]

    def search(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        x, _, n, _, part, weight = rows[0][:6]
        lists = []
        for row in rows:
            y, m, at, parts, weights = (v.values.to_numpy(zero_copy_only=False) if hasattr(v, "values") else np.asarray(v) for v in row[6:])
            fits = ((weights > weight) | ((weights == weight) & (parts > part))) & (n * percent <= m * 100) & (m * percent <= n * 100)
            fits &= np.minimum(at, row[3]) + np.minimum(m - at, n - row[3]) >= _need(n, m, percent)
            if fits.any():
                lists.append((y[fits], m[fits]))
        y = divide_skip(lists, lambda m: least_occurrences(n, m, percent))
        return np.maximum(x, y), np.minimum(x, y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            keys = [batch.column(i).to_pylist() for i in range(6)]
            out = []
            for i in range(batch.num_rows):
                row = (*[k[i] for k in keys], *[batch.column(c)[i] for c in range(6, 11)])
                if held and held[0][:2] != row[:2]:
                    out.append(search(held))
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*out, strict=True)], ["a", "b"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in search(held)], ["a", "b"])

    return dealt.select(*names).mapInArrow(run, "a long, b long").distinct()


def _lists(shared: DataFrame, classes: DataFrame, near: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Postings (shingle, c1, n, place) of shingles in more than one component, with part, its size as weight, and the list's largest part as main."""
    sizes = near.groupBy("component").agg((F.count("*") + 1).alias("k"))
    named = near.join(sizes, "component").select(F.col("node").alias("c1"), "component", "k").union(sizes.select(F.col("component"), "component", "k"))
    parts = classes.select("c1").join(named, "c1", "left").select("c1", F.coalesce("component", "c1").alias("part"), F.coalesce("k", F.lit(1)).alias("weight"))
    known = scratch.table(shared.join(scratch.table(parts, f"{name}-parts"), "c1"), f"{name}-known")
    mixed = known.groupBy("shingle").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.max(F.struct("weight", "part")).alias("most")).where("lo < hi")
    mixed = scratch.table(mixed.select("shingle", F.col("most.part").alias("main")), f"{name}-mixed")
    lists = scratch.table(known.join(mixed, "shingle"), f"{name}-lists")
    scratch.drop(f"{name}-known", f"{name}-mixed", f"{name}-parts")
    return lists


def _with_repeats(links: DataFrame, rows: DataFrame, names: DataFrame) -> DataFrame:
    """Links between nodes, and those that ids standing for several classes make."""
    twice = rows.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("c1").alias("lo"), F.max("c1").alias("hi")).where("lo < hi").select("doc_id")
    again = rows.where("n > 0").join(twice, "doc_id").join(names, "c1").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    return links.union(again)


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose id is the least of its component; rows with a null id stay."""
    found = jaccard_components(docs, width, percent, id_col, text_col)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    return unpacked(packed(docs, id=docs[id_col].cast("long")).join(gone, F.col("id") == F.col("gone"), "left_anti"), docs.columns)
