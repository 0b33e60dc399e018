"""Near-duplicate lines by a segment-partition edit join. DataFrame functions only.

Equal lines are folded to one text. A text of more than threshold characters is cut into threshold + 1 segments; if
another is within `threshold` edits, one segment stands in it unchanged, and near its old place. So each text is
indexed by (length, segment number, segment), and probes the indexes of its own and of the shorter lengths with the few
substrings whose places are possible (multi-match-aware: the shift is bounded by the edits left of and right of a
segment). What meets, and differs by few enough letters in its counts of some, is decided by a banded bit-parallel automaton:
for each number of edits one word, with a bit for each diagonal of the band, moved by a character of the text at a time.

Shorter lines have no segments: they and the longer lines near them are found by patterns with places left out or blank.

Texts that are linked, directly or by way of others, are one class. Nothing needs all pairs of a class:

* Hashes of segments and substrings are first folded alone; only those that stand in two texts get their texts.
* Of the texts that share a hash, each is compared with one of them. Near copies become one class by that, at one comparison each.
* Where different classes still share a hash, each text is compared with those of other classes. Comparing counts is all that most of these pairs
  get: a pair is emitted only if lengths and counts of letters allow it. Groups of more than BLOCK texts are dealt into blocks, so
  that no task has more than a block of the index against the probes of a hash. The comparisons of unlike texts that share a
  hash grow with the square of their number, which is the method's own price; no pair is left out.

A line is a repeat when an equal line stands before it (in order of doc_id and place), and near when the first line of its class
is another text. `drop_lines` drops repeats, and lines within `threshold` edits of the first line of their class, which
always stays: no line is dropped without an equal or near line that is kept.

Defined results: null and empty texts have no lines, and a row of the report only if `every` is set; empty lines are dropped from counts; lines of at most threshold
characters are all of one class, since the allowed edits can replace all of such a line (`least_chars` sets a length below which lines are compared for equality only); rows that share an id are one document's lines twice, the second ones repeats; a null id
comes first in order; extra columns are ignored, whatever their names; an empty table gives no rows. Texts are known by two 64-bit hashes, and compared as they are.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .graph import components

#: 64-bit words of the filters that spare rows a shuffle; a full filter only spares nothing.
FILTER_WORDS = 1 << 17
#: Texts of a hash that are looked through at once; the index of larger groups is dealt into blocks of about this size.
BLOCK = 1024


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, place, line) of all lines that aren't empty."""
    split = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("place", "line"))
    return split.where("line <> ''")


def selected_places(length: int, threshold: int) -> list[tuple[int, int, int]]:
    """For a partner that is `length` characters shorter: (segment, least shift, greatest shift) of the substrings to probe.

    Multi-match-aware: with i segments before it, a segment may be shifted by at most i edits against its start,
    and by at most threshold - i against its end.
    """
    out = []
    for i in range(threshold + 1):
        low = max(-i, length - (threshold - i))
        high = min(i, length + (threshold - i))
        out.append((i, low, high))
    return out


def pieces_of(texts: DataFrame, threshold: int) -> DataFrame:
    """(h, id, held) of texts (id, line): their segments, which the index holds (1), and their other probes (0).

    Segment i of a text of m characters: the first parts have m div parts, the last m mod parts of them one more. A segment is its own
    probe at its own place. Pieces of plain ASCII are cut from bytes, which needs no walk over characters.
    """
    parts = threshold + 1
    places = [(d, i, shift) for d in range(parts) for i, low, high in selected_places(d, threshold) for shift in range(low, high + 1)]
    probes = ", ".join(f"named_struct('d', {d}, 'i', {i}, 's', {s}, 'held', {int(d == 0 and s == 0)}L)" for d, i, s in places)
    wide = texts.selectExpr("id", "line", "length(line) as n").selectExpr("*", "octet_length(line) = n as plain", "cast(line as binary) as bytes", f"explode(array({probes})) as p")
    placed = wide.selectExpr("id", "line", "n", "plain", "bytes", "p.held", "p.i", "p.s", "n - p.d as m")
    size, start = f"cast(m div {parts} + if(i >= {parts} - m % {parts}, 1, 0) as int)", f"cast(i * (m div {parts}) + greatest(0, i - ({parts} - m % {parts})) + s as int)"
    cut = placed.selectExpr("id", "line", "n", "plain", "bytes", "held", "i", "m", f"{size} as size", f"{start} as start").where(f"m >= {parts} and start >= 0 and start + size <= n")
    piece = "if(plain, substring(bytes, start + 1, size), cast(substring(line, start + 1, size) as binary))"
    return cut.selectExpr(f"xxhash64(m, i, {piece}) as h", "id", "held")


def sieve(keys: DataFrame, key: str, scratch: Scratch, name: str) -> DataFrame:
    """Set bits of hashed keys, of bounded size: (word, bits)."""
    words = keys.selectExpr(f"shiftright(pmod(xxhash64({key}), {FILTER_WORDS * 64}L), 6) as word", f"shiftleft(1L, cast(pmod(xxhash64({key}), 64L) as int)) as bits")
    return scratch.table(words.groupBy("word").agg(F.bit_or("bits").alias("bits")), name)


def sifted(df: DataFrame, words: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows of df whose key may be in the sieve; with "left_anti" those whose key isn't. At most FILTER_WORDS rows are broadcast."""
    hit = F.expr(f"shiftright(pmod(xxhash64({key}), {FILTER_WORDS * 64}L), 6) = word and (shiftleft(1L, cast(pmod(xxhash64({key}), 64L) as int)) & bits) <> 0")
    return df.join(F.broadcast(words), hit, how)


#: Letters whose counts make the two signatures of a line, a byte each; any letters give right results.
COUNTED = ("etaonrs", "ihldcum")


def letter_counts(line: str) -> list[str]:
    """SQL: names and values of counts of some letters, up to 255, packed into longs c0 and c1."""
    return [f"'c{k}', " + " | ".join(f"shiftleft(cast(least(255, length({line}) - length(replace({line}, '{c}', ''))) as bigint), {8 * i})" for i, c in enumerate(letters)) for k, letters in enumerate(COUNTED)]


def counts_apart(a: str, b: str) -> str:
    """SQL: summed differences of the signatures of two rows. An edit changes it by 2 at most."""
    return " + ".join(f"abs((shiftright({a}.c{k}, {8 * i}) & 255L) - (shiftright({b}.c{k}, {8 * i}) & 255L))" for k, letters in enumerate(COUNTED) for i in range(len(letters)))


def within_edits(left: str, right: str, threshold: int) -> str:
    """SQL: whether two array<string> columns of characters are within threshold edits, by the banded bit-parallel automaton.

    Bit d + threshold of word j after i characters of the left: its first i characters and the right's first i + d are within
    j edits. A step keeps matching diagonals, moves along a diagonal for a change, to the lower for a character that only
    the left has, and to the higher for one that only the right has.
    """
    k, width = threshold, 2 * threshold + 1
    full = (1 << width) - 1
    match = " | ".join(f"if(get({right}, i + {d}) = get({left}, i), {1 << (d + k)}, 0)" for d in range(-k, k + 1))
    # before the first character, d characters of the right can be had for d edits
    begin = ", ".join(f"'r{j}', {sum(1 << (d + k) for d in range(j + 1))}" for j in range(k + 1))
    steps, previous = [], None
    for j in range(k + 1):
        if previous is None:
            word = "s.r0 & m"
        else:
            word = f"((s.r{j} & m) | s.r{j - 1} | shiftright(s.r{j - 1}, 1) | shiftleft({previous}, 1)) & {full}"
        previous = f"({word})"
        steps.append(f"'r{j}', {previous}")
    final = f"shiftright(s.r{k}, size({right}) - size({left}) + {k}) & 1"
    # a text that is too far away stays so: no diagonal comes back
    return (
        f"abs(size({left}) - size({right})) <= {k} and aggregate(sequence(0, size({left}) - 1), named_struct({begin}), "
        f"(s, i) -> if(s.r{k} = 0, s, aggregate(array({match}), s, (t, m) -> named_struct({', '.join(steps)}))), s -> {final}) = 1"
    )


def _bound(value: str, name: str, body: str) -> str:
    """SQL: body with a variable, which is evaluated once; columns would be put into the body by the optimizer, and evaluated at each use."""
    return f"transform(array({value}), {name} -> {body})[0]"


def texts_within(x: str, y: str, threshold: int) -> str:
    """SQL: whether two texts are within threshold edits. What they have in common at their ends, found by bisection, changes no distance; the automaton reads the rest."""
    halves = "array(" + ", ".join(str(1 << i) for i in range(30, -1, -1)) + ")"
    front = f"aggregate({halves}, 0, (p, w) -> if(p + w <= t.most and substring(t.x, p + 1, w) = substring(t.y, p + 1, w), p + w, p))"
    back = f"aggregate({halves}, 0, (p, w) -> if(u.front + p + w <= u.t.most and substring(u.t.x, u.t.nx - p - w + 1, w) = substring(u.t.y, u.t.ny - p - w + 1, w), p + w, p))"
    inner = [f"substring(v.u.t.{c}, v.u.front + 1, v.u.t.n{c} - v.u.front - v.back)" for c in "xy"]
    split = _bound("named_struct('x', split(r.x, ''), 'y', split(r.y, ''))", "c", within_edits("c.x", "c.y", threshold))
    decided = f"if(r.x = '' or r.y = '', length(r.x) + length(r.y) <= {threshold}, {split})"
    decided = _bound(f"named_struct('x', {inner[0]}, 'y', {inner[1]})", "r", decided)
    decided = _bound(f"named_struct('u', u, 'back', {back})", "v", decided)
    decided = _bound(f"named_struct('t', t, 'front', {front})", "u", decided)
    return _bound(f"named_struct('x', {x}, 'y', {y}, 'nx', length({x}), 'ny', length({y}), 'most', least(length({x}), length({y})))", "t", decided)


def likely(x: str, y: str, threshold: int) -> str:
    """SQL: whether lengths and letter counts of two signatures (n, c0, c1) allow a link."""
    return f"abs({x}.n - {y}.n) <= {threshold} and {counts_apart(x, y)} <= {2 * threshold}"


def verified(pairs: DataFrame, asked: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose texts are within threshold edits, decided by the automaton."""
    texts = asked.select("id", "line")
    sides = pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")
    return sides.where(texts_within("x", "y", threshold)).select("a", "b")


def mixed(rows: DataFrame, classes: DataFrame | None) -> DataFrame:
    """The rows (h, id, held, s) whose hash different classes share and an index holds, with part (class), main (largest part of the hash, and a text of it) and k (rows of the hash)."""
    named = rows.select("h", "id", "held", "s")
    if classes is None:
        named = named.withColumn("part", F.col("id"))
    else:
        named = named.join(classes.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component")
    parts = named.groupBy("h", "part").agg(F.count("*").alias("n"), F.min(F.struct("id", "s")).alias("first"), F.max("held").alias("held"))
    groups = parts.groupBy("h").agg(F.max(F.struct("n", "part", "first")).alias("main"), F.min("part").alias("lo"), F.max("part").alias("hi"), F.max("held").alias("held"), F.sum("n").alias("k"))
    return named.join(groups.where("lo < hi and held = 1").select("h", "main", "k"), "h")


def stars(rows: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b): of each class that shares a hash, one text with one of the largest class there."""
    firsts = rows.where("part <> main.part").groupBy("h", "part").agg(F.min(F.struct("id", "s")).alias("x"), F.min("main.first").alias("y"))
    return firsts.where(likely("x.s", "y.s", threshold)).selectExpr("x.id as a", "y.id as b")


def across(rows: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of texts of different classes that share a hash which the index holds for one of them, and that lengths and letter counts allow."""
    dealt = rows.withColumn("blocks", F.expr(f"cast(ceil(k / {BLOCK}) as int)"))
    index = dealt.where("held = 1").select("h", F.expr("pmod(xxhash64(id), blocks)").cast("int").alias("block"), F.col("id").alias("a"), F.col("part").alias("here"), F.col("s").alias("x"))
    probes = dealt.select("h", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.col("id").alias("b"), F.col("part").alias("there"), F.col("s").alias("y"))
    met = index.join(probes, ["h", "block"]).where(f"here <> there and {likely('x', 'y', threshold)}")
    return met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def short_patterns(threshold: int, short: bool) -> list[tuple[int, tuple[int, ...], str]]:
    """Patterns of lines of up to 2 * threshold characters.

    A line of n > threshold characters is within threshold edits of one of m <= threshold just if some i of its places are left out, some
    e of the other's, and r of the rest replaced, with i - e = n - m and i + e + r <= threshold. So both, with these places left out or
    blank, leave equal patterns. Each entry is (length, places, name of (n, m, e)); a place that is blank is given as -1 - place.
    """
    out = []
    for n in range(threshold + 1, 2 * threshold + 1):
        for m in range(1, threshold + 1):
            for e in range(m):
                r = threshold - (n - m + e) - e
                if r < 0:
                    continue
                length = m if short else n
                for places in combinations(range(length), m - e):
                    for blank in combinations(places, min(r, m - e)):
                        out.append((length, tuple(-1 - p if p in blank else p for p in places), f"{n}.{m}.{e}:"))
    return out


def short_keys(texts: DataFrame, threshold: int, short: bool) -> DataFrame:
    """(id, key) of the patterns of short lines, or of those that may be linked with short ones. A line break, which no line holds, is a blank."""
    made = ["cast(null as string)"]
    for length, places, name in short_patterns(threshold, short):
        parts = ["char(10)" if p < 0 else f"substring(line, {p + 1}, 1)" for p in places]
        made.append(f"if(length(line) = {length}, concat('{name}', {', '.join(parts)}), null)")
    return texts.selectExpr("id", f"explode(array_distinct(filter(array({', '.join(made)}), x -> x is not null))) as key")


def short_links(texts: DataFrame, threshold: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) that tie lines of at most threshold characters, and longer ones near any of them, into one class.

    Any two such lines are within threshold edits, as these can replace them whole; so they are one class, and a longer line is of it if it
    has a pattern of one of them. Each is tied to the first of the short lines only.
    """
    short = scratch.table(texts.where(f"length(line) <= {threshold}").select("id", "line"), "short")
    longer = texts.where(f"length(line) > {threshold} and length(line) <= {2 * threshold}").select("id", "line")
    near = short_keys(longer, threshold, False).join(short_keys(short, threshold, True).select("key").distinct(), "key", "left_semi").select("id").distinct()
    first = short.agg(F.min("id").alias("b")).where("b is not null")
    return scratch.table(short.select("id").union(near).join(F.broadcast(first)).selectExpr("id as a", "b").where("a <> b"), "short-links")


def linked_texts(every: DataFrame, threshold: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(asked, classes) of texts (id, line, ...): the texts that may share a hash, with signature s, and (node, component) of those with links."""
    texts, tied = every.where(f"length(line) > {threshold}"), short_links(every, threshold, scratch)
    spelled = pieces_of(texts, threshold)
    folded = spelled.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h")
    groups = scratch.table(folded, "groups")
    scratch.free()
    rows = sifted(spelled, sieve(groups, "h", scratch, "group-sieve"), "h").join(groups, "h", "left_semi")
    rows = scratch.table(rows, "rows")
    signed = sifted(texts, sieve(rows, "id", scratch, "id-sieve"), "id")
    ends = tied.select(F.col("a").alias("id")).union(tied.select(F.col("b").alias("id"))).distinct()
    signed = signed.union(every.join(ends, "id", "left_semi")).dropDuplicates(["id"])
    asked = scratch.table(signed.selectExpr("*", f"named_struct('n', length(line), {', '.join(letter_counts('line'))}) as s"), "asked")
    rows = scratch.table(mixed(rows.join(asked.select("id", "s"), "id"), None), "mixed")
    links = scratch.table(verified(stars(rows, threshold).distinct(), asked, threshold), "stars")
    classes = components(links, scratch, "star")
    rows = scratch.table(mixed(rows, classes), "apart")
    more = scratch.table(verified(across(rows, threshold).distinct(), asked, threshold), "links")
    scratch.drop("groups", "group-sieve", "id-sieve", "rows", "mixed")
    return asked, components(links.union(more).union(tied), scratch, "linked")


#: A first place as one number, so that it can be folded by hash: the id, and 32 bits of the place. A null id is below all others.
_SPOT = "cast(coalesce(cast(doc_id as decimal(20, 0)), -9223372036854775809BD) * 4294967296BD as decimal(38, 0)) + place"


def _place_of(spot: str) -> list:
    """(doc_id, place) of a spot."""
    doc = f"floor({spot} / 4294967296BD)"
    return [F.expr(f"cast(if({doc} < -9223372036854775808BD, null, {doc}) as bigint)"), F.expr(f"cast({spot} - {doc} * 4294967296BD as int)")]


def near_lines(docs: DataFrame, threshold: int = 2, least_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, place, n, key, repeat, near, first_doc, first_place, class_doc, class_place, dropped) of every line.

    first: first place of the line's own text. class: first place of all texts of its class. near: the two differ.
    dropped: whether `drop_lines` takes it out.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    lines = lines_of(docs, id_col, text_col)
    spots = lines.withColumn("spot", F.expr(_SPOT).cast("decimal(38,0)"))
    folded = spots.groupBy("line").agg(F.min("spot").alias("spot"), F.count("*").alias("copies"))
    hashes = {"key": F.xxhash64("line"), "check": F.xxhash64(F.lit(1), "line")}
    texts = scratch.table(folded.select(F.monotonically_increasing_id().alias("id"), "line", "spot", "copies", *[h.alias(k) for k, h in hashes.items()]), "texts", "zstd")
    scratch.free()
    asked, classes = linked_texts(texts.where(F.length("line") >= least_chars), threshold, scratch)

    members = classes.union(classes.select(F.col("component").alias("node"), "component").distinct()).withColumnRenamed("node", "id")
    inside = scratch.table(asked.join(members, "id"), "inside")
    heads = inside.groupBy("component").agg(F.min(F.struct("spot", "id", "line", "s")).alias("head"))
    near = F.expr(f"id = head.id or ({likely('s', 'head.s', threshold)} and {texts_within('line', 'head.line', threshold)})")
    judged = inside.join(heads, "component").select("id", "key", "check", "spot", F.col("head.spot").alias("head"), (near & (F.col("id") != F.col("head.id"))).alias("beside"))
    judged = scratch.table(judged, "judged")
    # only lines that stand twice or are linked have to learn anything from others
    repeated = texts.where("copies > 1").select("id", "key", "check", "spot", F.col("spot").alias("head"), F.lit(False).alias("beside")).join(judged, "id", "left_anti")
    known = scratch.table(repeated.union(judged).drop("id"), "known")
    words = sieve(known, "key", scratch, "known-sieve")
    scratch.drop("inside", "asked", "stars", "links")

    places = spots.select("doc_id", "place", "spot", F.length("line").alias("n"), *[h.alias(k) for k, h in hashes.items()])
    alone = sifted(places, words, "key", "left_anti").withColumns({"first": F.col("spot"), "head": F.col("spot"), "beside": F.lit(False)})
    others = sifted(places, words, "key").join(known.withColumnRenamed("spot", "first"), ["key", "check"], "left")
    others = others.withColumns({"first": F.coalesce("first", "spot"), "head": F.coalesce("head", "spot"), "beside": F.coalesce("beside", F.lit(False))})
    found = alone.unionByName(others)
    first, head = _place_of("first"), _place_of("head")
    # of equal places, which rows that share an id have, one is the first
    repeat = F.expr("spot <> first")
    return found.select(
        "doc_id", "place", "n", "key", repeat.alias("repeat"), F.expr("first <> head").alias("near"), first[0].alias("first_doc"), first[1].alias("first_place"),
        head[0].alias("class_doc"), head[1].alias("class_place"), (repeat | F.col("beside")).alias("dropped"),
    )


def line_report(docs: DataFrame, threshold: int = 2, least_chars: int = 1, id_col: str = "doc_id", text_col: str = "text", every: bool = False) -> DataFrame:
    """Per document with lines, or per document if `every`: doc_id, n_lines, n_repeat, n_near, n_dropped, chars_kept, classes.

    classes: by place, the first place of the text of each repeated or near line, and the first place of its class. A text that is linked with another
    has its class; lines without an entry are the first of theirs, which lists of other documents may name.
    """
    found = near_lines(docs, threshold, least_chars, id_col, text_col)
    gone = F.col("repeat") | F.col("near")

    def count(c):
        return F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")

    if every:
        found = found.unionByName(docs.select(F.col(id_col).cast("long").alias("doc_id")), allowMissingColumns=True)
    return found.groupBy("doc_id").agg(
        F.count("place").alias("n_lines"),
        count(F.col("repeat")).alias("n_repeat"),
        count(F.col("near")).alias("n_near"),
        count(F.col("dropped")).alias("n_dropped"),
        F.coalesce(F.sum(F.when(~F.col("dropped"), F.col("n"))), F.lit(0)).cast("long").alias("chars_kept"),
        F.array_sort(F.collect_list(F.when(gone, F.struct("place", "first_doc", "first_place", "class_doc", "class_place")))).alias("classes"),
    )


def drop_lines(docs: DataFrame, threshold: int = 2, least_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the lines that near_lines marks as dropped; empty lines, null texts and other columns stay as they are."""
    found = near_lines(docs, threshold, least_chars, id_col, text_col).where("dropped")
    gone = found.groupBy(F.col("doc_id").alias("id")).agg(F.collect_set(F.struct("place", "key")).alias("lines"))
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].cast("long").alias("row_id"), docs[text_col].cast("string").alias("row_text"))
    joined = whole.join(gone, F.col("row_id").eqNullSafe(F.col("id")), "left")
    kept = F.filter(F.split("row_text", "\n"), lambda x, i: ~F.array_contains(F.col("lines"), F.struct(i.alias("place"), F.xxhash64(x).alias("key"))))
    text = F.when(F.col("lines").isNull(), F.col("row_text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
