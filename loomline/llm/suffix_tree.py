"""Language-model scores by a probabilistic suffix tree over words.

Symbols are words and an end of text. A state is a context of up to `depth` words that stood `least` times in training and
passes a divergence test: its count times the divergence of its next symbols from those of the context without its
oldest word exceeds `threshold` nats. The root is the add-one word distribution. A state gives

    P(x | s) = (c(s x) + T(s) * P(x | parent)) / (c(s) + T(s))

with T(s) the number of different symbols seen after s, and the parent its longest shorter suffix that is a state; a symbol
is scored by the longest suffix of what stands before it that is a state.

All counts are of whole texts. Texts are cut into blocks of tokens; blocks and the keepers of counts, which share out the
word sequences, exchange messages, one order after the other:

1. A block folds its sequences of the order, and sends each keeper the sorted keys of its share with their counts in training texts.
2. The keeper adds up the messages and answers each with the counts over the whole corpus, in the order asked, and numbers the sequences that may be contexts.
3. Longer sequences are asked for only where their context is frequent enough, and the longest only where a bound lets it pass the test. Then blocks send, for each context, what its
   occurrences add to the divergence and to T (both are sums over occurrences, kept as whole numbers, so that no order of
   adding changes them), and are told T where the context is a state.

The key of a word is its hash; that of a longer sequence is made of the numbers of its context and its last word, which lie so much
closer than hashes that a sorted list of them takes less than half the room.

So a frequent word or word pair is one number a block in each message, and neither the tree nor the vocabulary ever
is in one place. Blocks are written once, bucketed by number, so that answers travel to them and not they to the answers;
their hashes of words are let go when these are numbered.

Words are known by 64-bit hashes: with 10^9 different words the odds of any two sharing one are about 1 in 40. Longer sequences are known exactly.

Defined results: a null or empty text is the end symbol alone; a null id reads "null" in the checksum that holds texts out; rows
that share an id return a row each; a text longer than a block is cut into pieces that begin with the words before them,
and its scores are added up; extra columns are ignored; without training texts all probabilities are 1; an empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, pieces

#: Fixed values of the contract: a text is held out if the checksum of its id leaves this rest.
MODULUS, REST = 7, 2
#: The end of a text; no word holds a line end.
END = b"\n"
#: Tokens of a block.
BLOCK_TOKENS = 2_000_000
#: Bytes of text for which there is a keeper of counts and a bucket of blocks.
PART_BYTES = 4_000_000
#: Divergences are added up in steps of 2^-10 nats, parts of T in steps of 2^-20: T is exact for contexts of up to 2^19 occurrences, and off by 2^-21 of them at most beyond.
LLR_STEP, TYPE_STEP = float(1 << 10), float(1 << 20)

_BLOCK = "words int, block long, row_ids array<long>, doc_ids array<long>, held array<boolean>, sizes array<int>, skips array<int>, classes binary, codes binary, keys binary, a binary"
_MESSAGE = "kind int, part int, block long, keys binary, a binary, b binary"
_ANSWER = "kind int, part int, block long, a binary, b binary, total long, distinct long, given long"
_SCORES = "row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def squeeze(values: np.ndarray, ascending: bool = False) -> bytes:
    """64-bit values, compressed by byte planes; ascending ones as their differences."""
    v = np.ascontiguousarray(values).view(np.uint64)
    if ascending and len(v):
        v = np.concatenate([v[:1], np.diff(v)])
    planes = v.view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(v).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if len(v) else b"")


def spread(data: bytes, ascending: bool = False) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.empty(0, np.uint64)
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd"), np.uint8)
    v = np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(v, dtype=np.uint64) if ascending else v


@dataclass(frozen=True)
class Shares:
    """How sequences are shared out among keepers: words by the range of their hash, longer ones over a grid, by the numbers of their context and of their last word.

    A keeper numbers what it keeps, words by class of count, then in the order of the keys, longer ones in that order; `given` is, by order, the most numbers
    that any keeper gave, so keeper and place make one number. Words of one place are neighbours, so that frequent ones have low numbers.
    """

    parts: int
    given: tuple[int, ...] = ()

    @property
    def rows(self) -> int:
        return math.isqrt(self.parts)

    @property
    def columns(self) -> int:
        return self.parts // self.rows

    def numbers(self, order: int) -> int:
        """All numbers of sequences of `order` symbols are below this."""
        return (self.parts if order == 1 else self.rows * self.columns) * self.given[order - 1]

    def number(self, order: int, part: int, places: np.ndarray) -> np.ndarray:
        return places * self.parts + part if order == 1 else part * self.given[order - 1] + places

    def by_keeper(self, order: int, numbers: np.ndarray) -> np.ndarray:
        """Numbers as keys of the keepers' ranges."""
        return numbers % self.parts * self.given[0] + numbers // self.parts if order == 1 else numbers

    def wide(self) -> int:
        return self.numbers(1) // self.columns + 1

    def span(self, order: int) -> int:
        """Keys that a keeper of sequences of `order` symbols may have."""
        span = (self.numbers(order - 1) // self.rows + 1) * self.wide()
        if self.rows * self.columns * span >= 1 << 63:
            raise ValueError(f"keys of {order} symbols don't fit 63 bits")
        return span

    def keys(self, order: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Keys of sequences of `order` symbols from the numbers of their contexts and last words; each keeper's are in a range of its own."""
        r, c = self.rows, self.columns
        return (context % r * c + word % c) * self.span(order) + context // r * self.wide() + word // c

    def limits(self, kind: int) -> np.ndarray:
        """Where the range of each keeper begins: of keys (kind is the order), or of numbers (minus the order)."""
        if kind == 1:
            return np.array([(i << 64) // self.parts for i in range(self.parts)], np.uint64)
        step, parts = (self.span(kind), self.rows * self.columns) if kind > 0 else (self.given[-kind - 1], self.parts if kind == -1 else self.rows * self.columns)
        return np.arange(parts, dtype=np.uint64) * np.uint64(step)


def classes(counts: np.ndarray) -> np.ndarray:
    """Classes of counts by powers of two, the greatest first."""
    return 64 - np.frexp(counts.astype(np.float64))[1].astype(np.int64)


class _Codes(dict):
    """Numbers of words, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def blocks_of(docs: DataFrame, depth: int, block_tokens: int, id_col: str, text_col: str) -> DataFrame:
    """Blocks of whole texts, or of pieces of long ones, two rows each: token codes (words 0), and the sorted hashes of the words with their counts in training texts (words 1).

    Codes are numbers by class of count in the block, then by hash, so that those of frequent words are low; classes are told in the order of the hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 40
        row, number = task, task
        held: list[tuple] = []
        codes = _Codes()
        n = 0

        def close() -> pa.RecordBatch:
            nonlocal held, codes, n, number
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, codes), np.uint64, len(codes))
            tokens = np.concatenate([h[-1] for h in held])
            trains = np.concatenate([np.arange(h[3]) >= h[4] if not h[2] else np.zeros(h[3], bool) for h in held])
            of_word = classes(np.bincount(tokens, minlength=len(codes)))
            by_hash = np.argsort(hashes)
            code = np.empty(len(codes), np.int64)
            code[np.lexsort((hashes, of_word))] = np.arange(len(codes))
            counts = np.bincount(tokens[trains], minlength=len(codes))[by_hash]
            columns = [[h[i] for h in held] for i in range(5)]
            coded = [0, number, *columns, squeeze(of_word[by_hash]), squeeze(code[tokens]), None, None]
            counted = [1, number, *[None] * 7, squeeze(hashes[by_hash], True), squeeze(counts)]
            number += 1
            held, codes, n = [], _Codes(), 0
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(coded, counted, strict=True), kinds, strict=True)], [f.split()[0] for f in _BLOCK.split(", ")])

        for batch in pieces(batches, 256):
            for doc, name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = (text.as_py() or "").encode().lower().split()
                words.append(END)
                out = zlib.crc32(name.encode()) % MODULUS == REST
                at = 0
                while at < len(words):
                    if n >= block_tokens:
                        yield close()
                    skip = min(at, depth)
                    upto = at + max(1, block_tokens - n) if len(words) - at > block_tokens else len(words)
                    piece = np.fromiter(map(codes.__getitem__, words[at - skip : upto]), np.int64, upto - at + skip)
                    held.append((row, doc, out, len(piece), skip, piece))
                    n += len(piece)
                    at = upto
                row += 1
        if held:
            yield close()

    rows = docs.select(docs[id_col].cast("long").alias("doc"), F.coalesce(docs[id_col].cast("string"), F.lit("null")).alias("name"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, _BLOCK)


class Block:
    """The tokens of a block by position, and what keepers have answered: counts and numbers of the sequences that end there."""

    def __init__(self, row: dict, depth: int, least: int, threshold: float, shares: Shares):
        self.shares = shares
        self.depth, self.least, self.threshold, self.number = depth, least, threshold, row["block"]
        self.sizes, self.skips = np.array(row["sizes"], np.int64), np.array(row["skips"], np.int64)
        self.row_ids, self.doc_ids, self.held = row["row_ids"], row["doc_ids"], np.array(row["held"], bool)
        self.codes = spread(row["codes"]).view(np.int64)
        self.by_code = np.argsort(spread(row["classes"]), kind="stable")  # places in the order of the hashes
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.place = np.arange(len(self.codes)) - np.repeat(self.starts, self.sizes)
        self.own = self.place >= np.repeat(self.skips, self.sizes)
        self.train = self.own & ~np.repeat(self.held, self.sizes)
        self.counts: list[np.ndarray] = []
        self.numbers: list[np.ndarray] = []

    def before(self, values: np.ndarray) -> np.ndarray:
        """What stands one position to the left."""
        return np.concatenate([values[:1], values[:-1]])

    def asked(self, order: int) -> np.ndarray:
        """Positions whose sequence of `order` symbols, 2 or more, is asked for: the text reaches back so far, and the context is frequent enough."""
        context = self.possible(order - 1) if order == self.depth + 1 else self.counts[order - 2] >= self.least  # the longest are of use only after contexts that may be states
        return (self.place >= order - 1) & self.before(context)

    def folded(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions, sorted keys of the sequences that are asked for, index into them)."""
        mask = self.asked(order)
        keys, inverse = np.unique(self.shares.keys(order, self.before(self.numbers[order - 2])[mask], self.numbers[0][mask]), return_inverse=True)
        return mask, keys.astype(np.uint64), inverse

    def possible(self, order: int) -> np.ndarray:
        """Positions where a context of `order` words ends that is frequent enough and may pass the test.

        No next symbol is more likely after the context than after its suffix by a factor above c(suffix) / c(context), as it follows the
        suffix whenever it follows the context; so its count times the logarithm of that factor bounds the divergence.
        """
        count = self.counts[order - 1]
        frequent = count >= self.least
        if order > 1:
            with np.errstate(divide="ignore", invalid="ignore"):
                frequent &= count * np.log(self.counts[order - 2] / count) > self.threshold
        return frequent

    def question(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of the sequences of `order` symbols, 2 or more, and their counts in training texts of this block."""
        mask, keys, inverse = self.folded(order)
        return keys, np.bincount(inverse[self.train[mask]], minlength=len(keys))

    def answer(self, order: int, told: list[tuple[int, bytes, bytes]]) -> None:
        """Counts over all training texts and numbers by position, from the answers by keeper; 0 where it wasn't asked or has no number."""
        values, numbers = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for part, a, b in told:
            values.append(spread(a).view(np.int64))
            if order <= self.depth:
                numbers.append(np.zeros(len(values[-1]), np.int64))
                numbers[-1][numbered(order, values[-1], self.least)] = self.shares.number(order, part, spread(b, True).view(np.int64))
        mask, _, index = (slice(None), None, self.by_code[self.codes]) if order == 1 else self.folded(order)
        for told_, by_place in ((values, self.counts), (numbers, self.numbers))[: 2 if order <= self.depth else 1]:
            by_place.append(np.zeros(len(self.codes), np.int64))
            by_place[-1][mask] = np.concatenate(told_)[index]

    def candidates(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions, sorted numbers (by keeper) of their contexts of `order` words, index into them)."""
        mask = self.own & (self.place >= order) & self.before(self.possible(order))
        keys, inverse = np.unique(self.shares.by_keeper(order, self.before(self.numbers[order - 1])[mask]), return_inverse=True)
        return mask, keys.astype(np.uint64), inverse

    def evidence(self, order: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted numbers of contexts, and what their occurrences here add to the divergence and to the number of different next symbols."""
        mask, keys, inverse = self.candidates(order)
        learns = self.train[mask]
        count, context = self.counts[order][mask][learns], self.before(self.counts[order - 1])[mask][learns]
        shorter = self.counts[order - 1][mask][learns]
        base = self.before(self.counts[order - 2])[mask][learns] if order > 1 else total
        ratio = np.rint(np.log(count * (base / (context * shorter.astype(np.float64)))) * LLR_STEP).astype(np.int64)
        types = np.rint(TYPE_STEP / count).astype(np.int64)
        sums = [np.zeros(len(keys), np.int64) for _ in range(2)]
        np.add.at(sums[0], inverse[learns], ratio)
        np.add.at(sums[1], inverse[learns], types)
        return keys, sums[0], sums[1]

    def scores(self, total: int, distinct: int, types: list[np.ndarray]) -> Iterator[tuple]:
        """A row for each text or piece. types: by order of context, T of states and 0 of others, as `candidates` sorts them."""
        p = (self.counts[0] + 1.0) / (total + distinct + 1.0)
        known, base = (self.counts[0] > 0) & self.own, np.where(self.own, np.log10(p), 0.0)
        for order, kept in enumerate(types, 1):
            mask, _, inverse = self.candidates(order)
            t = kept[inverse].astype(np.float64)
            longer, context = self.counts[order][mask], self.before(self.counts[order - 1])[mask]
            p[mask] = np.where(t > 0, (longer + t * p[mask]) / (context + t), p[mask])
        score = np.where(self.own, np.log10(p), 0.0)
        own, known, base, score = (np.add.reduceat(x, self.starts) for x in (self.own.astype(np.int64), known.astype(np.int64), base, score))
        for i, row in enumerate(self.row_ids):
            yield row, self.doc_ids[i], bool(self.held[i]), int(own[i]), int(known[i]), float(base[i]), float(score[i])


def numbered(order: int, counts: np.ndarray, least: int) -> np.ndarray:
    """Indexes of the sequences of `order` symbols that have numbers, in the order of these: all words, and of longer ones those that may be contexts."""
    return np.argsort(classes(counts), kind="stable") if order == 1 else np.flatnonzero(counts >= least)


def messages(kind: int, block: int, limits: np.ndarray, keys: np.ndarray, a: np.ndarray, b: np.ndarray | None = None) -> Iterator[tuple]:
    """A row for each keeper that has keys in its range."""
    edges = np.append(np.searchsorted(keys, limits), len(keys))
    for part in np.flatnonzero(np.diff(edges)):
        of = slice(edges[part], edges[part + 1])
        yield kind, int(part), block, squeeze(keys[of] - limits[part], True), squeeze(a[of]), squeeze(b[of]) if b is not None else b""


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    names = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names, strict=True)], [n for n, _ in names])


def kept(asked: DataFrame, least: int | None = None, threshold: float | None = None) -> DataFrame:
    """Answers to messages: sums of counts or, with a threshold, T of the contexts whose divergence exceeds it. With `least`, keys are
    numbered as `numbered` says, and b has the numbers of those of a message. total, distinct, given (numbers): of a keeper, in its first row."""

    def run(group: pa.Table) -> pa.Table:
        keys = [spread(k, True) for k in group["keys"].to_pylist()]
        ends = np.cumsum([len(k) for k in keys])[:-1]
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(every[order]) > 0]))
        runs = np.diff(np.concatenate([cuts, [len(every)]]))

        def added(column: str) -> np.ndarray:
            return np.add.reduceat(np.concatenate([spread(x) for x in group[column].to_pylist()]).view(np.int64)[order], cuts)

        def told(values: np.ndarray) -> list[np.ndarray]:
            out = np.empty(len(every), np.int64)
            out[order] = np.repeat(values, runs)
            return np.split(out, ends)

        sums = added("a")
        if threshold is not None:
            sums = np.where(sums > threshold * LLR_STEP, np.maximum(1, np.rint(added("b") / TYPE_STEP)).astype(np.int64), 0)
        given, numbers = 0, [b""] * len(keys)
        if least is not None:
            kind = int(group["kind"][0].as_py())
            has = numbered(kind, sums, least)
            given, places = len(has), np.full(len(sums), -1)
            places[has] = np.arange(given)
            numbers = [squeeze(x[numbered(kind, n, least)], True) for x, n in zip(told(places), told(sums), strict=True)]
        first = [(int(sums.sum()), int((sums > 0).sum()), given)] + [(0, 0, 0)] * (len(keys) - 1)
        rows = [
            (k, p, b, squeeze(x), n, *f)
            for k, p, b, x, n, f in zip(group["kind"].to_pylist(), group["part"].to_pylist(), group["block"].to_pylist(), told(sums), numbers, first, strict=True)
        ]
        return _table(rows, _ANSWER)

    return asked.groupBy("kind", "part").applyInArrow(run, _ANSWER)


def scored(
    docs: DataFrame, depth: int = 2, least: int = 4, threshold: float = 18.0, block_tokens: int = BLOCK_TOKENS, parts: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one word distribution) and score (the tree), as log10 probabilities."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix-tree")
    texts = blocks_of(docs, depth, block_tokens, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length(docs[text_col].cast("string")))).first()[0] or 0
    parts = parts or max(8, -(-size // PART_BYTES))
    tables = Buckets(scratch, parts)
    try:
        blocks = tables.write(texts, "blocks", "words")
        final = scratch.table(_rounds(blocks, tables, depth, least, threshold, parts), "scores")
    finally:
        tables.drop()
    return final.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


class Buckets:
    """Tables bucketed by block number in the shared folder, so that what is of one block meets without another shuffle."""

    def __init__(self, scratch: Scratch, parts: int):
        self.scratch, self.parts, self.names = scratch, parts, {}

    def write(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """by: columns whose values have folders of their own."""
        self.names[name] = table = f"loomline_{name}_{uuid.uuid4().hex}"
        df.write.partitionBy(*by).bucketBy(self.parts, "block").option("path", self.scratch.path(name)).option("compression", "zstd").saveAsTable(table)
        return self.scratch.spark.table(table)

    def drop(self) -> None:
        for name, table in self.names.items():
            self.scratch.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.scratch.drop(name)


def _rounds(blocks: DataFrame, tables: Buckets, depth: int, least: int, threshold: float, parts: int) -> DataFrame:
    written: list[DataFrame] = []
    given: list[int] = []

    def answers(name: str, asked: DataFrame, least: int | None = None, limit: float | None = None) -> list[int]:
        """Sums of total and distinct, and the most numbers of a keeper."""
        told = kept(asked, least, limit).repartition(parts, "block")
        written.append(tables.write(told.groupBy("block").agg(F.collect_list(F.struct("kind", "part", "a", "b", "total", "distinct", "given")).alias(name)), name))
        return [int(x or 0) for x in written[-1].selectExpr(f"inline({name})").agg(F.sum("total"), F.sum("distinct"), F.max("given")).first()]

    def with_answers(each, schema: str) -> DataFrame:
        """each(block, answers by kind) for every block. Blocks and answers are bucketed alike, so nothing is shuffled again."""
        joined = blocks.where("words = 0")
        for told in written:
            joined = joined.join(told.hint("merge"), "block", "left")
        names, shares = [t.columns[1] for t in written], Shares(parts, tuple(given))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, 1):
                row = batch.to_pylist()[0]
                found: dict[int, list] = {}
                for a in [a for name in names for a in row[name] or []]:
                    found.setdefault(a["kind"], []).append((a["part"], a["a"], a["b"]))
                by_kind = {k: sorted(v) for k, v in found.items()}
                block = Block(row, depth, least, threshold, shares)
                for order in range(1, min(len(names), depth + 1) + 1):
                    block.answer(order, by_kind.get(order, []))
                yield from _table(list(each(block, by_kind)), schema).to_batches()

        return joined.mapInArrow(run, schema)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = Shares(parts).limits(1)
        for batch in pieces(batches, 1):
            row = batch.to_pylist()[0]
            yield from _table(list(messages(1, row["block"], limits, spread(row["keys"], True), spread(row["a"]))), _MESSAGE).to_batches()

    total = distinct = 0
    for order in range(1, depth + 2):
        if order == 1:
            asked = blocks.where("words = 1").select("block", "keys", "a").mapInArrow(words, _MESSAGE)
        else:
            asked = with_answers(lambda block, _, order=order: messages(order, block.number, block.shares.limits(order), *block.question(order)), _MESSAGE)
        sums = answers(f"counts_{order}", asked, least if order <= depth else None)
        given.append(sums[2])
        del asked
        if order == 1:
            total, distinct = sums[:2]
            tables.scratch.drop("blocks/words=1")
        tables.scratch.free()  # the shuffles of this round, before those of the next

    def contexts(block: Block, _) -> Iterator[tuple]:
        for order in range(1, depth + 1):
            yield from messages(-order, block.number, block.shares.limits(-order), *block.evidence(order, total))

    answers("states", with_answers(contexts, _MESSAGE), limit=threshold)
    tables.scratch.free()

    def scores(block: Block, by_kind: dict[int, list]) -> Iterator[tuple]:
        types = [np.concatenate([np.empty(0, np.int64)] + [spread(a).view(np.int64) for _, a, _ in by_kind.get(-order, [])]) for order in range(1, depth + 1)]
        return block.scores(total, distinct, types)

    pieces_ = with_answers(scores, _SCORES)
    summed = pieces_.groupBy("row_id").agg(
        F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    )
    return summed.withColumn("train_tokens", F.lit(total).cast("long"))
