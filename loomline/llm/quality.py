"""Quality classifier from weak labels.

Heuristic labellers look at statistics of a whole text and vote good, bad or nothing. The votes of all
documents are counted by pattern (at most 3^labellers rows, whatever the corpus), and expectation-maximisation
over the counts estimates how accurate each labeller is: how often it casts each vote on good documents and
on each kind of bad ones, and how frequent they are. Posterior labels of a bounded sample (`sample_rows`, chosen by a hash of the id) train a linear
scorer over hashed features: byte trigrams, case kept, and binned statistics. The scorer then reads
every whole text.

A document is kept when its score, the probability of being good, is at least `threshold`.

Defined results: a null, empty or blank text scores 0 and is rejected; rows that share an id are scored each on
its own; a corpus without any bad vote keeps all that has words; extra columns pass through `keep_good` as they are, and through
`scored`, whose own columns (quality_posterior, quality_score) replace equally named ones; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, keep_rows, pieces

#: Dimensions of the hashed feature space: the weights that are broadcast.
DIMENSIONS = 4096
#: Rows whose posterior labels train the scorer, at most.
SAMPLE_ROWS = 4096
#: Bytes of text whose features are made at once.
CHUNK_BYTES = 1 << 21

# Classes of bytes: other, upper, lower, digit, space, line end, symbol, "!", "|", stop.
_CLASS = np.zeros(256, np.uint8)
for _k, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\v\f", b"\n", b"*#$%&@^~<>{}[]\\=_+", b"!", b"|", b".?;:,"), 1):
    _CLASS[list(_bytes)] = _k
_N_CLASSES = 10

#: (name, statistic index, bad above, good below): a statistic between the two brings no vote.
LABELLERS = (
    ("symbols", 0, 0.04, 0.01),
    ("capitals", 1, 0.40, 0.15),
    ("exclamations", 2, 0.20, 0.05),
    ("pipes", 3, 0.20, 0.05),
    ("repeated neighbours", 4, 0.25, 0.06),
    ("few letters", 5, 0.45, 0.35),
)
GOOD, BAD = 1, 2
#: Below this number of words, counts per word say nothing.
FEW_WORDS = 8


def statistics(data: list[bytes]) -> np.ndarray:
    """One row of statistics a text; column -1 counts its words."""
    out = np.zeros((len(data), len(LABELLERS) + 1))
    at = 0
    while at < len(data):
        end, size = at, 0
        while end < len(data) and (end == at or size + len(data[end]) <= CHUNK_BYTES):
            size += len(data[end])
            end += 1
        part = data[at:end]
        lengths = np.array([len(d) for d in part])
        owner = np.repeat(np.arange(len(part)) * _N_CLASSES, lengths)
        counts = np.bincount(owner + _CLASS[np.frombuffer(b"".join(part), np.uint8)], minlength=len(part) * _N_CLASSES).reshape(len(part), _N_CLASSES)
        other, upper, lower, digit, space, line, symbol, exclamation, pipe, _ = counts.T.astype(float)
        words, again = np.zeros(len(part)), np.zeros(len(part))
        for i, d in enumerate(part):
            w = d.split()
            words[i] = len(w)
            again[i] = sum(map(bytes.__eq__, w, w[1:]))
        chars = np.maximum(1, lengths)
        w = np.maximum(1, words)
        letters = upper + lower
        out[at:end] = np.stack(
            [
                symbol / chars,
                upper / np.maximum(1, letters) * (letters >= 10),
                exclamation / w * (words >= FEW_WORDS),
                pipe / w * (words >= FEW_WORDS),
                again / w * (words >= FEW_WORDS),
                1 - (letters + other + digit) / chars,
                words,
            ],
            axis=1,
        )
        at = end
    return out


def votes(stats: np.ndarray) -> np.ndarray:
    """0, GOOD or BAD of each labeller; nothing where a text has no words."""
    out = np.zeros((len(stats), len(LABELLERS)), np.int64)
    for k, (_, column, bad, good) in enumerate(LABELLERS):
        out[:, k] = np.where(stats[:, column] > bad, BAD, np.where(stats[:, column] < good, GOOD, 0))
    return out * (stats[:, -1:] > 0)


def patterns(vote: np.ndarray) -> np.ndarray:
    return vote @ (3 ** np.arange(vote.shape[1]))


@dataclass(frozen=True)
class LabelModel:
    """Kinds of documents: kind 0 is good, the others are kinds of bad. share[kind]; rates[kind][labeller][vote]."""

    share: np.ndarray
    rates: np.ndarray

    def kinds(self, vote: np.ndarray) -> np.ndarray:
        """Probability of each kind for rows of votes."""
        k = np.arange(vote.shape[1])
        logs = np.stack([np.log(s) + np.log(r[k, vote]).sum(axis=1) for s, r in zip(self.share, self.rates, strict=True)], axis=1)
        p = np.exp(logs - logs.max(axis=1, keepdims=True, initial=-1e9))
        return p / p.sum(axis=1, keepdims=True)

    def posterior(self, vote: np.ndarray) -> np.ndarray:
        """Probability of good."""
        return self.kinds(vote)[:, 0]

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """By labeller: how often its bad votes and its good votes are right."""
        right = {}
        for k, (name, *_) in enumerate(LABELLERS):
            cast = self.share[:, None] * self.rates[:, k, :]
            right[name] = (float(cast[1:, BAD].sum() / cast[:, BAD].sum()), float(cast[0, GOOD] / cast[:, GOOD].sum()))
        return right


def fit_label_model(counts: dict[int, int], rounds: int = 200, max_false: float = 0.002) -> LabelModel:
    """EM over counted vote patterns. Bad text comes in kinds, one a labeller to start with, which holds the patterns that
    this labeller is the first to call bad; good text starts as the patterns that none calls bad. Votes alone can't tell a kind
    of bad text that one labeller sees from that labeller's mistakes, so it is assumed to call at most max_false of good text bad."""
    m = len(LABELLERS)
    keys = np.array(sorted(counts), np.int64)
    n = np.array([counts[k] for k in keys.tolist()], float)
    vote = keys[:, None] // 3 ** np.arange(m) % 3
    bad = vote == BAD
    first = np.where(bad.any(axis=1), bad.argmax(axis=1) + 1, 0)
    q = np.full((len(keys), m + 1), 0.02 / m)
    q[np.arange(len(keys)), first] = 0.98
    one_hot = vote[:, :, None] == np.arange(3)
    for _ in range(rounds):
        weight = (n[:, None] * q).T
        share = (weight.sum(axis=1) + 0.1) / (n.sum() + 0.1 * (m + 1))
        rates = (np.einsum("cp,pkv->ckv", weight, one_hot) + 0.1) / (weight.sum(axis=1)[:, None, None] + 0.3)
        rates[0, :, BAD] = np.minimum(rates[0, :, BAD], max_false)
        model = LabelModel(share, rates / rates.sum(axis=2, keepdims=True))
        new = model.kinds(vote)
        if not len(keys) or np.abs(new - q).max() < 1e-9:
            break
        q = new
    return model


def _bins(stats: np.ndarray) -> np.ndarray:
    """Hashed slots of each statistic's bin."""
    cols = [np.minimum(15, (stats[:, c] / bad * 8).astype(np.int64)) + 16 * k for k, (_, c, bad, _) in enumerate(LABELLERS)]
    return (np.stack(cols, axis=1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % DIMENSIONS


def _trigrams(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    code = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(20)  # the upper 12 bits: DIMENSIONS slots


def features(data: list[bytes], stats: np.ndarray) -> np.ndarray:
    """Dense feature rows, for training."""
    out = np.zeros((len(data), DIMENSIONS), np.float32)
    for i, d in enumerate(data):
        if len(d) > 2:
            out[i] = np.bincount(_trigrams(d), minlength=DIMENSIONS) * (TRIGRAM_SCALE / (len(d) - 2))
    for column in _bins(stats).T:
        out[np.arange(len(data)), column] += BIN_SCALE
    return out


#: What the trigram frequencies of a text sum to, and the value of the bin of each statistic.
TRIGRAM_SCALE, BIN_SCALE = 16.0, 2.0


def train(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression by full-batch gradient steps, sized for each weight; the last weight is the bias."""
    w, seen = np.zeros(DIMENSIONS + 1, np.float64), np.full(DIMENSIONS + 1, 1e-8)
    share = np.where(y >= 0.5, y.size / max(1.0, 2 * (y >= 0.5).sum()), y.size / max(1.0, 2 * (y < 0.5).sum()))
    if not len(y) or y.min() >= 0.5 or y.max() < 0.5:
        w[-1] = 4.0 if len(y) and y.mean() >= 0.5 else 0.0
        return w
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1].astype(np.float32) + w[-1], -40, 40)))
        off = (p - y) * share / len(y)
        g = np.append(off.astype(np.float32) @ x, off.sum()) + decay * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


def score(data: list[bytes], stats: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Probability of good; 0 for a text without words."""
    slots, z = w[:-1].astype(np.float32), np.full(len(data), w[-1])
    for i, d in enumerate(data):
        if len(d) > 2:
            for at in range(0, len(d) - 2, CHUNK_BYTES):
                z[i] += slots[_trigrams(d[at : at + CHUNK_BYTES + 2])].sum(dtype=np.float64) * (TRIGRAM_SCALE / (len(d) - 2))
    z += BIN_SCALE * slots[_bins(stats)].sum(axis=1)
    return np.where(stats[:, -1] > 0, 1 / (1 + np.exp(-np.clip(z, -40, 40))), 0.0)


def _encoded(texts) -> list[bytes]:
    return [(t.as_py() or "").encode() for t in texts]


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> tuple[LabelModel, np.ndarray]:
    """The label model from the votes of all documents, and the scorer's weights from a sample of at most sample_rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            stats = statistics(_encoded(batch.column(0)))
            keys, n = np.unique(patterns(votes(stats)[stats[:, -1] > 0]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], ["pattern", "n"])

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(count, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    counts = {r["pattern"]: r["n"] for r in counted.collect()}
    model = fit_label_model(counts)

    total = sum(counts.values())
    share = min(1.0, 1.2 * sample_rows / max(1, total))
    key = F.xxhash64(F.lit(29), F.col(id_col).cast("long"))
    chosen = docs.select(key.alias("key"), F.col(text_col).cast("string").alias("text")).where(F.pmod("key", F.lit(1_000_000)) < int(np.ceil(share * 1_000_000)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            data = _encoded(batch.column(1))
            stats = statistics(data)
            x = features(data, stats).astype(np.float16)
            found = [r.tobytes() if n else None for r, n in zip(x, stats[:, -1], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), pa.array(model.posterior(votes(stats)))], ["key", "x", "y"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = np.zeros((sample_rows, DIMENSIONS), np.float32), []
        for batch in batches:
            for value in batch.column(0):
                x[len(y)] = np.frombuffer(value.as_buffer(), np.float16)
                y.append(0.0)
            y[len(y) - batch.num_rows :] = batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([train(x[: len(y)], np.array(y)).tobytes()], pa.binary())], ["weights"])

    # rows of one size, a bounded number of them, meet in one task; the driver gets the weights only
    sample = chosen.mapInArrow(rows, "key long, x binary, y double").where("x is not null").orderBy("key", "x").limit(sample_rows)
    learnt = sample.select("x", "y").mapInArrow(learn, "weights binary").collect()
    return model, np.frombuffer(learnt[0]["weights"]) if learnt else train(np.zeros((0, DIMENSIONS), np.float32), np.zeros(0))


COLUMNS = T.StructType([T.StructField("quality_posterior", T.DoubleType()), T.StructField("quality_score", T.DoubleType())])


def scored(docs: DataFrame, model: LabelModel, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """docs with quality_posterior (of the label model) and quality_score (of the scorer)."""
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))

    def run(columns):
        model, w = shared.value
        for (texts,) in columns:
            data = [(t or "").encode() for t in texts]
            stats = statistics(data)
            posterior = np.where(stats[:, -1] > 0, model.posterior(votes(stats)), 0.0)
            yield [posterior.tolist(), score(data, stats, w).tolist()]

    return append_columns(docs, [text_col], COLUMNS, run)


def classify(docs: DataFrame, threshold: float = 0.5, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, posterior, score, kept."""
    model, weights = fit(docs, sample_rows, id_col, text_col)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = scored(narrow, model, weights, "text")
    return out.select("doc_id", F.col("quality_posterior").alias("posterior"), F.col("quality_score").alias("score"), (F.col("quality_score") >= threshold).alias("kept"))


def keep_good(docs: DataFrame, threshold: float = 0.5, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that the classifier keeps, all columns as they are."""
    model, weights = fit(docs, sample_rows, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(columns):
        for (texts,) in columns:
            data = [(t or "").encode() for t in texts]
            yield (score(data, statistics(data), shared.value) >= threshold).tolist()

    return keep_rows(docs, [text_col], run)
