"""Token-id output: best-fit-decreasing packing into fixed-width sequences.

Rows are tokenised where they are read. A document longer than a sequence is cut into full sequences and a
rest, losslessly. The pieces of a block of tokens are packed longest first, each into the open sequence
with the least room that still takes it; a segment tree over capacities finds that sequence in log(width)
steps. Blocks don't share sequences, so packing needs no shuffle, and a block's waste is below one
sequence for every open one.

A packed row is one line of the id matrix: `input_ids` holds seq_len little-endian ids (uint16, or uint32 for
large vocabularies), padded with the end id. `cu_seqlens` are the cumulative segment lengths from 0,
`position_resets` the columns at which position ids start again from 0, `doc_ids` and `piece_starts` the
document and the token offset of each segment.

Defined results: a null or empty text is one end id; repeated ids are packed as separate documents; a null
id stays null; a run of white space, letters or signs may be of any length; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import rows_to_batches

#: Fixed value: the published splitting pattern that belongs to the byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: the white space of the pattern, by Unicode's property.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Longer runs of white space are kept from the pattern, whose look-ahead steps back through a run.
LONG_RUN = 4096
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A vocabulary is broadcast; larger files are refused.
MAX_VOCABULARY_BYTES = 64 << 20
#: Tokens whose pieces are packed together.
BLOCK_TOKENS = 2_000_000

PACKED = T.StructType(
    [
        T.StructField("seq_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("piece_starts", T.ArrayType(T.LongType())),
        T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("position_resets", T.ArrayType(T.IntegerType())),
        T.StructField("input_ids", T.BinaryType()),
    ]
)


class CapacityTree:
    """Segment tree over room left: which is the least room, at or above a size, that some open sequence has?"""

    def __init__(self, most: int):
        self.base = 1 << (most + 1).bit_length()
        self.filled = bytearray(2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, sequence: int) -> None:
        if not self.open[room]:
            i = room + self.base
            while i and not self.filled[i]:
                self.filled[i] = 1
                i >>= 1
        self.open[room].append(sequence)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (room, sequence) with the least room that is at least size."""
        tree, i = self.filled, size + self.base
        if not tree[i]:
            while True:
                if i & (i + 1) == 0:
                    return None  # nothing to the right
                if not i & 1 and tree[i + 1]:
                    i += 1
                    break
                i >>= 1
            while i < self.base:
                i = 2 * i if tree[2 * i] else 2 * i + 1
        room = i - self.base
        sequence = self.open[room].pop()
        if not self.open[room]:
            tree[i] = 0
            i >>= 1
            while i and not (tree[2 * i] or tree[2 * i + 1]):
                tree[i] = 0
                i >>= 1
        return room, sequence


def best_fit(sizes: list[int], width: int) -> list[list[int]]:
    """Sequences of piece numbers, best-fit decreasing; equal sizes in the order given."""
    tree, sequences = CapacityTree(width), []
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[piece])
        room, at = found or (width, len(sequences))
        if not found:
            sequences.append([])
        sequences[at].append(piece)
        if room > sizes[piece]:
            tree.put(room - sizes[piece], at)
    return sequences


def load_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return data


class Encoder:
    """Token ids of texts of any kind.

    The pattern takes a run of white space in one piece, but for its last character if something follows. So a text can be cut before a
    run, and before that last character, without a change to any piece: nothing in the pattern looks back, and what ends before the
    run isn't changed by what comes after its first character. The pieces of long runs are found this way and merged alone.
    """

    def __init__(self, ranks: bytes, long_run: int = LONG_RUN):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.split = tiktoken.Encoding("packing", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})
        self.whole = tiktoken.Encoding("run", pat_str=r"[\s\S]+", mergeable_ranks=table, special_tokens={})
        self.decode = self.split.decode
        self.long = re.compile(f"[{WHITE}]{{{max(2, long_run)},}}")

    def __call__(self, text: str) -> list[int]:
        out: list[int] = []
        at = 0
        for run in self.long.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += self.split.encode_ordinary(text[at : run.start()])
            out += self.whole.encode_ordinary(text[run.start() : end])
            at = end
        return out + self.split.encode_ordinary(text[at:] if at else text)


def encoder(ranks: bytes) -> Encoder:
    return Encoder(ranks)


def pack(
    docs: DataFrame, seq_len: int = 2048, vocabulary: str = DEFAULT_VOCABULARY, end_id: int | None = None, block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Packed rows of the id matrix of all documents. end_id: appended to each document; by default the first free id."""
    data = load_ranks(vocabulary)
    end = 1 + max(int(line.split()[1]) for line in data.splitlines() if line) if end_id is None else end_id
    dtype = np.dtype("<u2") if end < 1 << 16 else np.dtype("<u4")
    shared = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = encoder(shared.value), TaskContext.get().partitionId() << 33

        def row(pieces):
            nonlocal number
            ids = np.full(seq_len, end, dtype)
            cuts = [0]
            for _, _, tokens in pieces:
                ids[cuts[-1] : cuts[-1] + len(tokens)] = tokens
                cuts.append(cuts[-1] + len(tokens))
            number += 1
            return number - 1, cuts[-1], [d for d, _, _ in pieces], [s for _, s, _ in pieces], cuts, cuts[:-1], ids.tobytes()

        def rows():
            held, n = [], 0
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    tokens = np.array([*encode(text.as_py() or ""), end], dtype)
                    for at in range(0, len(tokens), seq_len):
                        piece = (doc, at, tokens[at : at + seq_len])
                        if len(piece[2]) == seq_len:
                            yield row([piece])
                        else:
                            held.append(piece)
                            n += len(piece[2])
                    if n >= block_tokens:
                        yield from (row([held[i] for i in s]) for s in best_fit([len(p[2]) for p in held], seq_len))
                        held, n = [], 0
            yield from (row([held[i] for i in s]) for s in best_fit([len(p[2]) for p in held], seq_len))

        yield from rows_to_batches(rows(), PACKED, 512)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, PACKED)


def position_ids(cu_seqlens: list[int], seq_len: int) -> np.ndarray:
    """Position of each column in its segment; padding goes on as a segment of its own."""
    starts = np.zeros(seq_len, np.int64)
    for cut in cu_seqlens:
        if cut < seq_len:
            starts[cut] = cut
    return np.arange(seq_len) - np.maximum.accumulate(starts)
