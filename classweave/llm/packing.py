"""Packing: documents in the order of a space-filling curve, cut into training sequences."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.llm import textbytes as tb
from classweave.llm.frames import begin_task, map_batches, release_memory, written
from classweave.llm.tokens import encoded_runs

SEQUENCE_TOKENS = 1024
#: Size of the hashed word vector, and dimensions and bits per dimension of the curve.
VECTOR, DIMENSIONS, BITS = 64, 3, 10


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of points with integer coordinates below 2 ** bits; one row per point.

    From the highest bit down, each coordinate's bit says whether the lower bits of the first coordinate are mirrored or
    exchanged with its own; Gray decoding of what results gives the position (Skilling's formulation of the curve).
    """
    x = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(len(x)):
            mirrored = (x[d] >> bit & 1).astype(bool)
            exchange = np.where(mirrored, 0, (x[0] ^ x[d]) & low)
            x[0] = x[0] ^ np.where(mirrored, low, exchange)
            x[d] = x[d] ^ exchange
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for coordinate in x:
            key = key << 1 | (coordinate ^ turn) >> bit & 1
    return key


def _directions() -> np.ndarray:
    """Fixed orthonormal directions onto which word vectors are projected."""
    q, _ = np.linalg.qr(np.random.default_rng(20240229).standard_normal((VECTOR, DIMENSIONS)))
    return q


_erf = np.vectorize(math.erf, otypes=[float])


def curve_keys(column: pa.Array) -> np.ndarray:
    """The curve position of each text: hashed word counts, signed, scaled to length 1, projected, and cut into cells.

    A coordinate of a random direction is nearly normal, so its cell is taken from the normal distribution function:
    cells hold like numbers of texts. A text without words, or a null one, lies in the middle of the curve's cube.
    """
    out = [np.zeros(0, dtype=np.int64)]
    for _, _, data, offsets in tb.text_runs(column):
        starts, ends, first = tb.word_spans(data, offsets)
        n = len(offsets) - 1
        hashes = tb.word_hashes(data, starts, ends)
        text = np.repeat(np.arange(n), np.diff(first))
        slot = text * VECTOR + (hashes >> np.uint64(58)).astype(np.int64)
        sign = 1.0 - 2.0 * (hashes & np.uint64(1)).astype(float)
        vectors = np.bincount(slot, weights=sign, minlength=n * VECTOR).reshape(n, VECTOR)
        length = np.linalg.norm(vectors, axis=1, keepdims=True)
        projected = (vectors / np.where(length > 0, length, 1)) @ _directions()
        share = 0.5 + 0.5 * _erf(projected * math.sqrt(VECTOR / 2))
        cells = np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
        out.append(hilbert_key(cells, BITS))
    return np.concatenate(out)


class _Stream:
    """Cuts one task's documents into sequences. Pieces are (document, start, ids, tokens of the document, sequence, offset)."""

    def __init__(self, task: int, length: int):
        self.length, self.next_id = length, task << 32
        self.open: list[tuple] = []
        self.used = 0

    def _place(self, piece: tuple, sequence: int, offset: int) -> tuple:
        doc, start, ids, total = piece
        return doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset, ids

    def add(self, doc, ids: bytes) -> list[tuple]:
        """Pieces that now lie in full sequences."""
        done = []
        total, start = len(ids) // 4, 0
        while start < total:
            n = min(self.length - self.used, total - start)
            self.open.append((doc, start, ids[4 * start : 4 * (start + n)], total))
            start, self.used = start + n, self.used + n
            if self.used == self.length:
                done += self._close(self.open)
                self.open, self.used = [], 0
        return done

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for piece in pieces:
            out.append(self._place(piece, self.next_id, offset))
            offset += len(piece[2]) // 4
        self.next_id += 1
        return out

    def rest(self) -> list[tuple]:
        """What is left, cut into sequences whose lengths are powers of two, so that none needs padding."""
        out = []
        while self.used:
            size = 1 << (self.used.bit_length() - 1)
            room, taken, left = size, [], []
            for doc, start, ids, total in self.open:
                n = min(room, len(ids) // 4)
                if n:
                    taken.append((doc, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    left.append((doc, start + n, ids[4 * n :], total))
                room -= n
            out += self._close(taken)
            self.open, self.used = left, self.used - size
        return out


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence_tokens: int = SEQUENCE_TOKENS, partitions: int | None = None, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with `with_ids` the ids.

    The texts are written once with their curve keys, range-partitioned and sorted by key, and each task then packs its
    stretch of the curve: documents stand one behind the other, each with the end id, and are cut where a sequence is
    full. Every sequence has `sequence_tokens` ids but for the last few of a task, whose lengths are smaller powers of
    two; no sequence is padded. A sequence holds documents of one task only, and `sequence_id` names task and number.
    Equal keys, as of copies, are dealt out by id and text, so no group of copies meets in one task. A null or empty text
    is its end id; a document without an id or with a repeated one is packed like any other; an empty table gives none.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(docs[id_col].alias("doc"), docs[text_col].cast("string").alias("text"))
    keyed = written(map_batches(slim, lambda batch: {"curve": pa.array(curve_keys(batch.column(1)))}, [T.StructField("curve", T.LongType())]), "curve")
    laid_out = keyed.repartitionByRange(partitions, "curve", "doc", F.xxhash64("text")).sortWithinPartitions("curve", "doc")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fields = [T.StructField(names[0], slim.schema["doc"].dataType)] + [T.StructField(n, T.LongType()) for n in names[1:]] + [T.StructField("ids", T.BinaryType())] * with_ids

    def pieces(batches):
        begin_task("encoder")
        stream = None

        def frame(rows: list[tuple], kind: pa.DataType):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:7]], *[pa.array(columns[7], pa.binary())] * with_ids], names=[f.name for f in fields]
            )

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            stream = stream or _Stream(TaskContext.get().partitionId(), sequence_tokens)
            for first, run in encoded_runs(batch.column(1), tokenizer):
                rows = []
                for doc, ids in zip(batch.column(0).slice(first, len(run)).to_pylist(), run):
                    rows += stream.add(doc, ids)
                if rows:
                    yield frame(rows, kind)
        if stream and (rows := stream.rest()):
            yield frame(rows, kind)
        release_memory()

    return laid_out.select("doc", "text").mapInArrow(pieces, T.StructType(fields))
