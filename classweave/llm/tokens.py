"""Token ids of whole texts by a public byte-level tokenizer, and their storage as directly addressable codes."""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.functions import quoted
from classweave.llm import textbytes as tb
from classweave.llm.frames import begin_task, bound_batches, columns, free_name, keeps, release_memory
from classweave.sources.staging import fresh_path

#: Distinct pieces of text whose ids a worker keeps.
CACHE_PIECES = 1_500_000
#: Bytes of text that are tokenized together: more than a batch has, so that a batch is one run.
RUN_BYTES = 6 << 20
#: Tokens in one block of the file; a longer document has a block of its own.
BLOCK_TOKENS = 1 << 20
END_ID = 0


#: Signs that may follow a word without belonging to it; the apostrophe is not among them.
_TAIL = ".,;:!?)]}*#%&$"


class _Known:
    """The ids of pieces by two 64-bit hashes of the piece and its form, as sorted arrays; a size of -1 means uncuttable."""

    def __init__(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.checks = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int32)
        self.size = np.zeros(0, dtype=np.int32)
        self.flat = np.zeros(0, dtype=np.uint32)

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Places of the pieces, -1 for new ones."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (self.checks[at] == checks), at, -1)

    def add(self, keys: np.ndarray, checks: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        if len(self.keys) + len(keys) > CACHE_PIECES:
            return
        length = np.maximum(size, 0)
        begin = np.cumsum(length) - length + len(self.flat)
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.checks = np.insert(self.checks, at, checks[order])
        self.begin = np.insert(self.begin, at, begin[order].astype(np.int32))
        self.size = np.insert(self.size, at, size[order].astype(np.int32))
        self.flat = np.concatenate([self.flat, flat])


def _ragged(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of `flat` that begin and reach as given, one behind the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat((begin - (ends - size)).astype(np.int32), size) + np.arange(total, dtype=np.int32)]


class Encoder:
    """The ids of texts as little-endian unsigned 32-bit integers.

    A byte-level tokenizer of this kind splits a text first, and each line feed between two visible characters, and each
    space between two visible characters, begins a new part. So texts may be cut there, and of the pieces of many texts
    each distinct one is encoded once. A text is encoded whole where a piece begins or ends with any white space, and
    where it holds an added token, such as the mark of a text's end, which becomes that token's id as in a plain call.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: What the tokenizer reads as one token wherever it stands: a text with one is encoded whole.
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # For a piece of letters only, which the split would leave whole.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.tails: dict[str, list[int]] = {}
        self.known = _Known()
        self.feed = self.ids("\n")

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def piece(self, piece: str, prefix: str) -> list[int] | None:
        """The ids of a piece behind `prefix`; None where the text can't be cut."""
        stem = piece.rstrip(_TAIL)
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        if stem == piece or not stem or not (stem[-1].isalpha() and stem[-1] < "\u0250"):
            stem = piece
        whole = self.letters.encode(prefix + stem, add_special_tokens=False).ids if stem.isalpha() and max(stem) < "\u0250" else self.ids(prefix + stem)
        if stem == piece:
            return whole
        # A letter and a sign behind it are in different parts.
        tail = piece[len(stem) :]
        if tail not in self.tails:
            self.tails[tail] = self.ids(tail)
        return whole + self.tails[tail]

    def _pieces(self, distinct: pa.Array, used: np.ndarray, form: int) -> tuple[np.ndarray, np.ndarray]:
        """(size, ids) of the used pieces in one form: 0 behind a space, 1 at the start of a line; size -1 is uncuttable."""
        offsets = np.frombuffer(distinct.buffers()[1], dtype=np.int32)[distinct.offset : distinct.offset + len(distinct) + 1]
        data = np.frombuffer(distinct.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        start, end = (offsets[:-1] - offsets[0])[used], (offsets[1:] - offsets[0])[used]
        codes = tb.byte_codes(data)
        salt = np.uint64(0xD6E8FEB86659FD93 >> form)
        keys = tb.mix(tb.span_hash(tb.prefix_hash(codes), start, end) ^ salt)
        checks = tb.span_hash(tb.prefix_hash(tb.mix(codes ^ salt)), start, end)
        at = self.known.find(keys, checks)
        new = np.flatnonzero(at < 0)
        size = np.zeros(len(used), dtype=np.int64)
        old = np.flatnonzero(at >= 0)
        size[old] = self.known.size[at[old]]
        made = [self.piece(p, "" if form else " ") for p in distinct.take(pa.array(used[new])).to_pylist()]
        size[new] = [-1 if x is None else len(x) for x in made]
        fresh = np.fromiter(chain.from_iterable(x for x in made if x), dtype=np.uint32)
        length = np.maximum(size, 0)
        begin = np.zeros(len(used), dtype=np.int64)
        begin[old] = self.known.begin[at[old]]
        begin[new] = np.cumsum(length[new]) - length[new]
        flat = np.zeros(int(length.sum()), dtype=np.uint32)
        is_old = np.repeat(at >= 0, length)
        flat[is_old] = _ragged(self.known.flat, begin[old], length[old])
        flat[~is_old] = fresh
        self.known.add(keys[new], checks[new], size[new], fresh)
        return size, flat

    def encode(self, column: pa.Array) -> list[bytes]:
        """The ids of every text of a column without nulls."""
        lines = pc.split_pattern(column, "\n")
        pieces = pc.split_pattern(lines.flatten(), " ")
        line_of_text, piece_of_line = lines.offsets.to_numpy(), pieces.offsets.to_numpy()
        coded = pieces.flatten().dictionary_encode()
        code = coded.indices.to_numpy()
        first = np.zeros(len(code), dtype=np.int8)
        first[piece_of_line[:-1]] = 1
        row = np.zeros(len(code), dtype=np.int64)
        sizes, flats, done = [], [], 0
        for form in (0, 1):
            own = first == form
            used = np.zeros(len(coded.dictionary), dtype=bool)
            used[code[own]] = True
            place = np.cumsum(used) - 1 + done
            row[own] = place[code[own]]
            size, flat = self._pieces(coded.dictionary, np.flatnonzero(used), form)
            sizes.append(size)
            flats.append(flat)
            done += len(size)
        size, flat = np.concatenate(sizes), np.concatenate(flats)
        uncuttable = size < 0
        length = np.maximum(size, 0)
        count = length[row]
        ids = _ragged(flat, (np.cumsum(length) - length)[row], count)
        # The line feeds stand before the first piece of each line but a text's first.
        feeds = np.ones(len(piece_of_line) - 1, dtype=bool)
        feeds[line_of_text[:-1]] = False
        ends = np.concatenate([[0], np.cumsum(count)])
        before = ends[piece_of_line[:-1][feeds]]
        ids = np.insert(ids, np.repeat(before, len(self.feed)), np.tile(np.array(self.feed, dtype=np.uint32), len(before))).tobytes()
        fed = np.concatenate([[0], np.cumsum(feeds)]) * len(self.feed)
        text_end = (ends[piece_of_line[line_of_text]] + fed[line_of_text]) * 4
        out = [ids[s:e] for s, e in zip(text_end[:-1].tolist(), text_end[1:].tolist())]
        whole = set((np.searchsorted(piece_of_line[line_of_text], np.flatnonzero(uncuttable[row]), side="right") - 1).tolist())
        for token in self.added:
            whole.update(np.flatnonzero(pc.match_substring(column, token).to_numpy(zero_copy_only=False)).tolist())
        for k in sorted(whole):
            out[k] = np.array(self.ids(column[k].as_py()), dtype="<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """This worker's encoder."""
    return Encoder(path)


keeps("encoder", encoder.cache_clear)


def tokenizer_file(tokenizer: str) -> str:
    """The tokenizer's file on this machine: the path itself, or the place of a public tokenizer of that name."""
    if os.path.isabs(tokenizer):
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


def encoded_runs(column: pa.Array, tokenizer: str):
    """(first row, ids of each text with the end id) for runs of rows; null is empty."""
    column = pc.fill_null(column, "")
    end = np.array([END_ID], dtype="<u4").tobytes()
    codec = encoder(tokenizer_file(tokenizer))
    sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)) if len(column) else np.zeros(0)
    first = 0
    while first < len(column):
        done = sizes[first - 1] if first else 0
        stop = max(int(np.searchsorted(sizes, done + RUN_BYTES, side="right")), first + 1)
        yield first, [ids + end for ids in codec.encode(column.slice(first, stop - first))]
        first = stop


_BLOCK_SCHEMA = "shard int, block int, doc_ids array<bigint>, ends array<bigint>, codes binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> None:
    """Write the ids of every text, each with the end id behind it, in ascending order of the documents' ids.

    The texts are shuffled once, by range of id, and sorted within each shard; a shard is cut into blocks of about
    `BLOCK_TOKENS` ids, each whole documents. A block is one row: its place (shard, block), the documents' ids, where
    each document ends among the block's ids, and the codes of all of them in the format of `dac`. Spark's committed
    writer makes each shard's file appear once, whatever executor was lost. A null text is empty and has the end id only;
    documents without an id come first; equal ids stay next to each other; an empty table makes an empty one.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))

    def blocks(batches):
        from classweave.llm import dac

        begin_task("encoder")
        shard, block = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        owners: list[int | None] = []
        count = 0

        def made():
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            ends = np.cumsum([len(x) // 4 for x in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([owners], pa.list_(pa.int64())), pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([dac.encode(ids)], pa.binary())],
                names=["shard", "block", "doc_ids", "ends", "codes"],
            )

        for batch in batches:
            for first, run in encoded_runs(batch.column(1), tokenizer):
                names = batch.column(0).slice(first, len(run)).to_pylist()
                for doc, ids in zip(names, run):
                    if held and count + len(ids) // 4 > BLOCK_TOKENS:
                        yield made()
                        held, owners, count, block = [], [], 0, block + 1
                    held.append(ids)
                    owners.append(doc)
                    count += len(ids) // 4
        if held:
            yield made()
        release_memory()

    # Equal ids in different tasks would still be in order: the text is a second key.
    laid_out = slim.repartitionByRange(shards, "doc", F.xxhash64("text")).sortWithinPartitions("doc")
    laid_out.mapInArrow(blocks, _BLOCK_SCHEMA).write.option("compression", "zstd").parquet(path)


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, start): how many ids stand before each block. The sums run over one row per shard, then per block."""
    sizes = spark.read.schema(_BLOCK_SCHEMA).parquet(path).select("shard", "block", F.element_at("ends", -1).alias("n"))
    per_shard = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = per_shard.select("shard", before.alias("base"))
    within = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sizes.select("shard", "block", within.alias("within")).join(offsets, "shard").select("shard", "block", (F.col("base") + F.col("within")).alias("start"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every written document, its ids as little-endian unsigned 32-bit integers."""
    return _read(spark, path, with_ids=True)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Like `read_tokens`, without the ids themselves: they are decoded and summed up, but not returned."""
    return _read(spark, path, with_ids=False)


def _read(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    fields = [T.StructField(n, T.LongType()) for n in ("shard", "block", "doc_id", "at", "n_tokens", "ids_crc32")] + [T.StructField("ids", T.BinaryType())] * with_ids

    def documents(batches):
        from classweave.llm import dac

        for batch in batches:
            for row in range(batch.num_rows):
                shard, block, owners, ends = (batch.column(i)[row].as_py() for i in range(4))
                codes = dac.Block(memoryview(batch.column(4)[row].as_buffer()))
                starts = [0, *ends[:-1]]
                ids = [codes.slice(s, e).astype("<u4").tobytes() for s, e in zip(starts, ends)]
                n = len(owners)
                columns = [[shard] * n, [block] * n, owners, starts, [e - s for s, e in zip(starts, ends)], [zlib.crc32(x) for x in ids]]
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], *[pa.array(ids, pa.binary())] * with_ids], names=[f.name for f in fields])

    stored = spark.read.schema(_BLOCK_SCHEMA).parquet(path)
    found = stored.mapInArrow(documents, T.StructType(fields))
    out = found.join(block_starts(spark, path), ["shard", "block"])
    return out.select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def tokens_at(spark: SparkSession, path: str, places: DataFrame, doc_col: str = "doc_id", at_col: str = "position") -> DataFrame:
    """`places` (document, position in it) with the id that stands there, in a column `token`; null beyond the document's end.

    Only blocks that hold an asked document meet the places; there each id is looked up by itself. Columns `places`
    already has keep their values; of a document that was written twice, both copies answer.
    """
    name = free_name(places.columns, "token")
    # The columns of `places` go along in one, so that theirs and those below cannot clash.
    asked = places.select(F.struct(*columns(places.columns)).alias("_place"), F.col(quoted(doc_col)).alias("_asked"), F.col(quoted(at_col)).alias("_at"))
    stored = spark.read.schema(_BLOCK_SCHEMA).parquet(path)
    entry = stored.select("shard", "block", F.posexplode(F.arrays_zip(F.col("doc_ids").alias("doc"), F.col("ends").alias("end"))).alias("k", "x"), "ends")
    entry = entry.select("shard", "block", F.col("x.doc").alias("_doc"), F.when(F.col("k") > 0, F.expr("ends[k - 1]")).otherwise(0).alias("_start"), F.col("x.end").alias("_end"))
    at = F.col("_at")
    wanted = asked.join(entry, F.col("_asked") == F.col("_doc")).select("shard", "block", "_place", F.when((at >= 0) & (at < F.col("_end") - F.col("_start")), F.col("_start") + at).alias("_i"))

    def look_up(batches):
        from classweave.llm import dac

        for batch in batches:
            for row in range(batch.num_rows):
                codes = dac.Block(memoryview(batch.column(3)[row].as_buffer()))
                asked_here = batch.column(2)[row].as_py()
                n = len(asked_here)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[row].as_py()] * n, pa.int32()), pa.array([batch.column(1)[row].as_py()] * n, pa.int32()), pa.array(asked_here, pa.int64()), pa.array([codes[i] for i in asked_here], pa.int64())],
                    names=["shard", "block", "_i", "_token"],
                )

    # A block is asked for each of its positions once, so the list of a block is no longer than the block.
    positions = wanted.where("_i IS NOT NULL").select("shard", "block", "_i").distinct().groupBy("shard", "block").agg(F.collect_list("_i").alias("asked"))
    answers = positions.join(stored.select("shard", "block", "codes"), ["shard", "block"]).mapInArrow(look_up, "shard int, block int, _i bigint, _token bigint")
    return wanted.join(answers, ["shard", "block", "_i"], "left").select("_place.*", F.col("_token").alias(name))


def store_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write to a fresh path in the shared folder and return it."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, id_col, text_col)
    return path
