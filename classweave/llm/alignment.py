"""Cross-tokenizer alignment: the tokens of two public tokenizers over the same bytes, joined by where they begin and end."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.functions import quoted
from classweave.llm import textbytes as tb
from classweave.llm.frames import begin_task, bound_batches, columns, free_name, keeps, release_memory, written
from classweave.llm.tokens import tokenizer_file

#: Bytes of text that are aligned together; a longer text is aligned by itself.
RUN_BYTES = 1 << 20
#: Distinct pieces of text whose tokens a worker keeps.
CACHE_PIECES = 1_000_000
#: New pieces that are read as one text.
JOINED_PIECES = 500
#: Links after which a task begins a new block.
BLOCK_LINKS = 1 << 20
#: What a pair's number has for its second id.
_SECOND = 32


def _byte_level() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable ones stand for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class _Known:
    """The ids of pieces on both sides, found by two 64-bit hashes of the piece; a piece that has to be read whole has none."""

    def __init__(self) -> None:
        self.keys, self.checks = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        self.begin, self.size = np.zeros((2, 0), dtype=np.int32), np.zeros((2, 0), dtype=np.int32)
        self.flat = [np.zeros(0, dtype=np.uint32)] * 2

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Places of the pieces, -1 for new ones."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (self.checks[at] == checks), at, -1)

    def add(self, keys: np.ndarray, checks: np.ndarray, size: np.ndarray, flat: list[np.ndarray]) -> None:
        if len(self.keys) + len(keys) > CACHE_PIECES:
            return
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        begin = np.cumsum(size, axis=1) - size + np.array([[len(x)] for x in self.flat])
        self.keys, self.checks = np.insert(self.keys, at, keys[order]), np.insert(self.checks, at, checks[order])
        self.begin = np.insert(self.begin, at, begin[:, order].astype(np.int32), axis=1)
        self.size = np.insert(self.size, at, size[:, order].astype(np.int32), axis=1)
        self.flat = [np.concatenate([old, new.astype(np.uint32)]) for old, new in zip(self.flat, flat)]


def _stretches(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of `flat` that begin and reach as given, one behind the other."""
    ends = np.cumsum(size)
    return flat[np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Pair:
    """Both tokenizers of a worker, the bytes of each of their ids, and the tokens of pieces met before."""

    def __init__(self, first: str, second: str):
        # The tokenizer's own threads would take cores that other tasks have.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=second)
        byte_of = _byte_level()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        a_bytes = [bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode() for name in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        #: The bytes of every id of either side, and how many.
        self.bytes = [pa.array(x, pa.large_binary()) for x in (a_bytes, b_bytes)]
        self.sizes = [np.array([len(x) for x in side]) for side in (a_bytes, b_bytes)]
        #: No piece of the second vocabulary reaches over the end of a word, so texts may be cut there.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.known = _Known()
        # What a token adds to the text of its group: its id and a comma, or at the end of its side a bar or a semicolon.
        written_ids = [f"{i}{end}" for i in range(len(names)) for end in ",|"] + [f"{i}{end}" for i in range(len(pieces)) for end in ",;"]
        self.spelled = pa.array(written_ids, pa.string())
        self.b_from = 2 * len(names)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """(sizes, [ids, ids]): the tokens of both sides of each text; none where a side's bytes are others than the text's behind a space."""
        firsts = [e.ids for e in self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        both = (firsts, self.b.encode(texts, num_threads=1))
        size = np.array([[len(x) for x in side] for side in both], dtype=np.int64).reshape(2, -1)
        flat = [np.fromiter(chain.from_iterable(side), dtype=np.int64, count=int(n)) for side, n in zip(both, size.sum(axis=1))]
        raw = [b" " + t.encode() for t in texts]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        same = np.ones(len(texts), dtype=bool)
        for side in (0, 1):
            reach = np.concatenate([[0], np.cumsum(self.sizes[side][flat[side]])])
            own_ends = reach[np.concatenate([[0], np.cumsum(size[side])])]
            spelled = self.spell(side, flat[side])
            if not np.array_equal(own_ends, ends) or spelled != b"".join(raw):
                same &= [spelled[s:e] == x for s, e, x in zip(own_ends[:-1].tolist(), own_ends[1:].tolist(), raw)]
        flat = [ids[np.repeat(same, n)] for ids, n in zip(flat, size)]
        return size * same, flat

    def spell(self, side: int, ids: np.ndarray) -> bytes:
        """The bytes of all these ids, one behind the other."""
        taken = self.bytes[side].take(pa.array(ids, pa.int64()))
        return taken.buffers()[2].to_pybytes()[: int(self.sizes[side][ids].sum())] if len(ids) else b""

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The same for pieces that stand between single spaces: many are read as one text, in which both sides end tokens with each."""
        sizes, flat = [np.zeros((2, 0), dtype=np.int64)], ([np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)])
        for k in range(0, len(pieces), JOINED_PIECES):
            part = pieces[k : k + JOINED_PIECES]
            text = " ".join(part)
            ends = np.cumsum([len(p.encode()) + 1 for p in part])
            both = (self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text))
            ids = [np.array(side, dtype=np.int64) for side in both]
            reach = [np.cumsum(self.sizes[side][ids[side]]) for side in (0, 1)]
            raw = b" " + text.encode()
            if all(len(r) and r[-1] == len(raw) and np.isin(ends, r).all() and self.spell(side, i) == raw for side, (r, i) in enumerate(zip(reach, ids))):
                size = np.array([np.diff(np.searchsorted(r, ends, side="right"), prepend=0) for r in reach])
            else:
                size, ids = self.encode(part)
            sizes.append(size)
            flat[0].append(ids[0])
            flat[1].append(ids[1])
        return np.concatenate(sizes, axis=1), [np.concatenate(side) for side in flat]

    def pieces(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(begins, sizes, [ids, ids]) of pieces that stand between single spaces; none where the text has to be read whole."""
        # At white space next to a space neither side need end a token.
        plain = pc.and_(pc.equal(pc.utf8_trim_whitespace(distinct), distinct), pc.not_equal(distinct, ""))
        cut = np.flatnonzero(plain.to_numpy(zero_copy_only=False) & self.cuttable)
        offsets = np.frombuffer(distinct.buffers()[1], dtype=np.int32)[distinct.offset : distinct.offset + len(distinct) + 1]
        codes = tb.byte_codes(np.frombuffer(distinct.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]])
        start, end = (offsets[:-1] - offsets[0])[cut], (offsets[1:] - offsets[0])[cut]
        keys = tb.span_hash(tb.prefix_hash(codes), start, end)
        checks = tb.span_hash(tb.prefix_hash(tb.mix(codes ^ np.uint64(0xD6E8FEB86659FD93))), start, end)
        at = self.known.find(keys, checks)
        old, new = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        made, ids = self.encode_pieces(distinct.take(pa.array(cut[new])).to_pylist())
        begin, size = np.zeros((2, len(distinct)), dtype=np.int64), np.zeros((2, len(distinct)), dtype=np.int64)
        # New ids stand behind those of pieces met before.
        shift = np.array([[len(x)] for x in self.known.flat])
        begin[:, cut[old]], size[:, cut[old]] = self.known.begin[:, at[old]], self.known.size[:, at[old]]
        begin[:, cut[new]], size[:, cut[new]] = np.cumsum(made, axis=1) - made + shift, made
        flat = [np.concatenate([before, now.astype(np.uint32)]) for before, now in zip(self.known.flat, ids)]
        self.known.add(keys[new], checks[new], made, ids)
        return begin, size, flat

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the first, tokens of each text, ids of the second, tokens of each text); a text that either side can't spell has none."""
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        begin, size, flat = self.pieces(coded.dictionary)
        code, ends = coded.indices.to_numpy(zero_copy_only=False), split.offsets.to_numpy()
        unread = np.flatnonzero((size[0] == 0)[code])
        whole = np.unique(np.searchsorted(ends, unread, side="right") - 1)
        read_size, read = self.encode(texts.take(pa.array(whole)).to_pylist())
        out = []
        for side in (0, 1):
            count = size[side][code]
            of_text = np.concatenate([[0], np.cumsum(count)])[ends]
            ids, per_text = _stretches(flat[side], begin[side][code], count).astype(np.int64), np.diff(of_text)
            if len(whole):
                # What was read piece by piece goes, and what was read whole comes in its place.
                is_whole = np.zeros(len(per_text), dtype=bool)
                is_whole[whole] = True
                kept = ids[~np.repeat(is_whole, per_text)]
                per_text = per_text.copy()
                per_text[whole] = read_size[side]
                ids = np.empty(int(per_text.sum()), dtype=np.int64)
                from_whole = np.repeat(is_whole, per_text)
                ids[from_whole], ids[~from_whole] = read[side], kept
            out += [ids, per_text]
        return tuple(out)


@lru_cache(maxsize=1)
def pair(first: str, second: str) -> Pair:
    """This worker's tokenizers."""
    return Pair(first, second)


keeps("pair", pair.cache_clear)


def overlaps(a_start: np.ndarray, a_text: np.ndarray, b_start: np.ndarray, b_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): all tokens of both sides that share bytes, each pair once. Starts rise from text to text.

    Of two tokens that share bytes, one begins inside the other or with it. So each token's start is joined with the last
    token of the other side, of the same text, that begins there or before; both directions together are all pairs, and
    tokens that begin together come once, from the first.
    """
    a = pd.DataFrame({"start": a_start, "text": a_text, "i": np.arange(len(a_start))})
    b = pd.DataFrame({"start": b_start, "text": b_text, "j": np.arange(len(b_start))})
    into_b = pd.merge_asof(a, b, on="start", by="text")
    into_a = pd.merge_asof(b, a, on="start", by="text")
    into_a = into_a[a_start[into_a["i"].to_numpy()] != into_a["start"].to_numpy()] if len(into_a) else into_a
    return np.concatenate([into_b["i"], into_a["i"]]).astype(np.int64), np.concatenate([into_b["j"], into_a["j"]]).astype(np.int64)


class Aligned:
    """The groups and links of some texts."""

    def __init__(self, texts: pa.Array, codec: Pair):
        a, n_a, b, n_b = codec.tokens(texts)
        self.n_a, self.n_b = n_a, n_b
        number = np.arange(len(n_a))
        a_size, b_size = codec.sizes[0][a], codec.sizes[1][b]
        a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
        a_text, b_text = np.repeat(number, n_a), np.repeat(number, n_b)
        # Both sides spell the same bytes, so one place per byte serves both and rises from text to text.
        i, j = overlaps(a_end - a_size, a_text, b_end - b_size, b_text)
        self.n_overlaps = np.bincount(a_text[i], minlength=len(number))
        together = a_end[i] == b_end[j]
        i, j = np.sort(i[together]), np.sort(j[together])
        self.n_links = np.bincount(a_text[i], minlength=len(number))
        self.links = a[i] << _SECOND | b[j]
        # A token stands behind all tokens of earlier groups; in a group, the first side's come before the second's.
        a_group = np.searchsorted(i, np.arange(len(a)))
        b_group = np.searchsorted(j, np.arange(len(b)))
        order = np.empty(len(a) + len(b), dtype=np.int32)
        a_last, b_last = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        a_last[i], b_last[j] = True, True
        order[np.arange(len(a)) + np.concatenate([[0], j + 1])[a_group]] = 2 * a + a_last
        order[np.arange(len(b)) + (np.append(i, 0)[b_group] + 1)] = codec.b_from + 2 * b + b_last
        ends = np.concatenate([[0], np.cumsum(n_a + n_b)]).astype(np.int32)
        spelled = codec.spelled.take(pa.array(order))
        self.groups = [text[:-1] for text in pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), spelled), "").to_pylist()]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")
_SUMS = ("n_best", "count_sum")


def _runs(column: pa.Array) -> Iterator[pa.Array]:
    """A column without nulls in slices of about RUN_BYTES, whole texts each."""
    sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)) if len(column) else np.zeros(0)
    first = 0
    while first < len(column):
        done = sizes[first - 1] if first else 0
        stop = max(int(np.searchsorted(sizes, done + RUN_BYTES, side="right")), first + 1)
        yield column.slice(first, stop - first)
        first = stop


def align_tokens(
    docs: DataFrame, first: str, second: str, text_col: str = "text", keep: list[str] | None = None, with_groups: bool = False
) -> DataFrame:
    """All columns of `docs` (or those in `keep`), and behind them how two tokenizers cut each text.

    `first` is a byte-level tokenizer's file, `second` a sentence piece model's; both are read with a space before the
    text. New columns (underscores appended where a name is taken): n_a, n_b, tokens of either side; n_groups, of the
    stretches between bytes where tokens of both sides end; n_links, of the pairs of tokens that end together; n_overlaps,
    of those that share bytes; n_best, of the links whose pair of ids is linked as often over all of `docs` as any pair
    with the same second id; count_sum, the sum over the links of how often their pair is linked over all of `docs`;
    groups_sha256 of the groups as `a1,a2|b1;a3|b2,b3`, and with `with_groups` the groups themselves. A text that is
    null, empty, or that either side spells with other bytes has no tokens: zeros and empty texts.

    Tokens are aligned where their text lies. A task counts its pairs of ids in blocks, so a frequent pair is one row per
    block; the counts of all blocks are added up, and each block gets those of its own pairs back: what moves is one row
    per pair and block, and the links of each document as places in its block's list.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    kept = docs.columns if keep is None else keep
    own = {n: free_name(kept, n) for n in (*_COUNTS, "groups_sha256", *_SUMS, "groups")}
    helper = {n: free_name([*kept, *own.values()], n) for n in ("_block", "_slots", "_pairs", "_totals")}
    known = [T.StructField(f.name, f.dataType, True) for f in (docs.schema[n] for n in kept)]
    counts = [T.StructField(own[n], T.LongType()) for n in _COUNTS]
    texts = [T.StructField(own[n], T.StringType()) for n in ("groups_sha256", *(["groups"] if with_groups else []))]
    placed = [T.StructField(helper["_block"], T.LongType()), T.StructField(helper["_slots"], T.ArrayType(T.IntegerType()))]
    lists = [T.StructField(helper[n], T.ArrayType(T.LongType())) for n in ("_pairs", "_totals")]
    schema = T.StructType([*known, *counts, *texts, *placed, *lists])
    at, places = docs.columns.index(text_col), [docs.columns.index(n) for n in kept]
    names = schema.names

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task("pair")
        codec = pair(tokenizer_file(first), tokenizer_file(second))
        block = TaskContext.get().partitionId() << 32
        pairs, slots, totals = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        kinds: list[pa.DataType] = []

        def block_row() -> pa.RecordBatch:
            listed = np.empty_like(pairs)
            listed[slots] = pairs
            empty = [pa.nulls(1, kind) for kind in kinds]
            rest = [pa.nulls(1, pa.int64())] * len(counts) + [pa.nulls(1, pa.string())] * len(texts)
            found = [pa.array([block], pa.int64()), pa.nulls(1, pa.list_(pa.int32())), *(pa.array([x], pa.list_(pa.int64())) for x in (listed, totals))]
            return pa.RecordBatch.from_arrays([*empty, *rest, *found], names=names)

        for batch in batches:
            kinds = [batch.column(k).type for k in places]
            row = 0
            for run in _runs(pc.fill_null(batch.column(at), "")):
                found = Aligned(run, codec)
                new, place, times = np.unique(found.links, return_inverse=True, return_counts=True)
                spot = np.searchsorted(pairs, new)
                here = spot < len(pairs)
                here[here] = pairs[spot[here]] == new[here]
                slot = np.empty(len(new), dtype=np.int64)
                slot[here] = slots[spot[here]]
                slot[~here] = len(pairs) + np.arange(int((~here).sum()))
                pairs, slots = np.insert(pairs, spot[~here], new[~here]), np.insert(slots, spot[~here], slot[~here])
                totals = np.concatenate([totals, np.zeros(len(pairs) - len(totals), dtype=np.int64)])
                totals[slot] += times
                ends = np.concatenate([[0], np.cumsum(found.n_links)]).astype(np.int32)
                linked = pa.ListArray.from_arrays(pa.array(ends), pa.array(slot[place].astype(np.int32)))
                n = len(run)
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups]
                made = [pa.array(x, pa.int64()) for x in (found.n_a, found.n_b, found.n_links, found.n_links, found.n_overlaps)]
                made += [pa.array(x, pa.string()) for x in (digests, *([found.groups] if with_groups else []))]
                made += [pa.array(np.full(n, block)), linked, *[pa.nulls(n, pa.list_(pa.int64()))] * 2]
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(row, n) for k in places], *made], names=names)
                row += n
                if totals.sum() >= BLOCK_LINKS:
                    yield block_row()
                    block, pairs, slots, totals = block + 1, pairs[:0], slots[:0], totals[:0]
        if len(pairs):
            yield block_row()
        release_memory()

    # Written once: the numbers of the blocks and the order of their lists hold from here on, whatever executor is lost.
    aligned = written(docs.mapInArrow(align, schema), "aligned")
    block, slot = F.col(helper["_block"]), F.col(helper["_slots"])
    listed = F.arrays_zip(F.col(helper["_pairs"]).alias("pair"), F.col(helper["_totals"]).alias("n"))
    in_block = aligned.where(F.col(helper["_pairs"]).isNotNull()).select(block.alias("block"), F.posexplode(listed).alias("slot", "x"))
    in_block = in_block.select("block", "slot", "x.pair", "x.n")
    # A second id has as many pairs as the first vocabulary has ids at most.
    best = F.max("total").over(Window.partitionBy(F.col("pair").bitwiseAND((1 << _SECOND) - 1)))
    judged = in_block.groupBy("pair").agg(F.sum("n").alias("total")).select("pair", "total", (F.col("total") == best).alias("best"))
    answers = in_block.select("block", "slot", "pair").join(judged, "pair").select("block", "slot", "total", "best")
    rows = aligned.where(F.col(helper["_pairs"]).isNull())
    out_names = [*kept, *(own[n] for n in _COUNTS), *(own[n] for n in _SUMS), *(f.name for f in texts)]
    given = rows.select(block.alias("block"), F.lit(-1).alias("slot"), F.lit(None).cast("long").alias("total"), F.lit(None).cast("boolean").alias("best"),
        F.struct(*columns([*kept, *(own[n] for n in _COUNTS), *(f.name for f in texts)]), slot.alias(helper["_slots"])).alias("row"))
    stream = given.unionByName(answers.withColumn("row", F.lit(None).cast(given.schema["row"].dataType)))
    # A block's answers come first, then its documents.
    stream = stream.select("block", F.when(F.col("slot") < 0, 2**31 - 1).otherwise(F.col("slot")).alias("slot"), "total", "best", "row")
    stream = stream.repartition("block").sortWithinPartitions("block", "slot")
    sums = [T.StructField(n, T.LongType()) for n in ("_n_best", "_count_sum")]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, best = None, [], []
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if blocks[start] != now:
                    now, total, best = blocks[start], [], []
                part = batch.slice(start, end - start)
                documents = part.column(2).is_null().to_numpy(zero_copy_only=False)
                n = int((~documents).sum())
                if n:
                    total.append(part.column(2).slice(0, n).to_numpy())
                    best.append(part.column(3).slice(0, n).to_numpy(zero_copy_only=False))
                if n == len(part):
                    continue
                total, best = [np.concatenate([np.zeros(0, dtype=np.int64), *total])], [np.concatenate([np.zeros(0, dtype=bool), *best])]
                rows = part.column(4).slice(n)
                lists = rows.field(rows.type.num_fields - 1)
                places = lists.flatten().to_numpy()
                ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
                run = [np.concatenate([[0], np.cumsum(x[places])])[ends] for x in (total[0], best[0].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.field(k) for k in range(rows.type.num_fields - 1)), pa.array(np.diff(run[1]), pa.int64()), pa.array(np.diff(run[0]), pa.int64())],
                    names=[*(f.name for f in rows.type)][:-1] + [f.name for f in sums],
                )
        release_memory()

    done = T.StructType([*known, *counts, *texts, *sums])
    summed = stream.mapInArrow(add_up, done)
    renamed = summed.select(*columns([*kept, *(own[n] for n in _COUNTS)]), *[F.col(f"_{n}").alias(own[n]) for n in _SUMS], *columns([f.name for f in texts]))
    return renamed.select(*columns(out_names))


def link_counts(docs: DataFrame, first: str, second: str, text_col: str = "text") -> DataFrame:
    """(a, b, n): how often each pair of ids is linked over all of `docs`, for training a map between vocabularies."""
    docs = docs.select(F.col(quoted(text_col)).alias("text"))
    bound_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pair(tokenizer_file(first), tokenizer_file(second))
        for batch in batches:
            for run in _runs(pc.fill_null(batch.column(0), "")):
                pairs, n = np.unique(Aligned(run, codec).links, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs >> _SECOND), pa.array(pairs & ((1 << _SECOND) - 1)), pa.array(n)], names=["a", "b", "n"])

    return docs.mapInArrow(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
