"""Removal of passages that stand elsewhere as well, byte for byte, by merging the transforms of anchored suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.llm import textbytes as tb
from classweave.llm.frames import bound_batches, columns, free_name, map_batches, runs_of_groups, written

#: Bytes of a repeated string, and of the grams among which each string's anchor is chosen.
LENGTH, GRAM = 400, 100
#: Window starts that are looked at together; a longer text is looked at in stretches of so many.
RUN_STARTS = 1 << 21
_PLACE_BITS = 22
#: Up to so many different surroundings of a gram are merged byte by byte, more are compared by window hashes.
COMPARED, SALTS = 8192, 16
#: Suffixes that are merged together.
MERGED = 4096


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive keys: the least from the start to a block's end, and from there on."""
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(keys) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one anchor: (text, first window, number of windows, anchor - first window, gram hash, span hash).

    A window's anchor is the leftmost of its grams with the least hash, so windows of equal bytes have it at the same
    place. The span of a run covers all its windows.
    """
    count = len(data) - length + 1
    empty = np.zeros(0, dtype=np.int64)
    if count <= 0:
        return empty, empty, empty, empty, empty, empty
    prefix = tb.prefix_hash(tb.byte_codes(data))
    starts = np.arange(len(data) - gram + 1)
    grams = tb.span_hash(prefix, starts, starts + gram)
    keys = grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS) | starts.astype(np.uint64)
    place = (_window_minima(keys, length - gram + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:count]
    inside = np.arange(count) + length <= offsets[1:][text]
    new = np.ones(count, dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    stop = np.append(np.flatnonzero(new | ~inside), count)
    last = stop[np.searchsorted(stop, first, side="right")]
    anchor = place[first] - first
    spans = tb.span_hash(prefix, first, last - 1 + length)
    return text[first], first - offsets[:-1][text[first]], last - first, anchor, grams[place[first]].view(np.int64), tb.mix(spans + anchor.astype(np.uint64)).view(np.int64)


def _stretches(column: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, offsets, where the stretch begins in its text): runs of whole texts, and of a longer text its parts.

    Consecutive parts overlap, so that each window lies in exactly one.
    """
    for first, _, data, offsets in tb.text_runs(column, RUN_STARTS):
        if len(data) <= 1 << _PLACE_BITS:
            yield first, data, offsets, 0
            continue
        for begin in range(0, max(1, len(data) - length + 1), RUN_STARTS):
            part = data[begin : begin + RUN_STARTS + length - 1]
            yield first, part, np.array([0, len(part)]), begin


_ANCHOR = "print bigint, at bigint, n int, lead int, gram bigint, span bigint"


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets, begin in _stretches(batch.column(2), length):
                text, at, n, lead, grams, spans = anchors(data, offsets, length, gram)
                rows = pa.array(text + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(at + begin), pa.array(n.astype(np.int32)), pa.array(lead.astype(np.int32)), pa.array(grams), pa.array(spans)],
                    names=["doc", "print", "at", "n", "lead", "gram", "span"],
                )

    return run


def _runs(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"s": int(s), "c": int(e - s)} for s, e in zip(edge[::2], edge[1::2])]


def _interleaved(contexts: np.ndarray, ends: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merged order of suffixes within each group, and the common prefix of each with the one before it (-1 in a new group).

    The interleave starts as the groups and is refined four bytes a round: only intervals that still hold several
    suffixes are ordered by their next bytes, and where two part, the round and the first byte that differs give their
    common prefix. Bytes count from 1, and 0 stands behind the end of a suffix, so it equals nothing within another.
    """
    words = contexts.view(">u8")
    order = np.arange(len(group))
    interval = group.copy()
    common = np.where(np.concatenate([[True], group[1:] != group[:-1]]), -1, contexts.shape[1])
    for h in range(words.shape[1]):
        open_ = common > 4 * h  # with the one before
        some = np.flatnonzero(open_ | np.append(open_[1:], False))
        if not len(some):
            break
        word = words[order[some], h].astype(np.uint64)
        new = np.lexsort((word, interval[some]))
        order[some], word = order[some][new], word[new]
        parted = np.flatnonzero(open_[some][1:] & (word[1:] != word[:-1])) + 1
        differ = word[parted] ^ word[parted - 1]
        common[some[parted]] = 4 * h + sum((differ < np.uint64(1 << bits)).astype(np.int64) for bits in (48, 32, 16))
        # Whatever follows a parting is an interval of its own.
        cut = np.zeros(len(group), dtype=np.int64)
        cut[some[parted]] = 1
        interval = interval + np.cumsum(cut)
    common = np.minimum(common, ends[order])
    common[1:] = np.minimum(common[1:], ends[order][:-1])
    return order, common


def _repeated_windows(texts: list[np.ndarray], lead: np.ndarray, n: np.ndarray, group: np.ndarray, length: int) -> list[np.ndarray]:
    """For each anchored stretch of its group: which of its windows lie in another one too.

    The suffixes that begin at the anchors are merged by refining their interleave. Then the intervals are extended to
    the left, as a Burrows-Wheeler transform does it: the byte before each suffix parts its interval, stably, and the
    common prefix of new neighbours is the least over what stood between them. With d bytes before the anchor equal
    within an interval, a window that begins there is repeated if a neighbour shares the other `length` - d bytes.
    """
    m = len(texts)
    ends = np.array([len(t) for t in texts]) - lead
    right = np.zeros((m, -(-length // 4) * 4), dtype=">u2")
    left = np.zeros((m, int(lead.max()) + 1), dtype=np.uint8)
    for k, t in enumerate(texts):
        right[k, : min(length, ends[k])] = t[lead[k] : lead[k] + length].astype(np.uint16) + 1
        left[k, : lead[k]] = t[: lead[k]][::-1]
    order, common = _interleaved(right, np.minimum(ends, length), group)
    interval = group[order]
    first = np.cumsum(n) - n
    flags = np.zeros(int(n.sum()), dtype=bool)
    for d in range(left.shape[1]):
        # Whatever has no d bytes before it, or stands alone, is done.
        keep = lead[order] >= d
        same = interval[1:] == interval[:-1]
        keep &= np.concatenate([[False], same]) | np.append(same, False)
        if not keep.all():
            order, interval, common = _picked(np.flatnonzero(keep), order, interval, common)
        if not len(order):
            break
        best = np.maximum(common, np.append(common[1:], -1))
        k = lead[order] - d
        hit = (best >= length - d) & (k < n[order])
        flags[first[order[hit]] + k[hit]] = True
        byte = left[order, d]
        same = interval[1:] == interval[:-1]
        if (same & (byte[1:] != byte[:-1])).any():
            new = np.lexsort((byte, interval))
            byte = byte[new]
            order, interval, common = _picked(new, order, interval, common)
            interval = np.cumsum(np.concatenate([[0], (interval[1:] != interval[:-1]) | (byte[1:] != byte[:-1])]))
            common[np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]]))] = -1
    return np.split(flags, first[1:])


def _picked(at: np.ndarray, order: np.ndarray, interval: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes at these places, in this order; the common prefix of neighbours is the least between their old places."""
    if not len(at):
        return order[:0], interval[:0], common[:0]
    low, high = np.minimum(at[:-1], at[1:]) + 1, np.maximum(at[:-1], at[1:]) + 1
    pairs = np.stack([low, high], 1).ravel()
    least = np.minimum.reduceat(np.append(common, -1), pairs)[::2] if len(pairs) else np.zeros(0, dtype=common.dtype)
    interval = interval[at]
    return order[at], interval, np.where(np.concatenate([[False], interval[1:] == interval[:-1]]), np.concatenate([[-1], least]), -1)


def _merge(length: int):
    """Of each gram's group: which windows of its single surroundings also lie in another of the group."""

    def flagged(groups: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(groups)
        grams, spans, cnt = (table.column(c).to_pylist() for c in ("gram", "span", "cnt"))
        texts = [np.frombuffer(x, dtype=np.uint8) for x in table.column("bytes").to_pylist()]
        group = np.repeat(np.arange(len(groups)), [g.num_rows for g in groups])
        flags = _repeated_windows(texts, table.column("lead").to_numpy().astype(np.int64), table.column("n").to_numpy().astype(np.int64), group, length)
        out = [(g, s, _runs(f)) for g, s, c, f in zip(grams, spans, cnt, flags) if c == 1 and f.any()]
        if out:
            yield _flag_batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[pa.Table] = []
        for group in runs_of_groups(batches, 1):
            groups.append(group)
            if sum(g.num_rows for g in groups) >= MERGED:
                yield from flagged(groups)
                groups = []
        if groups:
            yield from flagged(groups)

    return run


_RUN = pa.list_(pa.struct([("s", pa.int32()), ("c", pa.int32())]))
_FLAG = "gram bigint, span bigint, runs array<struct<s:int,c:int>>"


def _flag_batch(rows: list[tuple]) -> pa.RecordBatch:
    grams, spans, runs = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(grams, pa.int64()), pa.array(spans, pa.int64()), pa.array(runs, _RUN)], names=["gram", "span", "runs"])


def _cut_spans(length: int):
    """The bytes around each asked anchor, from the text of the document that represents it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(0)[row].as_buffer().to_pybytes() if batch.column(0)[row].is_valid else b""
                asked = batch.column(1)[row].values
                fields = {f: asked.field(f) for f in ("gram", "span", "cnt", "n", "lead", "classes")}
                pieces = [text[at : at + n - 1 + length] for at, n in zip(asked.field("at").to_pylist(), fields["n"].to_pylist())]
                yield pa.RecordBatch.from_arrays([*fields.values(), pa.array(pieces, pa.binary())], names=[*fields, "bytes"])

    return run


def _flags_of_large(spans: DataFrame, length: int) -> DataFrame:
    """The same for groups of any size: windows are counted by hash, combined within tasks first, and looked up salted."""
    place = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    each = spans.select("gram", "span", "cnt", "lead", "bytes", place.alias("k"))
    window = F.expr(f"substring(bytes, k + 1, {length})")
    each = each.select("gram", "span", "cnt", "k", (F.col("lead") - F.col("k")).alias("before"), F.xxhash64(window).alias("h"), F.xxhash64(window, F.lit(1)).alias("h2"))
    key = ["gram", "before", "h", "h2"]
    repeated = each.groupBy(*key).agg(F.count("*").alias("c")).where("c > 1").select(*key, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = each.where("cnt = 1").withColumn("salt", F.pmod("span", F.lit(SALTS)).cast("int"))
    places = salted.join(repeated, [*key, "salt"], "left_semi").groupBy("gram", "span").agg(F.sort_array(F.collect_list("k")).alias("k"))
    return places.select("gram", "span", F.expr("transform(k, x -> struct(x AS s, 1 AS c))").alias("runs"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, print, places): for each document, by id and fingerprint of its text, the runs of windows that also start elsewhere.

    Every window of `length` bytes is represented by its anchor gram. Anchors whose gram occurs once are done; runs of
    windows whose whole surroundings occur twice are repeated throughout; only where one gram has different surroundings
    are these, as suffixes that begin at the gram, merged like Burrows-Wheeler transforms: refining their interleave
    gives their common prefixes, extending intervals to the left gives the windows that several of them hold.

    No transform of all suffixes is built: merging those takes a round per byte of `length`, over all bytes, which was
    measured at more than ten times the time of everything here. Of grams with more than `COMPARED` surroundings the
    windows are compared by two hashes instead. All three ways give the same windows.
    """
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("print"), F.col(text_col).alias("text"))
    schema = T.StructType([slim.schema["doc"], *T._parse_datatype_string(_ANCHOR).fields])
    found = written(slim.mapInArrow(_anchor_rows(length, gram), schema), "anchors")
    classes = found.groupBy("gram", "span", "n", "lead").agg(F.count("*").alias("cnt"), F.min(F.struct("doc", "print", "at")).alias("one"))
    per_gram = classes.groupBy("gram").agg(F.count("*").alias("classes"), F.sum("cnt").alias("total")).where("total > 1").drop("total")
    classes = written(classes.join(per_gram, "gram"), "classes")
    whole = classes.where("cnt > 1").select("gram", "span", F.expr("array(struct(0 AS s, n AS c))").alias("runs"))

    asked = classes.where("classes > 1").groupBy("one.doc", "one.print").agg(F.collect_list(F.struct("one.at", "gram", "span", "cnt", "n", "lead", "classes")).alias("asked"))
    asked = asked.select(F.col("doc").alias("d"), F.col("print").alias("p"), "asked")
    reps = slim.join(asked.hint("shuffle_hash"), F.col("doc").eqNullSafe(F.col("d")) & (F.col("print") == F.col("p"))).select(F.col("text").cast("binary").alias("text"), "asked")
    spans = reps.mapInArrow(_cut_spans(length), "gram bigint, span bigint, cnt bigint, n int, lead int, classes bigint, bytes binary")
    spans = written(spans, "spans")  # a document that stands twice cuts its spans twice
    small = spans.where(F.col("classes") <= COMPARED).dropDuplicates(["gram", "span"]).select("gram", "span", "cnt", "n", "lead", "bytes")
    merged = small.repartition("gram").sortWithinPartitions("gram").mapInArrow(_merge(length), _FLAG)
    counted = _flags_of_large(spans.where(F.col("classes") > COMPARED).dropDuplicates(["gram", "span"]), length)
    flags = whole.unionByName(merged).unionByName(counted)
    return found.join(flags, ["gram", "span"]).groupBy("doc", "print").agg(F.collect_list(F.struct("at", "runs")).alias("places"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """All columns of `docs`, and behind them what is left of each text (underscores appended where a name is taken).

    Each byte covered by a string of `length` bytes that also starts anywhere else, in the same text or another, goes;
    matches overlap, but never cross texts, and are judged on the input. New columns: n_bytes and n_removed, long;
    n_spans, the number of maximal removed runs; kept, the bytes that remain, which need not be valid UTF-8. A text
    shorter than `length`, empty or null stays. Rows equal in id and text are copies of each other like any others; ids
    may be null or repeated. An empty table gives an empty one.
    """
    if not 8 <= gram <= length:
        raise ValueError("the gram must fit into the repeated string")
    names = {n: free_name(docs.columns, n) for n in ("n_bytes", "n_removed", "n_spans", "kept")}
    key, places, own_doc, own_print = (free_name(docs.columns, n) for n in ("_print", "_places", "_doc", "_found"))
    found = repeated_spans(docs, id_col, text_col, length, gram).select(F.col("doc").alias(own_doc), F.col("print").alias(own_print), F.col("places").alias(places))
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    both = keyed.join(found, F.col(id_col).eqNullSafe(F.col(own_doc)) & (F.col(key) == F.col(own_print)), "left").select(*columns(docs.columns), places)
    at, where = docs.columns.index(text_col), len(docs.columns)
    fields = [T.StructField(names[n], T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [T.StructField(names["kept"], T.BinaryType())]

    def cut(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out: dict[str, list] = {n: [] for n in names}
        for text, marks in zip(batch.column(at), batch.column(where)):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            removed = spans = 0
            if marks.is_valid:
                change = np.zeros(len(data) + 1, dtype=np.int32)
                place = marks.values
                run = place.field("runs")
                begin = np.repeat(place.field("at").to_numpy(), np.diff(run.offsets.to_numpy())) + run.flatten().field("s").to_numpy()
                np.add.at(change, begin, 1)
                np.add.at(change, begin + run.flatten().field("c").to_numpy() - 1 + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                removed, spans = int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
                left = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
            else:
                left = data
            for n, value in zip(names, (len(data), removed, spans, left)):
                out[n].append(value)
        return {names[n]: pa.array(v, pa.binary() if n == "kept" else pa.int64()) for n, v in out.items()}

    return map_batches(both, cut, fields, docs.columns)
