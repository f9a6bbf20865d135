"""N-gram Jaccard join: chosen paths through sampled shared tokens lead similar sets into the same small buckets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.llm import textbytes as tb
from classweave.llm.components import components
from classweave.llm.frames import begin_task, bound_batches, columns, free_name, release_memory, runs_of_groups, written

SHINGLE_WORDS = 5
#: The similarity as a fraction, so that the comparison is exact.
SIMILARITY = (4, 5)
#: Runs are repeated until a pair at the threshold is met with at least this probability.
TARGET_RECALL = 0.99999
#: Sampled tokens per set (minima of as many hash functions); a bucket's path says which of them split it.
TOKENS = 64
#: Branches per split, deepest split, largest bucket that is compared whole, and the mean similarity from which splitting is no use.
BRANCHES, DEPTH, BUCKET, DENSE = 3, 4, 128, 0.25
#: Blocks of a larger bucket: up to 7 of at least `BUCKET` sets, more only, with at most so many sets and tokens each.
BLOCKS, BLOCK_SETS, BLOCK_TOKENS = 7, 2048, 1 << 21
#: Rows of a component that meet its smallest id in one task are dealt out over so many.
SALTS = 16

_MULTIPLIER = tb.mix(np.arange(1, TOKENS + 1, dtype=np.uint64)) | np.uint64(1)
_ADDEND = tb.mix(np.arange(1001, TOKENS + 1001, dtype=np.uint64))


def runs_needed(target: float = TARGET_RECALL, similarity: tuple[int, int] = SIMILARITY, branches: int = BRANCHES, splits: int = 2) -> int:
    """Runs until a pair at the threshold shares a bucket with probability `target`, if its bucket is split `splits` times a run."""
    s = similarity[0] / similarity[1]
    met = s * (1 - (1 - s) ** branches) ** splits
    return math.ceil(math.log(1 - target) / math.log(1 - met))


def least_equal(target: float = TARGET_RECALL, similarity: tuple[int, int] = SIMILARITY, tokens: int = TOKENS) -> int:
    """Equal sampled tokens below which a pair is ruled out: one at the threshold has fewer with a tenth of the chance of a loss that `target` leaves.

    The tokens are equal independently, each with the similarity as its chance. All runs see the same ones, so what they
    rule out stays lost.
    """
    s, below = similarity[0] / similarity[1], 0.0
    for m in range(tokens + 1):
        below += math.comb(tokens, m) * s**m * (1 - s) ** (tokens - m)
        if below > (1 - target) / 10:
            return m
    return tokens


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin. Fewer words than n, but not none, are one shingle."""
    starts, ends, first = tb.word_spans(data, offsets)
    words = tb.word_hashes(data, starts, ends)
    values, owners = [], []
    at, text = tb.windows_within(first, n)
    values.append(tb.window_hash(words, n)[at])
    owners.append(text)
    counts = np.diff(first)
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        if len(short):
            values.append(tb.window_hash(words, size)[first[short]])
            owners.append(short)
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(offsets)))


def _sketches(column: pa.Array) -> dict[str, pa.Array]:
    """Of each text with words: its row, the key of its shingle set, the set's size, and its sampled tokens."""
    rows, keys, sizes, tokens = [], [], [], []
    for first, _, data, offsets in tb.text_runs(column):
        values, begin = shingle_sets(data, offsets)
        n = np.diff(begin)
        some = np.flatnonzero(n)
        if not len(some):
            continue
        at = begin[some]
        total = np.add.reduceat(tb.mix(values ^ np.uint64(0xA0761D6478BD642F)), at)
        sketch = np.empty((len(some), TOKENS), dtype="<u4")
        for k in range(TOKENS):
            sketch[:, k] = np.minimum.reduceat(values * _MULTIPLIER[k] + _ADDEND[k], at) >> np.uint64(32)
        rows.append(some + first)
        keys.append(tb.mix(total + n[some].astype(np.uint64)).view(np.int64))
        sizes.append(n[some])
        tokens += [row.tobytes() for row in sketch]
    join = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
    return {"rows": pa.array(join(rows)), "key": pa.array(join(keys), pa.int64()), "n": pa.array(join(sizes), pa.int64()), "tokens": pa.array(tokens, pa.binary())}


def _token(path: Column, branch: int) -> Column:
    """The sampled token that splits the bucket of this path in this branch."""
    at = F.pmod(F.xxhash64(path, F.lit(branch)), F.lit(TOKENS)).cast("int")
    return F.substring(F.col("tokens"), at * 4 + 1, F.lit(4))


def _sized(entries: DataFrame) -> DataFrame:
    """(key, n, path, sets, total): the entries of buckets with two sets or more, with how many sets and shingles are in each."""
    sizes = entries.groupBy("path").agg(F.count("*").alias("sets"), F.sum("n").alias("total")).where("sets > 1")
    return entries.join(sizes, "path")


def _leaves(classes: DataFrame, runs: int) -> DataFrame:
    """(key, leaf, sets, total): the final buckets of all runs.

    A run's first token puts each set into one bucket. A bucket of more than `BUCKET` sets is split on further tokens,
    several branches at a time, unless its sets are alike on average: then splitting would only repeat it.
    """
    first = [F.xxhash64(F.lit(r), F.substring("tokens", 4 * r + 1, 4)) for r in range(runs)]
    level = written(_sized(classes.select("key", "n", F.explode(F.array(*first)).alias("path"))), "paths")
    done = [level.where(F.col("sets") <= BUCKET)]
    for depth in range(DEPTH + 1):
        large = level.where(F.col("sets") > BUCKET)
        if large.isEmpty():
            break
        if depth == DEPTH:
            done.append(large)
            break
        own = large.join(classes.select("key", "tokens"), "key")
        branch = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.xxhash64("path", F.lit(j), _token(F.col("path"), j)).alias("child")) for j in range(BRANCHES)]))
        split = written(own.select("key", "n", "path", "sets", branch.alias("b")).select("key", "n", "path", "sets", "b.child"), "split")
        inner = split.groupBy("path", "sets", "child").agg(F.count("*").alias("c"))
        alike = inner.groupBy("path", "sets").agg((F.sum(F.col("c") * (F.col("c") - 1)) / (BRANCHES * F.first("sets") * (F.first("sets") - 1))).alias("alike"))
        dense = alike.where(F.col("alike") >= DENSE).select("path")
        done.append(large.join(dense, "path", "left_semi"))
        level = written(_sized(split.join(dense, "path", "left_anti").select("key", "n", F.col("child").alias("path"))), "paths")
        done.append(level.where(F.col("sets") <= BUCKET))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("key", F.col("path").alias("leaf"), "sets", "total")


def _blocked(leaves: DataFrame) -> DataFrame:
    """Entries with `lo` and `hi`: every two blocks of a large bucket meet in one group; a small bucket is one group."""
    wanted = F.least(F.ceil(F.col("sets") / BUCKET), F.greatest(F.lit(BLOCKS), F.ceil(F.col("sets") / BLOCK_SETS)))
    blocks = F.when(F.col("sets") <= BUCKET, F.ceil(F.col("total") / BLOCK_TOKENS)).otherwise(F.greatest(wanted, F.ceil(F.col("total") / BLOCK_TOKENS))).cast("int")
    own = F.pmod(F.xxhash64("key", F.lit(17)), F.col("blocks")).cast("int")
    numbered = leaves.withColumn("blocks", blocks).withColumn("own", own)
    return numbered.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "leaf", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "key"
    )


def _plausible(table: pa.Table, similarity: tuple[int, int], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the group's pairs that the sampled tokens don't rule out and that meet first in this bucket."""
    m = table.num_rows
    sketch = np.frombuffer(b"".join(table.column("tokens").to_pylist()), dtype="<u4").reshape(m, TOKENS)
    size = table.column("n").to_numpy()
    own = table.column("own").to_numpy()
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    left = np.arange(m) if lo == hi else np.flatnonzero(own == lo)
    right = np.arange(m) if lo == hi else np.flatnonzero(own == hi)
    num, den = similarity
    out_i, out_j = [], []
    for begin in range(0, len(left), 256):
        i = left[begin : begin + 256]
        equal = np.zeros((len(i), len(right)), dtype=np.uint8)
        for k in range(TOKENS):
            equal += sketch[i, k][:, None] == sketch[right, k][None, :]
        a, b = np.nonzero((equal >= least) & (den * np.minimum(size[i][:, None], size[right][None, :]) >= num * np.maximum(size[i][:, None], size[right][None, :])))
        a, b = i[a], right[b]
        if lo == hi:
            a, b = a[a < b], b[a < b]
        out_i.append(a)
        out_j.append(b)
    a, b = np.concatenate(out_i), np.concatenate(out_j)
    if not len(a):
        return a, b
    here = table.column("leaf")[0].as_py()
    lists = table.column("leaves").to_pylist()
    width = max(map(len, lists))
    paths = np.full((m, width), np.iinfo(np.int64).max)
    for k, x in enumerate(lists):
        paths[k, : len(x)] = x
    first = np.ones(len(a), dtype=bool)
    step = max(1, (1 << 22) // (width * width))
    for begin in range(0, len(a), step):
        x, y = paths[a[begin : begin + step]], paths[b[begin : begin + step]]
        shared = (x[:, :, None] == y[:, None, :]).any(axis=2)
        first[begin : begin + step] = np.where(shared, x, np.iinfo(np.int64).max).min(axis=1) == here
    return a[first], b[first]


def _shared_counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (a, b)."""
    if len(a) <= 64:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a.tolist(), b.tolist())], dtype=np.int64)
    # Many pairs: products of the incidence matrix of those shingles that two sets or more have, some columns at a time.
    rows, left = np.unique(a, return_inverse=True)
    columns, right = np.unique(b, return_inverse=True)
    used = np.union1d(rows, columns)
    value = np.concatenate([sets[i] for i in used])
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    begin = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    count = np.diff(np.concatenate([begin, [len(value)]]))
    column = np.repeat(np.where(count > 1, np.cumsum(count > 1) - 1, -1), count)
    owner, column = owner[column >= 0], column[column >= 0]
    total = np.zeros((len(rows), len(columns)), dtype=np.float32)
    at_row, at_column = np.searchsorted(used, rows), np.searchsorted(used, columns)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 1024):
        part = slice(*np.searchsorted(column, [low, low + 1024]))
        incidence = np.zeros((len(used), 1024), dtype=np.float32)
        incidence[owner[part], column[part] - low] = 1
        total += incidence[at_row] @ incidence[at_column].T
    return total[left, right].astype(np.int64)


def _roots(m: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member that each of m members is connected to by the pairs."""
    root = np.arange(m)
    while True:
        new = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


_ENTRY = ["leaf", "lo", "hi", "own", "key", "n", "weight", "tokens", "leaves"]


def _screen(similarity: tuple[int, int], least: int):
    """Of each group the entries that have a plausible partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of_groups(batches, 3):
            if group.num_rows > 1:
                a, b = _plausible(group, similarity, least)
                if len(a):
                    yield from group.take(pa.array(np.union1d(a, b))).combine_chunks().to_batches()
        release_memory()

    return run


def _verify(similarity: tuple[int, int], least: int):
    """Of each group the entries with a true partner: (key, linked documents, smallest key connected to it in the group)."""
    num, den = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of_groups(batches, 3):
            a, b = _plausible(group, similarity, least)
            if not len(a):
                continue
            sets = [np.frombuffer(x, dtype="<u8") for x in group.column("shingles").to_pylist()]
            size = np.array([len(x) for x in sets])
            both = _shared_counts(sets, a, b)
            linked = den * both >= num * (size[a] + size[b] - both)
            a, b = a[linked], b[linked]
            if not len(a):
                continue
            weight = group.column("weight").to_numpy()
            links = np.bincount(a, weights=weight[b], minlength=len(size)) + np.bincount(b, weights=weight[a], minlength=len(size))
            keys = group.column("key").to_numpy()
            root = _roots(len(size), a, b)
            some = np.union1d(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(links[some].astype(np.int64)), pa.array(keys[root[some]])], names=["key", "links", "root"])
        release_memory()

    return run


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: tuple[int, int] = SIMILARITY, target_recall: float = TARGET_RECALL) -> DataFrame:
    """All columns of `docs`, and behind them class_id, n_links, component_id and kept (underscores appended where a name is taken).

    Texts are sets of their five-word shingles, A-Z lower-cased; a link is a Jaccard similarity of at least `similarity`.
    Equal sets are one class from the start, with a weight, so copies are never compared. class_id is the smallest id in
    the class; n_links counts the other documents that a document is linked with, copies included; component_id is the
    smallest id reachable over links, and kept is true for one document of each component, the one with that id.

    Paths of sampled tokens lead similar sets into common buckets; `runs_needed` runs meet a pair at the threshold with
    probability `target_recall`, others more surely. Sampled tokens rule out most pairs of a bucket (`least_equal` bounds
    the loss by a tenth of what the recall leaves), the sets themselves decide the rest, and a pair counts only in the first bucket that both share. Large buckets of alike sets are compared
    block by block. Pairs are counted where they meet and never sent on.

    A text without words, or a null one, is in a class and component of its own and is kept. Rows that share an id are
    documents of their own; of those that tie for the smallest id of a component, the first by text is kept, and rows
    equal in id and text are kept together. A document without an id counts as a document, and is kept if it stands alone
    or its component has no id at all. An empty table gives an empty one.
    """
    runs, least = runs_needed(target_recall, similarity), least_equal(target_recall, similarity)
    if runs > TOKENS:
        raise ValueError("such a recall needs more runs than there are sampled tokens")
    bound_batches(docs.sparkSession)
    names = [free_name(docs.columns, n) for n in ("class_id", "n_links", "component_id", "kept")]
    id_type = docs.schema[id_col].dataType
    slim = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("print"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc", id_type), T.StructField("print", T.LongType()), T.StructField("key", T.LongType()), T.StructField("n", T.LongType()), T.StructField("tokens", T.BinaryType())])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            made = _sketches(batch.column(2))
            rows = made.pop("rows")
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *made.values()], names=schema.names)
        release_memory()

    members = written(slim.mapInArrow(sketch, schema), "members")
    classes = written(members.groupBy("key", "n", "tokens").agg(F.count("*").alias("weight"), F.min("doc").alias("class")), "classes")
    leaves = written(_leaves(classes, runs), "leaves")
    lists = leaves.groupBy("key").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    entries = _blocked(leaves).join(classes.select("key", "n", "weight", "tokens").join(lists, "key"), "key").select(*_ENTRY)
    order = ["leaf", "lo", "hi"]
    screened = written(entries.repartition(*order).sortWithinPartitions(*order).mapInArrow(_screen(similarity, least), entries.schema), "screened")

    # The shingles of the classes that are still in question, from the text of one member each.
    asked = screened.select("key").distinct()
    reader = members.join(asked, "key", "left_semi").groupBy("key").agg(F.min(F.struct("doc", "print")).alias("one")).select("key", F.col("one.doc").alias("d"), F.col("one.print").alias("p"))
    texts = slim.join(reader.hint("shuffle_hash"), F.col("doc").eqNullSafe(F.col("d")) & (F.col("print") == F.col("p"))).select("key", "text")

    def read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in tb.text_runs(batch.column(1)):
                values, begin = shingle_sets(data, offsets)
                sets = [values[s:e].astype("<u8").tobytes() for s, e in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(sets, pa.binary())], names=["key", "shingles"])
        release_memory()

    sets = written(texts.mapInArrow(read_sets, "key bigint, shingles binary").dropDuplicates(["key"]), "sets")
    with_sets = screened.join(sets, "key").select(*_ENTRY, "shingles")
    found = written(with_sets.repartition(*order).sortWithinPartitions(*order).mapInArrow(_verify(similarity, least), "key bigint, links bigint, root bigint"), "links")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(found.where("key != root").select("key", "root"), "key", "root")

    judged = classes.join(links, "key", "left").join(groups.withColumnRenamed("node", "key"), "key", "left")
    judged = judged.select("key", "class", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "key").alias("component"))
    # Most classes are alone in their component. The others are dealt out, as one component may hold very many of them.
    judged = written(judged, "judged")
    salt = F.pmod("key", F.lit(SALTS)).cast("int")
    together = judged.join(groups.select(F.col("node").alias("key")), "key", "left_semi").withColumn("salt", salt)
    first = together.groupBy("component", "salt").agg(F.min("class").alias("first")).groupBy("component").agg(F.min("first").alias("first"))
    first = first.select("component", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    together = together.join(first, ["component", "salt"]).select("key", "class", "links", "component", "first")
    alone = judged.join(groups.select(F.col("node").alias("key")), "key", "left_anti").select("key", "class", "links", "component", F.col("class").alias("first"))
    judged = alone.unionAll(together)
    # Of several rows with the first id, the one with the smallest fingerprint stays.
    per_doc = written(members.select("doc", "print", "key").distinct().join(judged, "key"), "judged")
    key, own_doc, own_print = (free_name(docs.columns, n) for n in ("_fingerprint", "_doc", "_print"))
    stays = per_doc.where(F.col("doc").eqNullSafe(F.col("first"))).groupBy("component").agg(F.min("print").alias("stays"))
    spread = stays.select("component", "stays", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    per_doc = per_doc.withColumn("salt", F.pmod("print", F.lit(SALTS)).cast("int")).join(spread, ["component", "salt"]).select(
        F.col("doc").alias(own_doc), F.col("print").alias(own_print), F.col("class").alias(names[0]), F.col("links").alias(names[1]), F.col("first").alias(names[2]),
        (F.col("doc").eqNullSafe(F.col("first")) & (F.col("print") == F.col("stays"))).alias(names[3]),
    )
    out = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))).join(per_doc, F.col(id_col).eqNullSafe(F.col(own_doc)) & (F.col(key) == F.col(own_print)), "left")
    return out.select(
        *columns(docs.columns), F.coalesce(names[0], id_col).alias(names[0]), F.coalesce(names[1], F.lit(0)).cast("long").alias(names[1]),
        F.coalesce(names[2], id_col).alias(names[2]), F.coalesce(names[3], F.lit(True)).alias(names[3]),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: bool = True, **options) -> DataFrame:
    """`docs` with one document of each component. Same columns.

    Rows equal in id and text stay together, or, without `repeats`, a single one of them stays; a text without words
    then stays once per id as well.
    """
    judged = similar_documents(docs, id_col, text_col, **options)
    kept = judged.where(F.col(judged.columns[-1])).select(*columns(docs.columns))
    if repeats:
        return kept
    key, own_id, own_key, rows = (free_name(docs.columns, n) for n in ("_fingerprint", "_id", "_own", "_rows"))
    print_of = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    # Counted within each task first; only rows that are there more than once are grouped.
    counts = docs.select(F.col(id_col).alias(own_id), print_of.alias(own_key)).groupBy(own_id, own_key).agg(F.count("*").alias(rows)).where(F.col(rows) > 1)
    counts = written(counts, "repeats")
    if counts.isEmpty():
        return kept
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key))
    keyed = kept.withColumn(key, print_of)
    once = keyed.join(counts, same, "left_anti")
    several = keyed.join(counts, same, "left_semi").dropDuplicates([id_col, key])
    return once.unionAll(several).select(*columns(docs.columns))
