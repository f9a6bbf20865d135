"""Embedding near-duplicates by NN-descent: a neighbour graph refined through neighbours of neighbours."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.llm.components import components
from classweave.llm.frames import bound_batches, columns, free_name, runs_of_groups, written

COSINE = 0.95
#: Length of the neighbour lists, forest of first buckets, vectors per bucket, and the most that are compared in one group.
NEIGHBOURS, TABLES, BUCKET, GROUP = 12, 10, 64, 256
#: Rounds of refinement at most; they end when fewer than this share of the lists' places change.
ROUNDS, CHANGED = 4, 0.002
#: Neighbours of a full list through which it is enlarged.
PIVOTS = 8
#: Chance that a pair at the threshold shares a first bucket: as many tables as it takes, `TABLES` at a time.
MET = 0.985
#: Vectors whose links are found by brute force to audit the graph: some with more links than a list is long, more of the others.
AUDITED = (256, 1024)
#: The recall below which the graph is built further, from so many forests at most.
RECALL, AUDITS = 0.995, 8

# Vectors of length 1 as 16-bit integers: their products are exact, and a cosine is known to a few ten-thousandths.
_UNIT = 8192
_SLACK = 0.002


def _unit_vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, vector of length 1) for the rows that have one: no null, not all zero, all components finite."""
    for row in range(len(column)):
        value = column[row]
        if not value.is_valid or value.values.null_count:
            continue
        x = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
        largest = np.abs(x).max() if len(x) else 0.0
        if not np.isfinite(largest) or largest == 0 or not np.isfinite(x).all():
            continue
        x = x / largest
        yield row, x / np.sqrt(x @ x)


def _vector_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, keys, vectors, codes = [], [], [], []
        for row, x in _unit_vectors(batch.column(2)):
            rows.append(row)
            vectors.append(x.astype("<f8").tobytes())
            keys.append(int.from_bytes(hashlib.blake2b(vectors[-1], digest_size=8).digest(), "little", signed=True))
            codes.append(np.rint(x * _UNIT).astype("<i2").tobytes())
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(keys, pa.int64()), pa.array(vectors, pa.binary()), pa.array(codes, pa.binary())], names=["id", "mark", "key", "vector", "code"]
        )


def _matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1).astype(np.float64)


def _first_buckets(tables: int, bits: int, seed: int):
    """(table, bucket) of each vector: on which side of random hyperplanes it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            codes = [np.frombuffer(c, dtype="<i2").astype(np.float64) for c in batch.column(1).to_pylist()]
            buckets = []
            for x in codes:
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng([seed, len(x)]).standard_normal((len(x), tables * bits))
                side = (x @ planes[len(x)] > 0).reshape(tables, bits)
                buckets.append((side @ (1 << np.arange(bits)) * 65537 + len(x)).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(buckets, pa.list_(pa.int64()))], names=["key", "code", "buckets"])

    return run


_LIST = "key bigint, list array<struct<dot:int,id:bigint>>"
_LIST_TYPE = pa.list_(pa.struct([("dot", pa.int32()), ("id", pa.int64())]))


def _best_within(size: int):
    """Of each group: every member's best partners that beat what it has; (key, list)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_keys: list[np.ndarray] = []
        out_ids: list[np.ndarray] = []
        out_dots: list[np.ndarray] = []
        out_sizes: list[np.ndarray] = []

        def made() -> pa.RecordBatch:
            dots, ids = np.concatenate(out_dots).astype(np.int32), np.concatenate(out_ids)
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(out_sizes))]).astype(np.int32)
            entries = pa.StructArray.from_arrays([pa.array(dots), pa.array(ids)], names=["dot", "id"])
            lists = pa.ListArray.from_arrays(pa.array(offsets), entries)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_keys)), lists.cast(_LIST_TYPE)], names=["key", "list"])

        for group in runs_of_groups(batches, 2):
            m = group.num_rows
            if m < 2:
                continue
            keys, worst = group.column("key").to_numpy(), group.column("worst").to_numpy()
            x = _matrix(group.column("code"), "<i2")
            dots = x @ x.T
            np.fill_diagonal(dots, -np.inf)
            dots[dots <= worst[:, None]] = -np.inf
            k = min(size, m - 1)
            top = np.argpartition(-dots, k - 1, axis=1)[:, :k] if k < m - 1 else np.argsort(-dots, axis=1)[:, :k]
            found = np.take_along_axis(dots, top, axis=1)
            real = np.isfinite(found)
            counts = real.sum(axis=1)
            some = counts > 0
            out_keys.append(keys[some])
            out_sizes.append(counts[some])
            out_ids.append(keys[top[real]])
            out_dots.append(found[real])
            if sum(map(len, out_keys)) >= 4096:
                yield made()
                for x in (out_keys, out_ids, out_dots, out_sizes):
                    x.clear()
        if out_keys:
            yield made()

    return run


def _merged(lists: DataFrame, size: int) -> DataFrame:
    """One list per vector: the best `size` distinct entries of all its lists."""
    flat = F.flatten(F.collect_list("list"))
    return lists.groupBy("key").agg(F.slice(F.sort_array(F.array_distinct(flat), asc=False), 1, size).alias("list"))


def _worst(size: int) -> Column:
    """The product that a new entry must exceed."""
    return F.when(F.size("list") >= size, F.element_at("list", -1)["dot"]).otherwise(F.lit(-(1 << 30)))


def _bits(n: int) -> int:
    """Hyperplanes per table, so that a bucket has about `BUCKET` of n vectors."""
    return max(1, min(40, round(math.log2(max(2, n / BUCKET)))))


def tables_needed(bits: int, cosine: float = COSINE, met: float = MET) -> int:
    """Tables until a pair at the threshold shares a first bucket with probability `met`."""
    once = max(1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi, 0.5) ** bits
    return max(TABLES, math.ceil(math.log(1 - met) / math.log1p(-once))) if once < 1 else TABLES


def _forest(nodes: DataFrame, lists: DataFrame | None, tables: int, bits: int, seed: int) -> DataFrame:
    """Neighbour lists from random buckets; of a large bucket, parts are compared within."""
    schema = T.StructType([nodes.schema["key"], nodes.schema["code"], T.StructField("buckets", T.ArrayType(T.LongType()))])
    placed = nodes.select("key", "code").mapInArrow(_first_buckets(tables, bits, seed), schema)
    each = placed.select("key", "code", F.posexplode("buckets").alias("t", "b")).select("key", "code", F.xxhash64("t", "b", F.lit(seed)).alias("bucket"))
    return _compared(each, GROUP, lists, seed)


def _compared(members: DataFrame, size: int, lists: DataFrame | None, seed: int) -> DataFrame:
    """Lists from comparing all members of each bucket; one with more than `size` is dealt out into parts by hash, by another one for each seed."""
    members = written(members, "members")
    sizes = members.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    parts = members.join(sizes, "bucket").withColumn("part", F.pmod(F.xxhash64("key", "bucket", F.lit(seed)), F.ceil(F.col("c") / size)).cast("int"))
    if lists is None:
        parts = parts.withColumn("worst", F.lit(-(1 << 30)))
    else:
        parts = parts.join(lists.select("key", _worst(NEIGHBOURS).alias("worst")), "key", "left").fillna({"worst": -(1 << 30)})
    parts = parts.select("bucket", "part", "key", "worst", "code")
    return parts.repartition("bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(_best_within(NEIGHBOURS), _LIST)


def _refined(nodes: DataFrame, lists: DataFrame, seed: int) -> DataFrame:
    """One round: around each vector, its neighbours and those it is a neighbour of are compared with each other."""
    forward = lists.select("key", F.explode("list.id").alias("id"))
    around = forward.select(F.col("key").alias("bucket"), F.col("id").alias("key")).union(forward.select(F.col("id").alias("bucket"), "key"))
    around = around.union(nodes.select(F.col("key").alias("bucket"), "key")).distinct()
    return _compared(around.join(nodes.select("key", "code"), "key").select("key", "code", "bucket"), GROUP, lists, seed)


def _graph(nodes: DataFrame, lists: DataFrame | None, cosine: float, attempt: int) -> DataFrame:
    """Lists from a forest, refined until they hardly change."""
    n = nodes.count()
    bits = _bits(n)
    tables = tables_needed(bits, cosine)
    # A large forest is taken in parts, so that no more copies of the vectors are on disk at once.
    for begin in range(0, tables, TABLES):
        new = _forest(nodes, lists, min(TABLES, tables - begin), bits, attempt + AUDITS * begin)
        lists = written(_merged(new if lists is None else lists.union(new), NEIGHBOURS), "lists")
    places = n * NEIGHBOURS
    for turn in range(ROUNDS):
        better = written(_merged(lists.union(_refined(nodes, lists, attempt * ROUNDS + turn)), NEIGHBOURS), "lists")
        old = lists.select("key", F.col("list").alias("old"))
        changed = better.join(old, "key", "left").select(F.sum(F.size(F.array_except("list", F.coalesce("old", F.expr("cast(array() AS array<struct<dot:int,id:bigint>>)"))))).alias("n")).first()["n"] or 0
        lists = better
        if changed <= CHANGED * places:
            break
    return lists


def _screen(least: int):
    """(a, b) of the candidate pairs whose product may reach the threshold; each group begins with its own vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of_groups(batches, 2):
            x = _matrix(group.column("data"), "<i2")
            good = np.flatnonzero(x[1:] @ x[0] >= least) + 1
            if len(good):
                ids = group.column("id").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(good), ids[0])), pa.array(ids[good])], names=["a", "b"])

    return run


def _exact(cosine: float):
    """(a, b) of the pairs whose cosine in double precision reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of_groups(batches, 2):
            x = _matrix(group.column("data"), "<f8")
            good = np.flatnonzero(x[1:] @ x[0] >= cosine) + 1
            if len(good):
                ids = group.column("id").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(good), ids[0])), pa.array(ids[good])], names=["a", "b"])

    return run


def _decided(pairs: DataFrame, nodes: DataFrame, column: str, judge) -> DataFrame:
    """The pairs (a, b) that `judge` takes; the partners of one vector are dealt out into parts, and its own row stands first in each."""
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / 1024).cast("int").alias("parts"))
    own = degree.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("first"), F.col("a").alias("id"))
    rest = pairs.join(degree, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("first"), F.col("b").alias("id"))
    rows = own.union(rest).join(nodes.select(F.col("key").alias("id"), F.col(column).alias("data")), "id").select("a", "part", "first", "id", "data")
    return rows.repartition("a", "part").sortWithinPartitions("a", "part", "first").mapInArrow(judge, "a bigint, b bigint")


def _enlarged(nodes: DataFrame, lists: DataFrame, cosine: float, known: DataFrame, seed: int) -> DataFrame:
    """(a, b), in both directions: pairs that may reach the threshold, with the lists that are full of such enlarged.

    A full list takes in what stands in the lists of some of its neighbours, again and again, until none grows. The
    `known` links (a, b) are there from the start; with another seed, lists go through other neighbours.
    """
    least = int((cosine - _SLACK) * _UNIT * _UNIT)
    near = written(lists.select("key", F.explode("list").alias("x")).where(F.col("x.dot") >= least).select(F.col("key").alias("a"), F.col("x.id").alias("b")), "near")
    both = written(near.union(near.select("b", "a")).union(known.select("a", "b")).distinct(), "near")
    active = both.groupBy("a").agg(F.count("*").alias("c")).where(F.col("c") >= NEIGHBOURS).select("a")
    while True:
        gathered = both.groupBy("a").agg(F.collect_set("b").alias("list"))
        growing = gathered.join(active, "a", "left_semi")
        ranked = F.sort_array(F.transform("list", lambda b: F.struct(F.xxhash64(b, F.lit(seed)).alias("h"), b.alias("b"))))
        through = growing.select("a", F.explode(F.slice(ranked, 1, PIVOTS)["b"]).alias("u"))
        reached = through.join(gathered.select(F.col("a").alias("u"), F.col("list").alias("far")), "u").groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("far"))).alias("far"))
        new = reached.join(gathered, "a").select("a", F.explode(F.array_except("far", "list")).alias("b")).where("a != b")
        # Each pair once, then both ways.
        new = new.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        found = written(_decided(written(new, "candidates"), nodes, "code", _screen(least)), "near")
        if found.isEmpty():
            return both
        both = written(both.union(found).union(found.select("b", "a")).distinct(), "near")
        active = written(found.select("a").union(found.select("b")).distinct(), "active")
        seed += 1


def recall_of_links(nodes: DataFrame, links: DataFrame, cosine: float = COSINE, audited: tuple[int, int] = AUDITED) -> float:
    """Mean share of a vector's own true links that `links` (a, b) has, by brute force for about `audited` vectors; 1 without any.

    Vectors that have more links than a list is long and the others are sampled and averaged apart, and the lower mean
    counts: the links of a dense group would outnumber those of all pairs and small groups.
    """
    degrees = links.groupBy(F.col("a").alias("key")).agg(F.count("*").alias("c"))
    small = F.coalesce("c", F.lit(0)) <= NEIGHBOURS
    kinds = written(nodes.select("key").join(degrees, "key", "left").select("key", small.alias("small")), "kinds")
    counts = {r["small"]: r["count"] for r in kinds.groupBy("small").count().collect()}
    limit = {kind: int(min(1.0, audited[kind] / n) * (1 << 30)) for kind, n in counts.items()}
    below = F.when(F.col("small"), limit.get(True, 0)).otherwise(limit.get(False, 0))
    asked = kinds.where(F.pmod(F.xxhash64("key", F.lit(99)), F.lit(1 << 30)) < below)
    sample = nodes.select("key", "vector").join(F.broadcast(asked), "key").collect()
    if not sample:
        return 1.0
    by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in {len(r["vector"]) for r in sample}:
        own = [r for r in sample if len(r["vector"]) == size]
        by_size[size] = np.array([r["key"] for r in own]), np.stack([np.frombuffer(r["vector"], "<f8") for r in own])
    shared = nodes.sparkSession.sparkContext.broadcast(by_size)

    def true_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            lengths = pc.binary_length(batch.column(1)).to_numpy()
            for size, (ids, vectors) in shared.value.items():
                rows = np.flatnonzero(lengths == size)
                for begin in range(0, len(rows), 1024):
                    some = rows[begin : begin + 1024]
                    x = _matrix(pa.chunked_array([batch.column(1).take(pa.array(some))]), "<f8")
                    i, j = np.nonzero(x @ vectors.T >= cosine)
                    keep = keys[some][i] != ids[j]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[j][keep]), pa.array(keys[some][i][keep])], names=["a", "b"])

    truth = nodes.select("key", "vector").mapInArrow(true_links, "a bigint, b bigint")
    shares = truth.join(links.withColumn("hit", F.lit(1)), ["a", "b"], "left").groupBy("a").agg((F.count("hit") / F.count("*")).alias("share"))
    means = shares.join(F.broadcast(asked.withColumnRenamed("key", "a")), "a").groupBy("small").agg(F.avg("share").alias("mean")).collect()
    return min((r["mean"] for r in means), default=1.0)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """All columns of `vectors`, and behind them n_links, component_id and kept (underscores appended where a name is taken).

    Equal vectors are one node with a weight. Neighbour lists start from random buckets and are refined by comparing each
    vector's neighbours and reverse neighbours with each other, until few places change; a vector that very many have as
    a neighbour is dealt with in parts. Lists full of pairs at the threshold are enlarged through their neighbours' lists
    until none grows. All remaining pairs are decided by the cosine in double precision. An audit compares some vectors
    with all, those with few links apart; below `RECALL` the graph is built further from another forest, and if the last
    one still falls short, the call raises with the recall that was measured.

    n_links counts the other vectors linked directly, equal ones included; component_id is the smallest id reachable,
    and kept says whether it is the row's own. Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing; vectors of different lengths neither. Rows that share an id count one by one. A row without an id
    counts as a vector and is kept only where it is linked with nothing that has one. An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    names = [free_name(vectors.columns, n) for n in ("n_links", "component_id", "kept")]
    slim = vectors.select(F.col(id_col).alias("id"), _mark(vector_col).alias("mark"), F.col(vector_col).cast("array<double>").alias("v"))
    schema = T.StructType([*slim.schema.fields[:2], *T._parse_datatype_string("key bigint, vector binary, code binary").fields])
    rows = written(slim.mapInArrow(_vector_rows, schema), "rows")
    nodes = written(rows.groupBy("key", "vector", "code").agg(F.count("*").alias("weight"), F.min("id").alias("first")), "nodes")

    lists = None
    links = spark.createDataFrame([], "a bigint, b bigint")
    for attempt in range(AUDITS):
        lists = _graph(nodes, lists, cosine, attempt)
        pairs = _enlarged(nodes, lists, cosine, links, 1000 * attempt).where("a < b")
        once = written(_decided(pairs, nodes, "vector", _exact(cosine)), "links")
        links = once.union(once.select("b", "a"))
        recall = recall_of_links(nodes, links, cosine)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"after {AUDITS} forests only {recall:.4f} of the links of an audited vector are found; {RECALL} are needed")

    weights = nodes.select(F.col("key").alias("b"), "weight")
    counts = links.join(weights, "b").groupBy(F.col("a").alias("key")).agg(F.sum("weight").alias("linked"))
    groups = components(links.where("a < b")).withColumnRenamed("node", "key")
    judged = nodes.join(counts, "key", "left").join(groups, "key", "left")
    judged = judged.select("key", "first", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("component", "key").alias("component"))
    smallest = judged.groupBy("component").agg(F.min("first").alias("smallest"))
    judged = judged.join(smallest, "component").select("key", "n", "smallest")
    mark, own_id, own_mark, count, smallest = (free_name(vectors.columns, n) for n in ("_own", "_id", "_mark", "_links", "_smallest"))
    per_row = rows.select("id", "mark", "key").distinct().join(judged, "key").select(F.col("id").alias(own_id), F.col("mark").alias(own_mark), F.col("n").alias(count), F.col("smallest").alias(smallest))
    out = vectors.withColumn(mark, _mark(vector_col)).join(per_row, F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(mark) == F.col(own_mark)), "left")
    component = F.coalesce(smallest, id_col)
    return out.select(*columns(vectors.columns), F.coalesce(count, F.lit(0)).cast("long").alias(names[0]), component.alias(names[1]), F.col(id_col).eqNullSafe(component).alias(names[2]))


def _mark(vector_col: str) -> Column:
    """Tells rows apart that share an id."""
    return F.xxhash64(F.col(vector_col).cast("array<double>"))
