"""Approximate nearest neighbours by a hash-prefix forest.

Every tree gives a row a string of sign bits; a tree is its rows sorted by that string. A query descends in every tree
to the rows that share its longest prefixes. What it finds there bounds the angle of its last neighbour, and the chance
that two rows at that angle share a prefix says how far the query ascends: in all trees at once, a bit at a time, until
a row at that angle would share the prefix in one of the trees with the probability asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.vectors import finite, matrix, one_length, partitions, runs
from forecourt.sources.storage import written

TREES, BITS, SEED = 6, 60, 7
#: Rows of a run of a sorted array, the number of runs that the directory may hold, queries that meet a run together.
RUN, MOST_RUNS, CHUNK = 4096, 1 << 20, 512
#: Rows of a run that a query sees at least when it descends.
FIRST = 256
#: Bytes of routed queries up to which they go to every executor, so that the forest needs no shuffle.
FEW_BYTES = 32 << 20

_CODES = "tree int, code bigint, vec_id bigint, vector binary"
_RUNS = "run bigint, tree int, low bigint, high bigint, ids binary, codes binary, vectors binary"
_ROUTED = "run bigint, query_id bigint, low bigint, high bigint, least double, vector binary"
_FOUND = "query_id bigint, vec_id bigint, score double"


def planes(width: int) -> np.ndarray:
    """The hash of every tree: BITS directions, at right angles as far as the width allows."""
    rng = np.random.default_rng(SEED)
    blocks = -(-BITS // width)
    return np.stack([np.hstack([np.linalg.qr(rng.standard_normal((width, width)))[0] for _ in range(blocks)])[:, :BITS]
                     for _ in range(TREES)])


def _strings(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Codes (trees, rows): the first sign is the highest bit.

    A further component lifts all rows to one length, so that the nearest angle is the largest inner product. Queries,
    whose length doesn't matter, are given with `largest` 0 and have none.
    """
    rest = np.sqrt(np.maximum(largest**2 - (vectors**2).sum(1), 0)) if largest else np.zeros(len(vectors))
    lifted = np.hstack([vectors, rest[:, None]])
    weights = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    return np.stack([(lifted @ h > 0) @ weights for h in planes(lifted.shape[1])])


def _cells(arrays) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def _own(vectors: pa.Array) -> pa.Array:
    """The bytes of each vector, in its own type."""
    return _cells(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1))


def _coded(batches: Iterator[pa.RecordBatch], largest: float) -> Iterator[pa.RecordBatch]:
    """A row of every tree for each vector, with the vector as it is."""
    for batch in batches:
        if batch.num_rows:
            codes, own = _strings(matrix(batch.column(1)), largest), _own(batch.column(1))
            for tree in range(TREES):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, tree), pa.int32()), pa.array(codes[tree]), batch.column(0), own],
                                                 names=["tree", "code", "vec_id", "vector"])


def _packed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Runs of a tree's sorted rows, one row each; they get their numbers afterwards."""
    for table in runs(batches, ["tree"], most):
        codes, ids = table.column("code").to_numpy(), table.column("vec_id").to_numpy()
        tree = table.column("tree")[0].as_py()
        yield pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int64()), pa.array([tree], pa.int32()), pa.array(codes[:1]), pa.array(codes[-1:]), _cells([ids]), _cells([codes]),
             pa.array([b"".join(table.column("vector").to_pylist())], pa.binary())],
            names=["run", "tree", "low", "high", "ids", "codes", "vectors"])


def _level(least: np.ndarray, norms: np.ndarray, largest: float, recall: float) -> np.ndarray:
    """Bits of the prefix that a row with the score `least` shares in one of the trees with a chance of `recall`."""
    cosine = np.clip(least / (norms * largest), -1, 1)
    agree = 1 - np.arccos(cosine) / np.pi
    reached = 1 - (1 - agree[:, None] ** np.arange(BITS + 1)) ** TREES >= recall
    return np.where(np.isfinite(least), reached.sum(1) - 1, 0)


def _routed(batches: Iterator[pa.RecordBatch], directory: Broadcast, largest: float, recall: float | None) -> Iterator[pa.RecordBatch]:
    """Queries with the runs they visit. Without `recall` they descend, to the run that would hold their code; with it
    they ascend, to all runs that hold rows with a prefix of their own length."""
    tree_of, low_of, high_of, run_of = directory.value
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors, least = matrix(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
        codes, own = _strings(vectors, 0.0), _own(batch.column(1))
        free = np.zeros(len(vectors), np.int64) if recall is None \
            else BITS - _level(least, np.linalg.norm(vectors, axis=1), largest, recall)
        for tree in range(TREES):
            a, b = np.searchsorted(tree_of, [tree, tree + 1])
            if a == b:
                continue
            low = (codes[tree] >> free) << free
            high = low + ((np.int64(1) << free) - 1)
            first, last = np.searchsorted(high_of[a:b], low, "left"), np.searchsorted(low_of[a:b], high, "right") - 1
            if recall is None:
                first = last = np.minimum(first, b - a - 1)
            width = np.maximum(last - first + 1, 0)
            query = np.repeat(np.arange(len(vectors)), width)
            place = a + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width - first, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(run_of[place]), batch.column(0).take(pa.array(query)), pa.array(low[query]), pa.array(high[query]),
                 pa.array(least[query]), own.take(pa.array(query))], names=["run", "query_id", "low", "high", "least", "vector"])


def _descent(codes: np.ndarray, code: np.int64, least: int) -> tuple[int, int]:
    """The longest prefix of a code that `least` rows of a sorted run share, as the stretch of those rows."""
    found, free, step = (0, len(codes)), BITS, 32
    while step:
        if free >= step:
            low = (code >> np.int64(free - step)) << np.int64(free - step)
            start, end = np.searchsorted(codes, [low, low + (np.int64(1) << np.int64(free - step))])
            if end - start >= min(least, len(codes)):
                found, free = (int(start), int(end)), free - step
        step //= 2
    return found


def _exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products whose sums run in one order, so that equal vectors score alike."""
    return (rows * query).sum(1)


def _nearest(batches: Iterator[pa.RecordBatch], most: int, kind: str, first: bool) -> Iterator[pa.RecordBatch]:
    """Of the rows of a run that share a query's prefix the nearest, unless they are known to be beyond the last one."""
    for batch in batches:
        for ids, codes, vectors, queries in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            ids, codes = np.frombuffer(ids, np.int64), np.frombuffer(codes, np.int64)
            rows = np.frombuffer(vectors, kind).reshape(len(ids), -1).astype(np.float64)
            asked = np.stack([np.frombuffer(q["vector"], kind) for q in queries]).astype(np.float64)
            met = [_descent(codes, np.int64(q["low"]), FIRST) if first else np.searchsorted(codes, [q["low"], q["high"] + 1]) for q in queries]
            scores = rows @ asked.T if 4 * sum(end - start for start, end in met) > len(rows) * len(asked) else None
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for k, (q, (start, end)) in enumerate(zip(queries, met, strict=True)):
                s = rows[start:end] @ asked[k] if scores is None else scores[start:end, k]
                # These sums may differ in their last digits: those of near rows are worked out again.
                slack = 1e-9 * (1 + np.abs(s).max()) if len(s) else 0.0
                near = np.flatnonzero(s >= q["least"] - slack)
                if len(near) > most + 1:
                    near = near[s[near] >= np.partition(s[near], len(near) - most - 1)[len(near) - most - 1] - slack]
                near += start
                near = near[ids[near] != q["query_id"]]
                s = _exact(rows[near], asked[k])
                near = near[order := np.lexsort((ids[near], -s))[:most]]
                found.append((np.full(len(near), q["query_id"]), ids[near], s[order]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["query_id", "vec_id", "score"])


def _met(index: DataFrame, routed: DataFrame, width: int, most: int, kind: str, first: bool) -> DataFrame:
    """What queries find in the runs they visit: a run meets a bounded number of them at a time."""
    few = routed.count() * (width + 64) <= FEW_BYTES
    crowds = routed.groupBy("run").agg(F.ceil(F.count("*") / (CHUNK // 2)).cast("int").alias("chunks"))
    packed = routed.join(crowds, "run") \
        .groupBy("run", F.pmod(F.xxhash64("query_id"), F.col("chunks")).alias("chunk")) \
        .agg(F.collect_list(F.struct("query_id", "low", "high", "least", "vector")).alias("queries"))
    return index.join(F.broadcast(packed) if few else packed, "run").select("ids", "codes", "vectors", "queries") \
        .mapInArrow(partial(_nearest, most=most, kind=kind, first=first), _FOUND)


def _visited(queries: DataFrame, directory: Broadcast, largest: float, recall: float | None) -> DataFrame:
    return written(queries.select("query_id", "vector", "least").mapInArrow(
        partial(_routed, directory=directory, largest=largest, recall=recall), _ROUTED), "routed")


def _ranked(found: DataFrame, most: int) -> DataFrame:
    """The nearest of what the trees found, each once."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def forest(rows: DataFrame, largest: float, count: int) -> DataFrame:
    """The sorted arrays of every tree, written in runs: every row is in each tree."""
    most = max(RUN, -(-count * TREES // MOST_RUNS))
    coded = rows.select("vec_id", "vector").mapInArrow(partial(_coded, largest=largest), _CODES)
    by = ("tree", "code", "vec_id")
    sorted_rows = coded.repartitionByRange(partitions(count * TREES, most, rows.sparkSession), *by).sortWithinPartitions(*by)
    packed = sorted_rows.mapInArrow(partial(_packed, most=most), _RUNS).withColumn("run", F.monotonically_increasing_id())
    return written(packed, "forest")


def nearest(rows: DataFrame, every: int = 20, most: int = 20, recall: float = 0.9, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows of every row whose vec_id `every` divides, its own left out.

    Nearness is the inner product, in doubles, exact for what is returned; ties go to the smaller vec_id. `recall` is the
    chance for a row as near as the last one found when descending to be met; nearer rows are met with a higher one. No
    number of candidates is set: a query ascends until that chance is reached, in the end to all rows of every tree.
    Where ranges are cut follows Spark's sample of the strings, so which of the remaining rows are missed may change.

    Of rows with one vector only the first most + 1 by id can be answers; they are found before the trees are built, in
    every task already, so that a crowd of copies is that many rows. Trees are sorted by ranges and packed into runs of at least RUN
    rows, so many that their directory, the first and last code of each, has at most MOST_RUNS rows; it is broadcast. Queries go to the
    runs of their prefixes; those of one run meet it in chunks, so a run that many ask for is work for many tasks.

    Vectors that are null, empty, zero, have null or non-finite components or another length than most take no part,
    nor do rows without id. Of several rows with one id the first by its vector counts. A query without other rows
    has no answers; other columns play no part; empty tables give no rows.
    """
    spark = rows.sparkSession
    single = rows.schema[vector].dataType.simpleString() == "array<float>"
    held = F.col(vector) if single else F.col(vector).cast("array<double>")
    valid = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), held.alias("vector")).where("vec_id is not null")
    valid = valid.where(finite(F.col("vector"))).where(F.exists("vector", lambda x: x != 0))
    valid = written(one_length(valid.groupBy("vec_id").agg(F.min("vector").alias("vector"))), "vectors")
    copies = Window.partitionBy("vector").orderBy("vec_id")
    kept = written(valid.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= most + 1).drop("copy"), "distinct")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    whole = kept.agg(F.max(norm).alias("largest"), F.max(F.size("vector")).alias("width"), F.count("*").alias("n")).first()
    if not whole.n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    index = forest(kept, whole.largest, whole.n)
    places = index.select("tree", "low", "high", "run").toArrow().sort_by([("tree", "ascending"), ("low", "ascending"), ("high", "ascending")])
    directory = spark.sparkContext.broadcast(tuple(places.column(c).to_numpy() for c in ("tree", "low", "high", "run")))
    kind = "float32" if single else "float64"
    queries = valid.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector", F.lit(float("-inf")).alias("least"))
    width = whole.width * (4 if single else 8)
    found = written(_ranked(_met(index, _visited(queries, directory, whole.largest, None), width, most, kind, True), most), "descended")
    least = found.where(F.col("rank") == most).select("query_id", F.col("score").alias("least"))
    again = written(queries.drop("least").join(least, "query_id", "left").select("query_id", "vector", F.coalesce("least", F.lit(float("-inf"))).alias("least")), "queries")
    met = _met(index, _visited(again, directory, whole.largest, recall), width, most, kind, False)
    return _ranked(met.union(found.select("query_id", "vec_id", "score")), most).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
