"""Hard negatives: for every anchor the wrong-label rows that score just below its positives, found by angles.

Every row keeps its angles to a few reference directions. The angle between two rows is at least the difference of
their angles to a reference and at most their sum, so the cosine lies in an interval; multiplied by the norms, it bounds
the score. Rows are stored by nearest reference and by the angle to it: what an anchor's window of scores can hold is
one stretch of such a block, and only that is scored, in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.vectors import finite, matrix, one_length, partitions, runs
from forecourt.sources.storage import scratch, written

#: Rows of a block, anchors that meet all rows together, reference directions and the rows that they are chosen from.
BLOCK, TOGETHER, REFERENCES, SAMPLE = 4096, 8192, 16, 1024
#: Added to every angle: stored angles are rounded to seven digits, and an arc cosine near its ends to eight.
SLACK = 1e-5
#: Sums of whole numbers up to here are exact in doubles.
EXACT = 2.0**53

_ROWS = "ref int, angle double, vec_id bigint, label bigint, whole binary, angles binary"
_FOUND = "anchor bigint, positive bigint, vec_id bigint, score bigint"
_FOUND_ARROW = [("anchor", pa.int64()), ("positive", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]


def _angles(whole: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles between rows and directions of length one; a zero row has any angle, and a norm that makes it matter not."""
    norms = np.linalg.norm(whole, axis=1)
    return np.arccos(np.clip(whole @ references.T / np.where(norms > 0, norms, 1)[:, None], -1, 1))


def _whole(vectors: np.ndarray, scale: float) -> np.ndarray:
    """Components times the scale, rounded down, as doubles without a fraction; within 32 bits."""
    return np.clip(np.floor(scale * vectors), -(2.0**31), 2.0**31 - 1)


def _directions(vectors: np.ndarray, most: int) -> np.ndarray:
    """Directions amid the given rows: far from each other at first, then each the mean of the rows nearest to it."""
    norms = np.linalg.norm(vectors, axis=1)
    units = vectors[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.eye(1, vectors.shape[1])
    chosen = units[:1]
    while len(chosen) < min(most, len(units)):
        chosen = np.vstack([chosen, units[np.argmin((units @ chosen.T).max(1))]])
    for _ in range(5):
        nearest = np.argmax(units @ chosen.T, axis=1)
        sums = np.stack([units[nearest == k].sum(0) if (nearest == k).any() else chosen[k] for k in range(len(chosen))])
        lengths = np.linalg.norm(sums, axis=1)
        chosen = np.where(lengths[:, None] > 0, sums / np.where(lengths > 0, lengths, 1)[:, None], chosen)
    return chosen


def _placed(batches: Iterator[pa.RecordBatch], references: np.ndarray, scale: float) -> Iterator[pa.RecordBatch]:
    """Rows with their whole numbers, their angles and the reference they are nearest to."""
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = _whole(matrix(batch.column(2)), scale)
        angles = _angles(whole, references)
        ref = np.argmin(angles, axis=1)
        bytes_of = lambda rows: pa.array([r.tobytes() for r in rows], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ref, pa.int32()), pa.array(angles[np.arange(len(ref)), ref]), batch.column(0), batch.column(1),
             bytes_of(whole.astype(np.int32)), bytes_of(angles.astype(np.float32))],
            names=["ref", "angle", "vec_id", "label", "whole", "angles"])


@dataclass(frozen=True)
class Anchors:
    """A bounded number of anchors. `least` and `most` bound the scores that are looked for; `floors` has, for each
    positive, the score that its last negative has at least, as far as known."""

    ids: np.ndarray
    labels: np.ndarray
    whole: np.ndarray
    angles: np.ndarray
    least: np.ndarray
    most: np.ndarray
    positives: list[list[tuple[int, int]]] | None = None
    floors: list[list[int]] | None = None

    @property
    def norms(self) -> np.ndarray:
        return np.linalg.norm(self.whole, axis=1)


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels, whole numbers as doubles, and angles of stored rows."""
    n = table.num_rows
    joined = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind).reshape(n, -1).astype(np.float64)
    return table.column("vec_id").to_numpy(), table.column("label").to_numpy(), joined("whole", np.int32), joined("angles", np.float32)


def _scores(rows: np.ndarray, row: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products as long integers."""
    if largest < EXACT:
        return (rows @ row).astype(np.int64)
    return rows.astype(np.int64) @ row.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first rows by score, the smaller id on ties."""
    if len(scores) > most:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
        return near[np.lexsort((ids[near], -scores[near]))[:most]]
    return np.lexsort((ids, -scores))


def _reach(anchors: Anchors, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """For rows with norms from low to high: the largest and the smallest angle to an anchor at which a score can lie
    within its bounds. Where none can, the largest is negative."""
    norms = anchors.norms
    with np.errstate(divide="ignore", invalid="ignore"):
        least = np.where(anchors.least > 0, anchors.least / (norms * high), anchors.least / (norms * low))
        most = np.where(anchors.most > 0, anchors.most / (norms * low), anchors.most / (norms * high))
    least = np.where(np.isnan(least), -1.0, least) - 1e-9
    most = np.where(np.isnan(most), 1.0, most) + 1e-9
    widest = np.where(least > 1, -1.0, np.arccos(np.clip(least, -1, 1)) + SLACK)
    return np.where(most < -1, -1.0, widest), np.arccos(np.clip(most, -1, 1)) - SLACK


def _windows(anchors: Anchors, own: int, whole: np.ndarray, angles: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Anchors (their place) with the stretch of a block, sorted by its own reference, that their bounds can meet."""
    norms = np.linalg.norm(whole, axis=1)
    widest, narrowest = _reach(anchors, norms.min(), norms.max())
    near, far = angles.min(0), angles.max(0)
    at = anchors.angles
    apart = np.maximum(np.maximum(at - far, near - at), 0).max(1)
    around = np.maximum(np.minimum(at + near, 2 * np.pi - at - near), np.minimum(at + far, 2 * np.pi - at - far))
    around = np.where((near <= np.pi - at) & (np.pi - at <= far), np.pi, around).min(1)
    fits = (apart <= widest + SLACK) & (around >= narrowest - SLACK)
    mine, sorted_angles = at[:, own], angles[:, own]
    first = np.maximum(mine - widest, narrowest - mine) - SLACK
    last = np.minimum(mine + widest, 2 * np.pi - narrowest - mine) + SLACK
    starts, ends = np.searchsorted(sorted_angles, first, "left"), np.searchsorted(sorted_angles, last, "right")
    for k in np.flatnonzero(fits & (starts < ends)):
        yield int(k), int(starts[k]), int(ends[k])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for table in runs(batches, ["ref"], BLOCK):
        own = table.column("ref")[0].as_py()
        ids, labels, whole, angles = _rows(table)
        order = np.argsort(angles[:, own], kind="stable")
        yield own, ids[order], labels[order], whole[order], angles[order]


def _emitted(found: list[tuple]) -> pa.RecordBatch:
    columns = zip(*found, strict=True) if found else [[]] * len(_FOUND_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, _FOUND_ARROW, strict=True)],
                                      names=[n for n, _ in _FOUND_ARROW])


def _met(anchors: Anchors, blocks, take) -> Iterator[pa.RecordBatch]:
    """What `take` finds among the scores of each anchor's stretch of each block; `take` may raise the bounds."""
    for own, ids, labels, whole, angles in blocks:
        largest = float(np.linalg.norm(whole, axis=1).max() * anchors.norms.max())
        found: list[tuple] = []
        for k, start, end in _windows(anchors, own, whole, angles):
            scores = _scores(whole[start:end], anchors.whole[k], largest)
            take(k, scores, ids[start:end], labels[start:end], found)
        yield _emitted(found)


def _positives(blocks, anchors: Anchors, most: int) -> Iterator[pa.RecordBatch]:
    """Of every block the first rows of an anchor's label, as far as a task has not seen as many better ones."""
    least, best = anchors.least.copy(), [[] for _ in anchors.ids]

    def take(k, scores, ids, labels, found):
        near = np.flatnonzero((scores >= least[k]) & (labels == anchors.labels[k]) & (ids != anchors.ids[k]))
        near = near[_best(scores[near], ids[near], most)]
        found += [(int(anchors.ids[k]), None, int(ids[i]), int(scores[i])) for i in near]
        best[k] = sorted([*best[k], *scores[near].tolist()], reverse=True)[:most]
        if len(best[k]) == most:
            least[k] = max(least[k], best[k][-1])

    yield from _met(replace(anchors, least=least), blocks, take)


def _negatives(blocks, anchors: Anchors, high: int, most: int) -> Iterator[pa.RecordBatch]:
    """Of every block the first rows of other labels for each positive, as far as a task has not seen as many better."""
    least, floors = anchors.least.copy(), [list(f) for f in anchors.floors]
    best = [[[] for _ in f] for f in floors]

    def take(k, scores, ids, labels, found):
        other = labels != anchors.labels[k]
        for j, (positive, score) in enumerate(anchors.positives[k]):
            near = np.flatnonzero(other & (scores >= floors[k][j]) & (scores <= high * score // 100))
            near = near[_best(scores[near], ids[near], most)]
            found += [(int(anchors.ids[k]), positive, int(ids[i]), int(scores[i])) for i in near]
            best[k][j] = sorted([*best[k][j], *scores[near].tolist()], reverse=True)[:most]
            if len(best[k][j]) == most:
                floors[k][j] = max(floors[k][j], best[k][j][-1])
        if floors[k]:
            least[k] = min(floors[k])

    yield from _met(replace(anchors, least=least), blocks, take)


def _known(anchors: Anchors, find) -> list[tuple]:
    """What the anchors find among themselves: it gives the first bounds, before any other row is read."""
    blocks = ((0, anchors.ids[i : i + BLOCK][o], anchors.labels[i : i + BLOCK][o], anchors.whole[i : i + BLOCK][o], anchors.angles[i : i + BLOCK][o])
              for i in range(0, len(anchors.ids), BLOCK) for o in [np.argsort(anchors.angles[i : i + BLOCK, 0], kind="stable")])
    return [row for batch in find(blocks, anchors) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]


def _find_positives(batches: Iterator[pa.RecordBatch], asked: Broadcast, most: int) -> Iterator[pa.RecordBatch]:
    yield from _positives(_blocks(batches), asked.value, most)


def _find_negatives(batches: Iterator[pa.RecordBatch], asked: Broadcast, high: int, most: int) -> Iterator[pa.RecordBatch]:
    yield from _negatives(_blocks(batches), asked.value, high, most)


def _first(found: DataFrame, by: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def stored(rows: DataFrame, scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """The valid rows with whole numbers and angles, written by reference and angle."""
    held = F.col(vector) if rows.schema[vector].dataType.simpleString() == "array<float>" else F.col(vector).cast("array<double>")
    valid = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), held.alias("vector"))
    valid = valid.where("vec_id is not null and label is not null").where(finite(F.col("vector")))
    valid = one_length(valid.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector"))
    valid = written(valid, "vectors")
    parts = partitions(valid.count(), BLOCK, rows.sparkSession)
    seen = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    references = _directions(_whole(np.array([r.vector for r in seen], np.float64), scale), REFERENCES) if seen else np.eye(1)
    placed = valid.select("vec_id", "label", "vector").mapInArrow(partial(_placed, references=references, scale=scale), _ROWS)
    by = ("ref", "angle", "vec_id")
    return written(placed.repartitionByRange(parts, *by).sortWithinPartitions(*by), "angles")


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exactly.

    Anchors are rows whose vec_id `every` divides. Scores are inner products of the components times `scale`, rounded
    down. An anchor's positives are its first other rows of the same label; a positive's negatives are the first rows
    of other labels with a score between `low` and `high` percent of the positive's. Order: score, then smaller vec_id.

    Anchors are taken in blocks of about TOGETHER, which is what a task and the driver hold; every block reads the stored
    rows twice. A task sends on no more than the first of each of its blocks of rows, and ever fewer as its bounds rise.

    Rows without id, label or vector, with a component that is null or not finite, or with another number of components
    than most, take no part. Of rows that share an id the first by label and vector counts. Components are
    held within 32 bits, and scores must fit a long. Empty tables give no rows; other columns play no part.
    """
    spark = rows.sparkSession
    table = stored(rows, scale, vec_id, vector, label)
    asked = table.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // TOGETHER))
    path = scratch(spark, "negatives")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    for k in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == k).toArrow().sort_by("vec_id")
        if not some.num_rows:
            continue
        ids, labels, whole, angles = _rows(some)
        every_score = np.full(len(ids), np.inf)
        anchors = Anchors(ids, labels, whole, angles, -every_score, every_score)
        least = _lowest(_known(anchors, partial(_positives, most=positives)), ids, positives)
        anchors = replace(anchors, least=least)
        found = table.mapInArrow(partial(_find_positives, asked=spark.sparkContext.broadcast(anchors), most=positives), _FOUND)
        ranked = _first(found, ["anchor"], positives).select("anchor", "vec_id", "score").collect()
        given: dict[int, list[tuple[int, int]]] = {}
        for r in sorted(ranked, key=lambda r: (r.anchor, -r.score, r.vec_id)):
            given.setdefault(r.anchor, []).append((r.vec_id, r.score))
        own = [[p for p in given.get(i, []) if p[1] >= 0] for i in ids.tolist()]
        floors = [[-(-low * score // 100) for _, score in ps] for ps in own]
        anchors = replace(anchors, positives=own, floors=floors,
                          least=np.array([min(f, default=np.inf) for f in floors]),
                          most=np.array([max((high * s / 100 for _, s in ps), default=-np.inf) for ps in own]))
        among = _known(anchors, partial(_negatives, high=high, most=negatives))
        met: dict[tuple[int, int], list[int]] = {}
        for anchor, positive, _, score in among:
            met.setdefault((anchor, positive), []).append(score)
        floors = [[sorted(s, reverse=True)[negatives - 1] if len(s := met.get((i, p), [])) >= negatives else f for (p, _), f in zip(ps, fs, strict=True)]
                  for i, ps, fs in zip(ids.tolist(), own, floors, strict=True)]
        anchors = replace(anchors, floors=floors, least=np.array([min(f, default=np.inf) for f in floors]))
        found = table.mapInArrow(partial(_find_negatives, asked=spark.sparkContext.broadcast(anchors), high=high, most=negatives), _FOUND)
        scores = spark.createDataFrame([(i, p, s) for i, ps in zip(ids.tolist(), own, strict=True) for p, s in ps],
                                       "anchor bigint, positive bigint, positive_score bigint")
        _first(found, ["anchor", "positive"], negatives).join(scores, ["anchor", "positive"]).select(
            F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path)
    if not asked.limit(1).count():
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _lowest(found: list[tuple], ids: np.ndarray, most: int) -> np.ndarray:
    """The score of each anchor's last positive among those found, if there are enough of them."""
    scores: dict[int, list[int]] = {}
    for anchor, _, _, score in found:
        scores.setdefault(anchor, []).append(score)
    return np.array([sorted(s, reverse=True)[most - 1] if len(s := scores.get(i, [])) >= most else -np.inf for i in ids.tolist()])
