"""Near copies of documents: SetSketch registers, bands of them, a joint likelihood, then the full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.linking import components, linked
from forecourt.llm.tables import among, slices, texts
from forecourt.sources.storage import written


@dataclass(frozen=True)
class Sketch:
    """Settings. Registers of the base and rate proposed with the sketch; 32 bands of 5 registers miss three in a
    million pairs of similarity 0.8."""

    bands: int = 32
    rows: int = 5
    base: float = 1.001
    rate: float = 20.0
    top: int = 65534
    shingle: int = 2
    percent: int = 80
    #: Pairs are dropped before the full sets are read where the likelihood of the threshold or more is less than
    #: that of the best estimate by this many nats.
    doubt: float = 14.0

    @property
    def registers(self) -> int:
        return self.bands * self.rows


#: Hashes of a block of sets that are compared with another block in one go, about.
BLOCK = 1 << 16


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingles(found: list[bytes], size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of `size` words; of all words where they are fewer."""
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), 1)], np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    whole = one[: len(found) - size + 1].copy()
    for k in range(1, size):
        whole ^= whole >> np.uint64(31)
        whole = whole * np.uint64(0x9E3779B97F4A7C15) + one[k : len(found) - size + 1 + k]
    whole ^= whole >> np.uint64(29)
    whole *= np.uint64(0xBF58476D1CE4E5B9)
    whole ^= whole >> np.uint64(32)
    return np.unique(whole)


@cache
def _keys(registers: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(registers)
    draw = lambda: rng.integers(0, 2**63, registers, np.uint64) * np.uint64(2) + np.uint64(1)
    return draw(), draw()


def registers(hashes: np.ndarray, s: Sketch) -> np.ndarray:
    """The registers of a set: a smallest exponential value each, as a whole power of the base, cut to 16 bits.

    Registers of a union are the larger ones of its parts.
    """
    times, plus = _keys(s.registers)
    least = np.full(s.registers, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        values = hashes[at : at + 2048, None] * times + plus
        np.minimum(least, values.min(axis=0), out=least)
    value = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / s.rate
    return np.clip(np.floor(1 - np.log(np.maximum(value, 1e-300)) / np.log(s.base)), 0, s.top + 1).astype("<u2")


def _sketched(batches: Iterator[pa.RecordBatch], s: Sketch) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 16 << 20):
        out: dict[str, list] = {"n_shingles": [], "digest": [], "sketch": [], "bands": []}
        for text in batch.column(1).to_pylist():
            found = words(text)
            hashes = shingles(found, s.shingle)
            out["n_shingles"].append(len(hashes))
            if not found:
                for name in ("digest", "sketch", "bands"):
                    out[name].append(None)
                continue
            held = registers(hashes, s)
            out["digest"].append(hashlib.blake2b(b" ".join(found), digest_size=16).digest())
            out["sketch"].append(held.tobytes())
            out["bands"].append([xxhash.xxh3_64_intdigest(row.tobytes(), k) - 2**63
                                 for k, row in enumerate(held.reshape(s.bands, s.rows))])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out["n_shingles"], pa.int64()), pa.array(out["digest"], pa.binary()),
             pa.array(out["sketch"], pa.binary()), pa.array(out["bands"], pa.list_(pa.int64()))],
            names=["doc_id", *out])


def likely(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, s: Sketch) -> np.ndarray:
    """Whether two sets may reach the threshold, by the joint likelihood of their registers and known sizes."""
    above, below = (left > right).sum(axis=1), (left < right).sum(axis=1)
    same = s.registers - above - below
    u = n_left / (n_left + n_right)
    most = np.minimum(u, 1 - u) / np.maximum(u, 1 - u)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (s.base - 1) / s.base) / np.log(s.base)

    def likelihood(j: np.ndarray) -> np.ndarray:
        over, under = p(u - (1 - u) * j), p(1 - u - u * j)
        safe = lambda x: np.log(np.maximum(x, 1e-9))
        return above * safe(over) + below * safe(under) + same * safe(1 - over - under)

    bar = s.percent / 100
    grid = np.linspace(0, 1, 41)
    best = np.max([likelihood(most * g) for g in grid], axis=0)
    reached = np.max([likelihood(np.minimum(most, bar + (1 - bar) * g)) for g in np.linspace(0, 1, 9)], axis=0)
    fits = 100 * np.minimum(n_left, n_right) >= s.percent * np.maximum(n_left, n_right)
    return fits & (reached >= best - s.doubt)


def _likely(batches: Iterator[pa.RecordBatch], s: Sketch) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            held = [np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, s.registers) for k in (2, 4)]
            sizes = [batch.column(k).to_numpy().astype(float) for k in (3, 5)]
            yield batch.select(["a", "b"]).filter(pa.array(likely(*held, *sizes, s)))


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 16 << 20):
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([shingles(words(t), size).tobytes() for t in batch.column(1).to_pylist()], pa.binary())],
            names=["id", "set"])


def _reached(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                keep.append(False)
                continue
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * common >= percent * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _block_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links between the outsiders of one block and the members of another of the same bucket.

    The members' hashes are sorted together, so one lookup of an outsider's hashes counts what it shares with every
    member. Of an outsider's links to one group a single one is given: the others connect nothing more.
    """
    for batch in batches:
        links = []
        for outsiders, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets = [np.frombuffer(m["set"], np.uint64) for m in members]
            sizes = np.array([len(x) for x in sets])
            whole = np.concatenate(sets)
            order = np.argsort(whole, kind="stable")
            whole, owner = whole[order], np.repeat(np.arange(len(sets)), sizes)[order]
            group = np.array([m["group"] for m in members])
            for o in outsiders:
                mine = np.frombuffer(o["set"], np.uint64)
                lo, hi = np.searchsorted(whole, mine, "left"), np.searchsorted(whole, mine, "right")
                n = hi - lo
                at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                common = np.bincount(owner[at], minlength=len(sets))
                found = np.flatnonzero((100 * common >= percent * (len(mine) + sizes - common)) & (group != o["group"]))
                links += [(o["id"], members[found[k]]["id"]) for k in np.unique(group[found], return_index=True)[1]]
        pairs = np.array(links, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], names=["a", "b"])


def near_copies(docs: DataFrame, s: Sketch = Sketch()) -> DataFrame:
    """Groups of near copies: doc_id, n_shingles, component_id, kept, a row for each row of `docs`.

    Documents are linked whose sets of word runs have at least `percent` of their union in common; a group is
    what links connect, and its smallest doc_id is kept. Equal word sequences are one text from the start and
    are never paired. Texts that share a band of registers are candidates (`linking.linked`); the joint
    likelihood of both sketches drops clear failures, and the full sets decide. In large buckets that hold several
    groups after the first links, blocks of outsiders meet blocks of members, sets and all: a row is a pair of
    blocks, not of documents.

    Null, empty and white-space texts: an empty set, linked with nothing. A text with fewer words than a run:
    its whole sequence is the one member. A row without doc_id: no component, kept, linked with nothing.
    Rows that repeat a doc_id: one document with several texts, linked where any of them is. No rows: no rows.
    """
    rows = written(texts(docs).mapInArrow(
        partial(_sketched, s=s),
        "doc_id bigint, n_shingles bigint, digest binary, sketch binary, bands array<bigint>"), "sketches")
    # One document stands for all of equal text.
    kinds = rows.where("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"),
        F.first("bands").alias("bands"))
    kinds = written(kinds, "kinds")
    buckets = kinds.select("id", "n", F.posexplode("bands").alias("band", "value")) \
        .select(F.xxhash64("band", "value").alias("key"), "id", "n").distinct()

    def sets_of(ids: DataFrame) -> DataFrame:
        found = among(texts(docs), written(ids, "ids"), ["doc_id"])
        return written(found.mapInArrow(partial(_sets, size=s.shingle), "id bigint, set binary"), "sets")

    def confirm(pairs: DataFrame) -> DataFrame:
        side = lambda n: kinds.select(F.col("id").alias(n), F.col("sketch").alias(f"{n}_sketch"), F.col("n").alias(f"n_{n}"))
        asked = written(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_sketch", "n_a", "b_sketch", "n_b")
                        .mapInArrow(partial(_likely, s=s), "a bigint, b bigint").distinct(), "asked")
        sets = sets_of(asked.select(F.col("a").alias("doc_id")).union(asked.select("b")).distinct())
        both = asked.join(sets.select(F.col("id").alias("a"), F.col("set").alias("a_set")), "a") \
            .join(sets.select(F.col("id").alias("b"), F.col("set").alias("b_set")), "b").select("a", "b", "a_set", "b_set")
        return both.mapInArrow(partial(_reached, percent=s.percent), "a bigint, b bigint").distinct()

    def across(rest: DataFrame) -> DataFrame:
        """Outsiders of large buckets beside all members, in blocks of about BLOCK hashes each."""
        rows = rest.join(sets_of(rest.select(F.col("id").alias("doc_id")).distinct()), "id") \
            .select("key", "outside", F.struct("id", "group", "set").alias("member"), F.length("set").alias("bytes"))
        rows = written(rows, "members")
        counts = rows.groupBy("key").agg(*[F.greatest(F.lit(1), F.ceil(F.sum(x) / (8 * BLOCK))).alias(n) for n, x in (
            ("blocks", F.col("bytes")), ("outer", F.when(F.col("outside"), F.col("bytes")).otherwise(0)))])
        placed = rows.join(counts, "key")
        dealt = lambda df, n, name: df.groupBy("key", F.pmod(F.xxhash64("member.id"), F.col(n)).alias("block")).agg(
            F.collect_list("member").alias(name)).select("key", name)
        both = dealt(placed.where("outside"), "outer", "outsiders").join(dealt(placed, "blocks", "members"), "key")
        return both.select("outsiders", "members").mapInArrow(partial(_block_links, percent=s.percent), "a bigint, b bigint").distinct()

    near = lambda a, b: 100 * F.least(f"n_{a}", f"n_{b}") >= s.percent * F.greatest(f"n_{a}", f"n_{b}")
    groups = linked(buckets, confirm, near, across)
    named = rows.select("doc_id", "n_shingles", "digest").join(kinds.select("digest", "id"), "digest", "left")
    named = written(named.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id")).alias("id")), "named")
    # A doc_id with several texts connects their groups.
    several = named.groupBy("doc_id").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    if not several.isEmpty():
        more = named.join(several, "doc_id").select(F.col("id").alias("a"), F.col("low").alias("b"))
        groups = components(groups.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
    component = F.coalesce("component", "id")
    return named.join(groups, "id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
