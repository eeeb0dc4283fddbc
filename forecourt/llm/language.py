"""Language of a text by prediction by partial matching: frozen byte context trees, exact code lengths."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.tables import FEW_IDS, appended, slices

UNKNOWN = "und"
#: Longest context in bytes; a context with its symbol then fits 32 bits.
ORDER = 3
_LETTERS = re.compile(r"[^\W\d_]+")


def spelled(text: str | None) -> bytes:
    """Runs of letters in lower case between spaces, after a start of ORDER spaces; empty without letters."""
    found = _LETTERS.findall(text.lower()) if text else []
    if not all(map(str.isalpha, found)):  # numbers such as a raised two count as word characters, and are no letters
        found = "".join(c if c.isalpha() else " " for c in " ".join(found)).split()
    return b" " * ORDER + " ".join(found).encode("utf-8", "replace") + b" " if found else b""


def grams(raw: bytes, at: int, end: int) -> list[np.ndarray]:
    """For each order the contexts with their symbols, as numbers, of the symbols raw[at:end]."""
    data = np.frombuffer(raw, np.uint8)[at - ORDER : end].astype(np.uint32)
    out = [data[ORDER:]]
    for k in range(1, ORDER + 1):
        out.append(out[-1] | data[ORDER - k : len(data) - k] << np.uint32(8 * k))
    return out


def sampled(docs: DataFrame, rows: int) -> DataFrame:
    """At most `rows` labelled texts of each language, in the order of a hash of their id.

    A share of the ids keeps about twice as many before the exact cut, so no task gets all texts of a language.
    Every language is learned, however few of the labelled texts are in it.
    """
    named = docs.where("lang is not null and text is not null and doc_id is not null")
    counts = named.groupBy("lang").agg(F.count("*").alias("n"))
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    few = named.join(F.broadcast(counts) if counts.count() <= FEW_IDS else counts, "lang").where(spot * F.col("n") <= F.lit(2.0 * rows + 50))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    return few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= rows).select("lang", "text")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = spelled(text)
            if raw:
                for k, found in enumerate(grams(raw, ORDER, len(raw))):
                    gram, n = np.unique(found, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram), pa.string()), pa.array(np.full(len(gram), k, np.int32)),
                         pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "size", "gram", "n"])


class Table:
    """Numbers of 32-bit keys: open addressing, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * max(1, len(keys)) - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint32)
        self.number = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(left):
            free = self.number[slot] < 0
            # Of the keys that want a free slot the last one written gets it.
            self.number[slot[free]] = left[free]
            won = self.number[slot] == left
            self.keys[slot[won]] = keys[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435761)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if there is none."""
        slot = self._slot(keys)
        found = self.number[slot]
        open_ = np.flatnonzero((found >= 0) & (self.keys[slot] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            now = self.number[slot[open_]]
            found[open_] = now
            open_ = open_[(now >= 0) & (self.keys[slot[open_]] != keys[open_])]
        return found


@dataclass
class Model:
    """Frozen statistics: for each order, code lengths in bits of known symbols and of escapes, a column a language."""

    langs: list[str]
    symbols: list[Table]
    bits: list[np.ndarray]
    contexts: list[Table]
    escapes: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple[str, int, int, int]]) -> Model:
        langs = sorted({r[0] for r in rows})
        column = {x: i for i, x in enumerate(langs)}
        symbols, bits, contexts, escapes = [], [], [], []
        lower = None
        for k in range(ORDER + 1):
            some = [r for r in rows if r[1] == k]
            keys = np.array(sorted({r[2] for r in some}), np.uint32)
            count = np.zeros((len(keys), len(langs)))
            place = np.searchsorted(keys, np.array([r[2] for r in some], np.uint32))
            count[place, [column[r[0]] for r in some]] = [r[3] for r in some]
            # The context is the gram without its last byte, the symbol.
            above, context = np.unique(keys >> np.uint32(8), return_inverse=True)
            total, distinct = np.zeros((len(above), len(langs))), np.zeros((len(above), len(langs)))
            np.add.at(total, context, count)
            np.add.at(distinct, context, count > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + distinct) / distinct), 0.0)
                known = np.log2((total + distinct)[context] / count)
            # A symbol that a language has not seen here escapes to the next lower order; below all, bytes are equal.
            if lower is None:
                below = np.full((len(keys), len(langs)), 8.0)
            else:
                below = lower[1][np.searchsorted(lower[0], keys & np.uint32((1 << 8 * k) - 1))]
            cost = np.where(count > 0, known, escape[context] + below)
            lower = keys, cost
            symbols.append(Table(keys))
            bits.append(cost.astype(np.float32))
            contexts.append(Table(above))
            escapes.append(escape.astype(np.float32))
        return cls(langs, symbols, bits, contexts, escapes)

    def lengths(self, raw: bytes, at: int, end: int) -> np.ndarray:
        """Code length in bits of each symbol of raw[at:end] in each language."""
        found = grams(raw, at, end)
        out = np.zeros((end - at, len(self.langs)), np.float32)
        left = np.arange(end - at)
        for k in range(ORDER, -1, -1):
            keys = found[k] if len(left) == end - at else found[k][left]
            number = self.symbols[k].find(keys)
            seen = number >= 0
            if k == ORDER and seen.all():
                return self.bits[k][number]
            out[left[seen]] += self.bits[k][number[seen]]
            left, keys = left[~seen], keys[~seen]
            if not len(left):
                return out
            context = self.contexts[k].find(keys >> np.uint32(8))
            known = context >= 0
            out[left[known]] += self.escapes[k][context[known]]
        out[left] += 8.0
        return out

    def costs(self, many: list[bytes], chunk: int = 1 << 18) -> np.ndarray:
        """Code length of each text in each language; long texts go in chunks, short ones together."""
        out = np.zeros((len(many), len(self.langs)))
        held: list[int] = []
        size = 0
        for i, raw in enumerate([*many, None]):
            if held and (raw is None or size + len(raw) > chunk):
                joined = b"".join(many[h] for h in held)
                starts = np.cumsum([0] + [len(many[h]) for h in held[:-1]])
                for at in range(ORDER, len(joined), chunk):
                    end = min(len(joined), at + chunk)
                    rows = self.lengths(joined, at, end)
                    # The spaces before a text are not symbols of it.
                    for j in range(ORDER):
                        lead = starts + j - at
                        rows[lead[(lead >= 0) & (lead < end - at)]] = 0
                    inside = np.searchsorted(starts, at, "right") - 1
                    cuts = np.concatenate([[0], starts[(starts > at) & (starts < end)] - at])
                    parts = np.add.reduceat(rows, cuts, axis=0, dtype=np.float64)
                    out[[held[inside + j] for j in range(len(parts))]] += parts
                held, size = [], 0
            if raw:
                held.append(i)
                size += len(raw)
        return out


def trained(docs: DataFrame, rows: int = 400) -> Broadcast:
    """A model of the languages of `docs` (doc_id, text, lang), from at most `rows` whole texts of each.

    The counts of contexts come from Spark; their number is bounded by the bytes of the sample.
    """
    counts = sampled(docs, rows).mapInArrow(_counted, "lang string, size int, gram bigint, n bigint") \
        .groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    return docs.sparkSession.sparkContext.broadcast(
        Model.of(list(zip(found["lang"], found["size"], found["gram"], found["n"], strict=True))))


def _predicted(batches: Iterator[pa.RecordBatch], model: Broadcast, text: str, into: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    known: Model = model.value
    for batch in slices(batches, text, 4 << 20):
        raw = [spelled(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        langs, scores = [UNKNOWN] * len(raw), np.zeros(len(raw))
        if known.langs:
            costs = known.costs(raw)
            best = costs.argmin(axis=1)
            with np.errstate(under="ignore"):
                share = 1 / np.exp2(-np.minimum(costs - costs.min(axis=1, keepdims=True), 1000)).sum(axis=1)
            for i, r in enumerate(raw):
                if r:
                    langs[i], scores[i] = known.langs[best[i]], share[i]
        yield appended(batch, **{into[0]: pa.array(langs, pa.string()), into[1]: pa.array(scores)})


def predicted(docs: DataFrame, model: Broadcast, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """`docs` with the language that codes its text in the fewest bits, and the probability of that language given
    the code lengths, all languages being as likely beforehand.

    Letters in lower case are coded, other characters are one space. Null texts, texts without letters, and any text
    where the model knows no language: `und`, score 0. Ties: the language first by name. Columns of `docs` named as
    `into` are replaced. No rows: no rows. Nothing but the text is used.
    """
    plain = docs.drop(*into)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(partial(_predicted, model=model, text=text, into=into), f"{schema}, `{into[0]}` string, `{into[1]}` double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is never learned from; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
