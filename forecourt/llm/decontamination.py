"""Benchmark passages inside documents: prefix-filtered join of item windows and document shingles."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.tables import appended, slices
from forecourt.sources.storage import written

#: Every ASCII byte but digits and letters ends a word; A-Z become a-z; bytes of other characters stay.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split() if text else []


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = words(text)
            if found:
                each = {b" ".join(found[k : k + size]) for k in range(max(1, len(found) - size + 1))}
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(each), pa.string()), pa.array(list(each), pa.binary())],
                                                 names=["item", "window"])


def _shingles(window: list[bytes]) -> list[tuple[bytes, ...]]:
    return list(zip(window, window[1:], strict=False)) or [(window[0],)]


def _counted(batches: Iterator[pa.RecordBatch], asked: Broadcast) -> Iterator[pa.RecordBatch]:
    """How often each shingle asked for occurs in these rows."""
    known = asked.value
    found: Counter = Counter()
    alone = any(len(k) == 1 for k in known)
    for batch in slices(batches, "text", 16 << 20):
        for text in batch.column(0).to_pylist():
            w = words(text)
            found.update(known[p] for p in zip(w, w[1:], strict=False) if p in known)
            if alone:
                found.update(known[p] for p in zip(w, strict=False) if p in known)
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())],
                                     names=["shingle", "n"])


def _marked(batches: Iterator[pa.RecordBatch], index: Broadcast, text: str, into: str, first: bool) -> Iterator[pa.RecordBatch]:
    """Rows with their hits by the windows of one block, beside those of earlier blocks."""
    prefixes = index.value
    alone = any(len(k) == 1 for k in prefixes)
    for batch in slices(batches, text, 16 << 20):
        before = [None] * batch.num_rows if first else batch.column(batch.schema.get_field_index(into)).to_pylist()
        out = []
        for x, old in zip(batch.column(batch.schema.get_field_index(text)).to_pylist(), before, strict=True):
            w = words(x)
            at = [(i, p) for i, p in enumerate(zip(w, w[1:], strict=False)) if p in prefixes]
            if alone:
                at += [(i, p) for i, p in enumerate(zip(w, strict=False)) if p in prefixes]
            spans, items = set(), set(old["items"] if old else ())
            for i, p in at:
                for offset, window, names in prefixes[p]:
                    start = i - offset
                    # The window must lie inside the document, and all its words must be there in order.
                    if start >= 0 and start + len(window) <= len(w) and w[start : start + len(window)] == window:
                        spans.add((start, start + len(window)))
                        items.update(names)
            if old:
                spans.update((s["start"], s["end"]) for s in old["spans"])
            merged: list[list[int]] = []
            for start, end in sorted(spans):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            out.append({"n_words": len(w), "n_hit": sum(e - s for s, e in merged),
                        "spans": [{"start": s, "end": e} for s, e in merged], "items": sorted(items)})
        yield appended(batch, **{into: pa.array(out, _ARROW)})


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, block: int = 50_000, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", into: str = "contamination") -> DataFrame:
    """`docs` with a struct: n_words, n_hit, spans (merged, in words), items (sorted, as strings) found inside.

    A window is `size` consecutive words of an item, or all of a shorter one. A set of shingles (word pairs)
    stands for a window, ordered by how rare they are in all documents. As every shingle of a window must
    occur, its prefix is one shingle, the rarest. A document shingle equal to a prefix gives a place where the
    window must lie; windows that pass either end of the document are dropped, the others are compared word
    by word. Items are taken in blocks of about `block` windows; a block is broadcast, so its size is
    bounded, and documents are scanned twice for each block and never shuffled.

    Null and empty texts: no words, no hits. Items without words or id: never found. Repeated items count once
    by id, repeated rows of `docs` each get their result. A column of `docs` named as `into` is replaced. Empty
    `docs`: no rows; an empty benchmark: no hits.
    """
    spark = docs.sparkSession
    docs = docs.drop(into)
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("text"))
    windows = written(items.where("item is not null").mapInArrow(partial(_windows, size=size), "item string, window binary")
                      .groupBy("window").agg(F.collect_set("item").alias("items")), "windows")
    blocks = max(1, -(-windows.count() // block))
    out, schema = docs, T.StructType([*docs.schema.fields, T.StructField(into, HITS)])
    for k in range(blocks):
        held = [(bytes(r.window).split(), r.items) for r in windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).collect()]
        number = {p: i for i, p in enumerate({p for w, _ in held for p in _shingles(w)})}
        asked = spark.sparkContext.broadcast(number)
        counts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(partial(_counted, asked=asked), "shingle bigint, n bigint") \
            .groupBy("shingle").agg(F.sum("n").alias("n")) if held else None
        n = dict(map(tuple, counts.collect())) if held else {}
        index: dict[tuple[bytes, ...], list] = {}
        for window, names in held:
            parts = _shingles(window)
            rare = min(range(len(parts)), key=lambda i: (n.get(number[parts[i]], 0), parts[i]))
            if n.get(number[parts[rare]], 0):
                index.setdefault(parts[rare], []).append((rare, window, names))
        out = out.mapInArrow(partial(_marked, index=spark.sparkContext.broadcast(index), text=text, into=into, first=k == 0), schema)
    return out
