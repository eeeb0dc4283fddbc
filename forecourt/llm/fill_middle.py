"""Fill-in-middle: every text cut into prefix, middle and suffix and put in another order, by displacement of its bytes.

Cuts and forms are columns of Spark's own functions. The bytes of a batch of texts move at once: the places where a
text or a part of one starts carry by how much the distance to the output changes there, their running sum is each
byte's displacement, and one scatter builds all outputs. The way back finds the marks and gathers with the inverse.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.tables import appended

MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
#: The parts of each form in the order of the output; a mark stands before each.
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
PARTS = ("prefix", "middle", "suffix")
#: Bytes of text that move together, and of them those whose displacements are held at a time.
TOGETHER, BLOCK = 4 << 20, 1 << 20
_MARK = 3

PLAN = T.StructType([T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                     T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                     T.StructField("output", T.StringType())])
_ARROW = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                    ("output", pa.string())])


def planned(docs: DataFrame, seed: int = 1, percent: int = 90, spm_percent: int = 20, doc_id: str = "doc_id",
            text: str = "text", into: str = "fim") -> DataFrame:
    """`docs` with a struct of n, form, prefix_chars and middle_chars; its output is the text as it is.

    Four numbers from the hash of seed and id choose the cuts, whether the text is changed, and the order of its parts.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    n = F.char_length(whole).cast("bigint")
    cuts = [h[0] % (n + 1), h[1] % (n + 1)]
    first, last = F.least(*cuts), F.greatest(*cuts)
    marked = whole.contains(MARKS["prefix"]) | whole.contains(MARKS["suffix"]) | whole.contains(MARKS["middle"])
    form = F.when((n == 0) | marked | (h[2] % 100 >= percent), "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    cut = lambda chars: F.when(form != "plain", chars)
    return docs.withColumn(into, F.struct(n.alias("n"), form.alias("form"), cut(first).alias("prefix_chars"),
                                          cut(last - first).alias("middle_chars"), whole.alias("output")))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of strings without nulls, and where each starts and ends in them."""
    texts = texts.cast(pa.large_string())
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.empty(0, np.uint8)
    return held, at - at[0]


def _strings(held: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(held)]).cast(pa.string())


def _together(batches: Iterator[pa.RecordBatch], into: str) -> Iterator[tuple[pa.RecordBatch, pa.StructArray]]:
    """Batches whose texts take about TOGETHER bytes, or one row, with the struct of their plan."""
    for batch in batches:
        if not batch.num_rows:
            continue
        plan = batch.column(batch.schema.get_field_index(into))
        _, at = _bytes(plan.field("output"))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(at, at[start] + TOGETHER, "right")) - 1)
            yield batch.slice(start, end - start), plan.slice(start, end - start)
            start = end


def _places(held: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The byte at which the code points of these numbers start; a number past the last one gives the end."""
    order = np.argsort(ranks, kind="stable")
    found, seen, done = np.full(len(ranks), len(held), np.int64), 0, 0
    for block in range(0, len(held), BLOCK):
        starts = np.flatnonzero((held[block : block + BLOCK] & 0xC0) != 0x80)
        here = int(np.searchsorted(ranks[order], seen + len(starts), "left"))
        found[order[done:here]] = block + starts[ranks[order[done:here]] - seen]
        done, seen = here, seen + len(starts)
    return found


def _displaced(size: int, starts: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Blocks of `size` bytes with where each goes: every byte from a start on, up to the next, is shifted alike.

    Starts ascend; of equal ones, which begin empty parts, the last counts.
    """
    last = np.append(starts[1:] != starts[:-1], True) & (starts < size)
    starts, changes = starts[last], np.diff(shifts[last], prepend=0)
    carried = 0
    for block in range(0, size, BLOCK):
        end = min(size, block + BLOCK)
        change = np.zeros(end - block, np.int64)
        low, high = np.searchsorted(starts, [block, end])
        change[starts[low:high] - block] = changes[low:high]
        change[0] += carried
        shift = np.cumsum(change)
        carried = shift[-1]
        yield slice(block, end), np.arange(block, end) + shift


def _moved(held: np.ndarray, at: np.ndarray, forms: list[str], cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All outputs of texts and where each starts; cuts: the bytes where prefix and middle of each text end."""
    changed = np.array([f in ORDERS for f in forms], bool)
    begins = np.stack([at[:-1], np.where(changed, cuts[0], at[:-1]), np.where(changed, cuts[1], at[:-1])])
    ends = np.stack([np.where(changed, cuts[0], at[1:]), np.where(changed, cuts[1], at[1:]), at[1:]])
    sizes = ends - begins
    out_at = np.concatenate([[0], np.cumsum(np.diff(at) + len(MARKS) * _MARK * changed)])
    out = np.empty(out_at[-1], np.uint8)
    shifts = np.tile(out_at[:-1] - at[:-1], (3, 1))
    for form, order in ORDERS.items():
        rows = np.flatnonzero([f == form for f in forms])
        place = out_at[rows]
        for part in order:
            k = PARTS.index(part)
            for i, byte in enumerate(MARKS[part].encode()):
                out[place + i] = byte
            place = place + _MARK
            shifts[k, rows] = place - begins[k, rows]
            place = place + sizes[k, rows]
    for block, to in _displaced(len(held), begins.T.ravel(), shifts.T.ravel()):
        out[to] = held[block]
    return out, out_at


def _scattered(batches: Iterator[pa.RecordBatch], into: str) -> Iterator[pa.RecordBatch]:
    for batch, plan in _together(batches, into):
        held, at = _bytes(plan.field("output"))
        n, form = plan.field("n").to_numpy(), plan.field("form").to_pylist()
        first = np.concatenate([[0], np.cumsum(n)])[:-1]
        prefix, middle = (plan.field(c).fill_null(0).to_numpy() for c in ("prefix_chars", "middle_chars"))
        # A cut at the end of a text is the start of the next one: the same byte.
        places = _places(held, np.concatenate([first + prefix, first + prefix + middle]))
        out = _strings(*_moved(held, at, form, places.reshape(2, -1)))
        fields = [plan.field(c) for c in ("n", "form", "prefix_chars", "middle_chars")]
        yield appended(batch, **{into: pa.StructArray.from_arrays([*fields, out], fields=list(_ARROW))})


def _marks(out: np.ndarray) -> np.ndarray:
    """Where the bytes of a mark stand."""
    names = [ord(m[1]) for m in MARKS.values()]
    found = []
    for block in range(0, max(0, len(out) - _MARK + 1), BLOCK):
        b = out[block : block + BLOCK + _MARK - 1]
        found.append(block + np.flatnonzero((b[:-2] == ord("<")) & (b[2:] == ord(">")) & np.isin(b[1:-1], names)))
    return np.concatenate(found) if found else np.empty(0, np.int64)


def _restored(batches: Iterator[pa.RecordBatch], into: str, restored: str) -> Iterator[pa.RecordBatch]:
    """The text of every output, from the output and its form alone."""
    for batch, plan in _together(batches, into):
        out, at = _bytes(plan.field("output"))
        forms = plan.field("form").to_pylist()
        changed = np.flatnonzero([f in ORDERS for f in forms])
        marks = _marks(out)
        row = np.searchsorted(at, marks, "right") - 1
        marks = marks[np.isin(row, changed) & (marks + _MARK <= at[row + 1])].reshape(-1, len(MARKS))
        begins, ends = (np.tile(x, (3, 1)) for x in (at[:-1], at[:-1]))
        ends[0] = at[1:]  # a plain text is its own prefix
        for form, order in ORDERS.items():
            own = np.array([forms[i] == form for i in changed], bool)
            rows = changed[own]
            for j, part in enumerate(order):
                k = PARTS.index(part)
                begins[k, rows] = marks[own, j] + _MARK
                ends[k, rows] = marks[own, j + 1] if j + 1 < len(order) else at[rows + 1]
        sizes = (ends - begins).T
        text_at = np.concatenate([[0], np.cumsum(sizes.sum(1))])
        goes = text_at[:-1, None] + np.cumsum(sizes, 1) - sizes
        text = np.empty(text_at[-1], np.uint8)
        for block, source in _displaced(len(text), goes.ravel(), (begins.T - goes).ravel()):
            text[block] = out[source]
        yield appended(batch, **{restored: _strings(text, text_at)})


def transformed(docs: DataFrame, seed: int = 1, percent: int = 90, spm_percent: int = 20, doc_id: str = "doc_id",
                text: str = "text", into: str = "fim") -> DataFrame:
    """`docs` with a struct: n (code points), form, prefix_chars, middle_chars (null if plain) and output.

    Of 100 texts `percent` are cut at two places chosen by hash, `spm_percent` of those with the suffix first; every
    part follows its mark. Empty texts and texts that contain a mark stay plain. No shuffle, no state: a lost task is
    repeated alone, and a task holds a few megabytes beside its longest text.

    A null text is empty, a null id hashes as an empty one. Repeated rows get equal results. A column named as `into`
    is replaced, no other column plays a part. Empty `docs`: no rows.
    """
    plan = planned(docs, seed, percent, spm_percent, doc_id, text, into)
    return plan.mapInArrow(partial(_scattered, into=into), T.StructType(
        [f for f in plan.schema.fields if f.name != into] + [T.StructField(into, PLAN)]))


def restored(changed: DataFrame, into: str = "fim", out: str = "restored") -> DataFrame:
    """`changed` with the text that each output was made from, rebuilt from output and form alone."""
    changed = changed.drop(out)
    return changed.mapInArrow(partial(_restored, into=into, restored=out), T.StructType(
        [*changed.schema.fields, T.StructField(out, T.StringType())]))
