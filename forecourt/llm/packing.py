"""Token sequences of one length: bounded-space online packing of documents."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.tables import slices, texts
from forecourt.sources.storage import written

PIECE = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, task bigint, window bigint, offset bigint"

#: Texts of these characters alone are cut into pieces here; their pieces are what the vocabulary's own rules give.
_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\xc0-\\xff]*")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_LETTERS = re.compile(r"[^\W\d_]+")
#: Byte-level vocabularies write a byte as its own character if that can be seen, else as one from 256 on, in order.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SEEN)}


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit numbers, with the ids of recent pieces kept.

    White space ends a piece and a piece's ids depend on nothing else, so texts of plain characters are cut
    into pieces and each piece is encoded once while it is kept. Two generations of at most `most` pieces bound the
    memory: a full young one becomes the old one. All other texts go through the tokenizer whole.
    """

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, pieces: list[str]) -> None:
        """Words of letters go to the merges at once, as the characters that stand for their bytes."""
        merge = self.tokenizer.model.tokenize
        for p in pieces:
            if _LETTERS.fullmatch(p):
                some = merge(p if p.isascii() else p.encode().decode("latin-1").translate(_BYTES))
                self.young[p] = np.array([t.id for t in some], "<u4").tobytes()
            else:
                self.young[p] = self.whole(p)

    def pieces(self, text: str) -> list[str] | None:
        if "<|" in text or not _PLAIN.fullmatch(text) or not unicodedata.is_normalized("NFC", text):
            return None
        return _PIECES.findall(text.lower())

    def many(self, some: list[str]) -> list[bytes]:
        cut = [self.pieces(t) for t in some]
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young, old, missing = self.young, self.old, []
        for p in set().union(*(c for c in cut if c)):
            if p not in young:
                if p in old:
                    young[p] = old[p]
                else:
                    missing.append(p)
        self.learn(missing)
        get = self.young.__getitem__
        return [self.whole(t) if c is None else b"".join(map(get, c)) for t, c in zip(some, cut, strict=True)]


_MADE: dict[str, Ids] = {}


class Windows:
    """At most `most` open windows: best fit, and the fullest leaves when nothing fits."""

    def __init__(self, size: int, most: int, emit: Callable[[list], None]):
        self.size, self.most, self.emit = size, most, emit
        self.open: list[tuple[int, list]] = []

    def place(self, n: int, thing: object) -> None:
        if n == self.size:
            self.emit([thing])
            return
        fits = [k for k, (used, _) in enumerate(self.open) if used + n <= self.size]
        if fits:
            k = max(fits, key=lambda k: self.open[k][0])
            used, held = self.open.pop(k)
            if used + n == self.size:
                self.emit([*held, thing])
            else:
                self.open.append((used + n, [*held, thing]))
            return
        if len(self.open) == self.most:
            k = max(range(self.most), key=lambda k: self.open[k][0])
            self.emit(self.open.pop(k)[1])
        self.open.append((n, [thing]))


def _placed(batches: Iterator[pa.RecordBatch], path: str, size: int, most: int, last: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    if path not in _MADE:
        _MADE[path] = Ids(path)
    done: list[tuple] = []
    count = 0

    def emit(held: list, left: bool = False) -> None:
        nonlocal count
        offset = 0
        for doc, start, raw, total in held:
            # Windows that were still open at the end have negative numbers.
            done.append((doc, start, len(raw) // 4, raw, total, task, -1 - count if left else count, offset))
            offset += len(raw) // 4
        count += 1

    def batch() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        columns = zip(*done, strict=True) if done else [()] * 8
        names = [c.split()[0] for c in PIECE.split(", ")]
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        done.clear()
        return made

    windows = Windows(size, most, emit)
    for rows in slices(batches, "text", 1 << 20):
        some = [t or "" for t in rows.column(1).to_pylist()]
        for doc, raw in zip(rows.column(0).to_pylist(), _MADE[path].many(some), strict=True):
            raw += np.array([last], "<u4").tobytes()
            total = len(raw) // 4
            for start in range(0, total, size):
                piece = raw[4 * start : 4 * (start + size)]
                windows.place(len(piece) // 4, (doc, start, piece, total))
        if done:
            yield batch()
    for _, held in windows.open:
        emit(held, left=True)
    yield batch()


def _merged(batches: Iterator[pa.RecordBatch], size: int, most: int) -> Iterator[pa.RecordBatch]:
    """Open windows of several partitions packed as they are: where each goes, and from which offset on."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    done: list[tuple] = []
    count = 0

    def emit(held: list) -> None:
        nonlocal count
        base = 0
        for old, window, n in held:
            done.append((old, window, task, count, base))
            base += n
        count += 1

    windows = Windows(size, most, emit)
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        for old, window, n in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
            windows.place(n, (old, window, n))
    for _, held in windows.open:
        emit(held)
    columns = zip(*done, strict=True) if done else [()] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["task", "window", "to_task", "to_window", "base"])


def packed(docs: DataFrame, tokenizer: str, size: int = 2048, open_windows: int = 64, end_id: int = 1,
           leftovers: int = 4096) -> DataFrame:
    """Pieces of documents in sequences of at most `size` tokens: doc_id, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset.

    A document's ids and `end_id` are cut at multiples of `size`; whole pieces are sequences of their own. The rest
    of each document goes to the open window with the least room that still holds it; when none does, the fullest
    of `open_windows` leaves and a new one is opened. Windows open at the end of a partition are merged, about
    `leftovers` of them in a task, by the same rule. Text never moves between partitions; only the layout of the
    leftovers does. Numbers of sequences are unique, not consecutive, and the same for the same partitions of `docs`.
    The placed pieces are written once: neither a lost executor nor the merge encodes a text again.

    Null and empty texts: one piece of the end id alone. Repeated rows are packed each. Ties between windows go to
    the one changed least recently. No rows: no rows.
    """
    rows = texts(docs)
    pieces = written(rows.mapInArrow(partial(_placed, path=tokenizer, size=size, most=open_windows, last=end_id), PIECE), "pieces")
    left = pieces.where("window < 0").groupBy("task", "window").agg(F.sum("length").alias("n"))
    tasks = max(1, -(-left.count() // leftovers))
    # One partition for each `leftovers` windows; their order inside is by content, so a second try gives the same.
    moved = written(left.repartition(tasks, F.pmod(F.xxhash64("task", "window"), F.lit(tasks)))
                    .sortWithinPartitions(F.desc("n"), "task", "window")
                    .mapInArrow(partial(_merged, size=size, most=open_windows),
                                "task bigint, window bigint, to_task bigint, to_window bigint, base bigint"), "moved")
    number = lambda kind, task, window: F.shiftleft(task, 34) + F.shiftleft(window, 1) + F.lit(kind)
    whole = pieces.where("window >= 0").withColumn("sequence_id", number(0, F.col("task"), F.col("window")))
    rest = pieces.where("window < 0").join(moved, ["task", "window"]) \
        .withColumn("sequence_id", number(1, F.col("to_task"), F.col("to_window"))).withColumn("offset", F.col("offset") + F.col("base"))
    columns = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return whole.select(columns).unionByName(rest.select(columns))
