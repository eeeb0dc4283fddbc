"""Cross-entropy difference of documents under a target and a background n-gram model with one vocabulary.

Texts are taken in blocks. A block asks for the counts of its distinct words, and then of its distinct word pairs: the
question carries the block's own counts, so that the same shuffle counts and answers. No model is held anywhere: the
tables of counts are parted by hash, and a block gets back what its own texts need.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.decontamination import words
from forecourt.llm.tables import FEW_IDS, slices
from forecourt.sources.storage import written

#: A word belongs to the vocabulary if it occurs so often in all texts.
LEAST = 3
#: Weight of a bigram's share beside the word's own probability.
LAMBDA = 0.7
#: Tokens of a block, or one text, and keys that are counted together in a task.
BLOCK, KEYS = 1 << 19, 1 << 20
#: In the place of the hash of a word that is not in the vocabulary.
UNKNOWN = np.int64(0)

_BLOCKS = "doc_ids array<bigint>, sizes binary, targets binary, words binary, places binary, n_words bigint, n bigint, n_target bigint, n_texts bigint, t_texts bigint"
_ASKED = "block bigint, part bigint, keys binary, counts binary"
_ANSWERED = "block bigint, part bigint, counts binary, known bigint, sums array<bigint>"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as hashed words: distinct ones, and for each token the place of its word among them."""
    held: list[tuple[int | None, np.ndarray, bool]] = []

    def packed() -> pa.RecordBatch:
        sizes = np.array([len(h) for _, h, _ in held], np.int64)
        targets = np.array([t for *_, t in held], np.uint8)
        found, places = np.unique(np.concatenate([h for _, h, _ in held]), return_inverse=True)
        small = np.uint16 if len(found) <= 1 << 16 else np.uint32
        some, mine = sizes > 0, targets > 0
        numbers = [len(found), sizes.sum(), sizes[mine].sum(), some.sum(), (some & mine).sum()]
        columns = [[[i for i, *_ in held]], *[[x.tobytes()] for x in (sizes, targets, found, places.astype(small))], *[[int(x)] for x in numbers]]
        kinds = [pa.list_(pa.int64()), *[pa.binary()] * 4, *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                          names=[c.split()[0] for c in _BLOCKS.split(", ")])

    size = 0
    for batch in slices(batches, "text", 8 << 20):
        for doc_id, text, target in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words(text)], np.uint64).view(np.int64)
            if held and (size + len(hashes) > BLOCK or len(held) >= BLOCK >> 4):
                yield packed()
                held.clear()
                size = 0
            held.append((doc_id, hashes, bool(target)))
            size += len(hashes)
    if held:
        yield packed()


def _short(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest needs, all first bytes before all second ones: most of those are zero and
    vanish when the rows are compressed."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    return np.ascontiguousarray(counts, kind).reshape(-1).view(np.uint8).reshape(-1, kind.itemsize).T.tobytes()


def _long(raw: bytes, kinds: int, n: int) -> np.ndarray:
    size = len(raw) // (kinds * n)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(f"u{size}").reshape(kinds, n).astype(np.int64)


class Block:
    """A block's texts, and the counts that its words and pairs have."""

    def __init__(self, row: dict):
        self.id, self.doc_ids = row["block"], row["doc_ids"]
        self.sizes, self.targets = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["targets"], np.uint8) > 0
        self.words, n = np.frombuffer(row["words"], np.int64), int(self.sizes.sum())
        self.places = np.frombuffer(row["places"], np.uint16 if len(row["places"]) == 2 * n else np.uint32).astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        self.begins = (self.ends - self.sizes)[self.sizes > 0]
        self.target = np.repeat(self.targets, self.sizes)

    def word_counts(self) -> np.ndarray:
        """Of each word: n and n of the target, and how often another word follows, in all and in the target."""
        last = np.zeros(len(self.places), bool)
        last[self.ends[self.sizes > 0] - 1] = True
        return np.stack([np.bincount(self.places[chosen], minlength=len(self.words))
                         for chosen in (slice(None), self.target, ~last, ~last & self.target)])

    def pairs(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of known or unknown words, where they stand, and how often in all and in the target."""
        word = np.where(counts[0] >= LEAST, self.words, UNKNOWN).view(np.uint64)[self.places]
        both = word[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ (word[1:] << np.uint64(31) | word[1:] >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
        inside = np.ones(max(len(word) - 1, 0), bool)
        inside[self.begins[1:] - 1] = False
        found, at = np.unique(both[inside].view(np.int64), return_inverse=True)
        counted = np.stack([np.bincount(at, minlength=len(found)), np.bincount(at[self.target[1:][inside]], minlength=len(found))])
        return found, at, counted


def _dealt(keys: np.ndarray, parts: int) -> list[np.ndarray]:
    """The places of the keys of each part."""
    part = (keys.view(np.uint64) >> np.uint64(20)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    return np.split(order, np.searchsorted(part[order], np.arange(1, parts)))


def _questions(block: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    rows = [(block, p, keys[at].tobytes(), _short(counts[:, at])) for p, at in enumerate(_dealt(keys, parts)) if len(at)]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["block", "part", "keys", "counts"])


def _answers(table: pa.Table, kinds: int, unknown: bool) -> pa.Table:
    """All blocks' questions of a part: each gets the sums over all blocks, and the first row the sums over known keys."""
    keys = [np.frombuffer(k, np.int64) for k in table.column("keys").to_pylist()]
    counts = [_long(c, kinds, len(k)) for c, k in zip(table.column("counts").to_pylist(), keys, strict=True)]
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    every = np.concatenate(counts, axis=1)
    sums = np.stack([np.bincount(at, every[k], len(found)) for k in range(kinds)]).astype(np.int64)
    known = sums[0] >= LEAST
    ends = np.cumsum([len(k) for k in keys])
    # Of an unknown word it is enough to know that it is one.
    told = np.where(known, sums, 0) if unknown else sums
    answers = [_short(told[:, at[e - len(k) : e]]) for k, e in zip(keys, ends, strict=True)]
    first = [[int(known.sum())] + [0] * (len(keys) - 1), [sums[:, known].sum(1).tolist()] + [[0] * kinds] * (len(keys) - 1)]
    return pa.table([table.column("block"), table.column("part"), pa.array(answers, pa.binary()), pa.array(first[0], pa.int64()),
                     pa.array(first[1], pa.list_(pa.int64()))], names=["block", "part", "counts", "known", "sums"])


def _gathered(keys: np.ndarray, answers: list[dict] | None, parts: int, kinds: int) -> np.ndarray:
    """The answers of all parts in the order of a block's keys."""
    out, places = np.zeros((kinds, len(keys)), np.int64), _dealt(keys, parts)
    for a in answers or []:
        at = places[a["part"]]
        out[:, at] = _long(a["counts"], kinds, len(at))
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _ask_words(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for block in map(Block, _rows(batches)):
        yield _questions(block.id, block.words, block.word_counts(), parts)


def _ask_pairs(batches: Iterator[pa.RecordBatch], word_parts: int, parts: int) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        block = Block(row)
        found, _, counted = block.pairs(_gathered(block.words, row["word_answers"], word_parts, 4))
        yield _questions(block.id, found, counted, parts)


def _scored(batches: Iterator[pa.RecordBatch], word_parts: int, parts: int, total: tuple, known: int, sums: tuple) -> Iterator[pa.RecordBatch]:
    """Mean losses of a block's texts. A word's probability is its share, one count added for each word of the vocabulary;
    after a word, LAMBDA of the bigram's share of that word counts, and the rest goes to words by their own
    probability: both models sum to one over the vocabulary."""
    for row in _rows(batches):
        block = Block(row)
        counts = _gathered(block.words, row["word_answers"], word_parts, 4)
        found, at, _ = block.pairs(counts)
        double = _gathered(found, row["pair_answers"], parts, 2)
        # The unknown word has what the known ones leave.
        counts = np.where(counts[0] >= LEAST, counts, np.array([[t - s] for t, s in zip(total, sums, strict=True)]))
        follows = np.ones(len(block.places), bool)
        follows[block.begins] = False
        some, means = block.sizes > 0, []
        for single, after, pair, of in ((counts[1], counts[3], double[1], total[1]), (counts[0], counts[2], double[0], total[0])):
            alone = ((single + 1.0) / (of + known + 1))[block.places]
            above = np.maximum(single, 1)
            first = block.places[:-1][follows[1:]]
            alone[follows] = LAMBDA * pair[at] / above[first] + (1 - LAMBDA * after[first] / above[first]) * alone[follows]
            means.append(np.add.reduceat(-np.log2(alone), block.begins) / block.sizes[some] if some.any() else np.empty(0))
        place, out = np.cumsum(some) - 1, []
        for k, size in enumerate(block.sizes.tolist()):
            a, b = (float(m[place[k]]) for m in means) if size else (None, None)
            out.append((block.doc_ids[k], size, a, b, a - b if size else None))
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                         names=["doc_id", "n_tokens", "target_bits", "background_bits", "difference"])


def scored(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_bits, background_bits, difference for each row of `docs`: mean loss of a token under a
    bigram model of the documents in `target_ids` and under one of all documents; the lower the difference, the more a
    document is like the target.

    Words that occur LEAST times in all documents, and every bigram of them, are the models' one vocabulary; other words
    are one unknown word. Counts are exact at every size, and there is one way to them: blocks of texts ask for their
    distinct words and pairs, parted by hash, and the answer is the sum of all questions. A task holds a block, or the
    keys of a part, about KEYS of them; a word that a third of all texts hold is one key for each block. Target documents are
    scored with the model that has seen them.

    Null texts and texts without words: 0 tokens, nulls. Repeated rows count and are scored each; a repeated or null
    target id changes nothing. No target: its model is the same for all words. No rows: no rows.
    """
    ids = target_ids.select(F.col(target_ids.columns[0]).cast("bigint").alias("target_id")).where("target_id is not null").distinct()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = F.broadcast(ids) if ids.count() <= FEW_IDS else ids
    marked = rows.join(ids, F.col("doc_id") == F.col("target_id"), "left").select("doc_id", "text", F.col("target_id").isNotNull().alias("target"))
    blocks = written(marked.mapInArrow(_blocks, _BLOCKS).withColumn("block", F.monotonically_increasing_id()), "blocks")
    size = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_words", "n", "n_target", "n_texts", "t_texts")]).first()
    word_parts, parts = (max(1, -(-k // KEYS)) for k in (size.n_words, size.n))

    def answered(asked: DataFrame, kinds: int) -> DataFrame:
        return written(asked.groupBy("part").applyInArrow(lambda table: _answers(table, kinds, kinds == 4), _ANSWERED), "answers")

    def with_answers(of: DataFrame, answers: DataFrame, name: str) -> DataFrame:
        each = answers.groupBy("block").agg(F.collect_list(F.struct("part", "counts")).alias(name))
        return of.join(each, "block", "left")

    of_words = answered(blocks.mapInArrow(partial(_ask_words, parts=word_parts), _ASKED), 4)
    held = of_words.agg(F.coalesce(F.sum("known"), F.lit(0)), *[F.coalesce(F.sum(F.col("sums")[k]), F.lit(0)) for k in range(4)]).first()
    known = with_answers(blocks, of_words, "word_answers")
    of_pairs = answered(known.mapInArrow(partial(_ask_pairs, word_parts=word_parts, parts=parts), _ASKED), 2)
    total = (size.n, size.n_target, size.n - size.n_texts, size.n_target - size.t_texts)
    return with_answers(known, of_pairs, "pair_answers").mapInArrow(
        partial(_scored, word_parts=word_parts, parts=parts, total=total, known=held[0], sums=tuple(held[1:])),
        "doc_id bigint, n_tokens bigint, target_bits double, background_bits double, difference double")
