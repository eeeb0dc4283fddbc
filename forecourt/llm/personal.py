"""Personal data in texts: fixed patterns, and more spans by a semi-Markov conditional random field."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.tables import appended, slices

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

# The patterns of the base spans. A run of digits is tried from its start only, where a match of
# `ip` must begin; the part of an address before @ is taken from the @ backwards.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text[start - 1]):
            start -= 1
        end = _DOMAIN.match(text, at + 1) if start < at else None
        if end:
            out.append(("email", start, end.end()))
            last = end.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that do not overlap others of it, in the order of KINDS, then start."""
    out = _emails(text)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


_TOKEN = re.compile(r"[^\W\d_]+|\d+|\s|[^\w\s]|_")
#: Where an entity may be: long numbers, numbers with the signs of `_variants` in between, addresses as such or spelled out.
_TRIGGER = re.compile(r"[0-9][0-9().\x20/\[\]-]{5,}[0-9]|@|[(\[]at[)\]]", re.I)
#: Tokens of an entity, at most; as many are shown on either side of a trigger.
MOST_TOKENS = 24
_AT = re.compile(r"\s*[(\[]at[)\]]\s*|@", re.I)
_DOT = re.compile(r"\s*[(\[]dot[)\]]\s*", re.I)


def _before(text: str, at: int) -> int:
    """Where the MOST_TOKENS tokens before a place begin."""
    reach = 8 * MOST_TOKENS
    while True:
        lo = max(0, at - reach)
        starts = [m.start() for m in _TOKEN.finditer(text, lo, at)]
        # The first one may be the end of a longer token.
        if len(starts) > MOST_TOKENS:
            return starts[-MOST_TOKENS]
        if not lo:
            return 0
        reach *= 2


def _after(text: str, at: int) -> int:
    """Where the MOST_TOKENS tokens after a place end."""
    return max((m.end() for m in islice(_TOKEN.finditer(text, at), MOST_TOKENS)), default=at)


def regions(text: str) -> list[tuple[int, int]]:
    """Places around triggers, merged where they meet: nothing outside of them can be an entity."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        lo, hi = _before(text, m.start()), _after(text, m.end())
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def _count(n: int) -> str:
    return next(str(top) for top in (3, 6, 8, 9, 10, 11, 12, 15, 19, 10**9) if n <= top)


def features(text: str, start: int, end: int) -> list[str]:
    """What a whole span looks like, and what stands beside it."""
    span = text[start:end]
    digits = re.sub(r"[^0-9]", "", span)
    inner = sorted(set(re.sub(r"[\w]", "", span)))
    groups = re.findall(r"[0-9]+", span)
    shape = ",".join(str(min(len(g), 5)) for g in groups[:6])
    out = ["one", "digits=" + _count(len(digits)), "signs=" + "".join(inner)[:6],
           "groups=" + str(min(len(groups), 7)), "shape=" + shape, "first=" + ("d" if span[0].isdigit() else "a" if span[0].isalpha() else span[0])]
    spelled = _DOT.sub(".", _AT.sub("@", span))
    address = _LOCAL.match(spelled) and spelled.count("@") == 1 and _DOMAIN.fullmatch(spelled.partition("@")[2]) \
        and _LOCAL.fullmatch(spelled.partition("@")[0])
    out.append("address" if address else "no-address")
    if address and spelled.rpartition(".")[2].isalpha():
        out.append("name-end")
    if any(c.isalpha() for c in span):
        out.append("letters")
    if 13 <= len(digits) <= 19:
        out.append("luhn" if luhn(digits) else "no-luhn")
    if len(groups) == 4 and all(len(g) < 4 and int(g) < 256 for g in groups):
        out.append("bytes")
    for side, c in (("before=", text[start - 1 : start]), ("after=", text[end : end + 1])):
        out.append(side + ("edge" if not c else "space" if c.isspace() else "word" if c.isalnum() else c))
    return out


class Lattice:
    """Candidate segments of a region: whole tokens, with digits enough or an at sign, between other characters."""

    def __init__(self, text: str, lo: int, hi: int):
        tokens = [(lo + m.start(), lo + m.end()) for m in _TOKEN.finditer(text[lo:hi])]
        self.size, self.tokens = len(tokens), tokens
        self.segments: list[tuple[int, int]] = []
        self.seen: list[list[str]] = []
        # A candidate starts at a word, a plus or an opening bracket after no word, and ends with a word before no word.
        word = [text[a].isalnum() for a, _ in tokens]
        number = [len(re.sub(r"[^0-9]", "", text[a:b])) for a, b in tokens]
        sum_ = np.concatenate([[0], np.cumsum(number)]) if tokens else np.zeros(1, int)
        for i, (a, _) in enumerate(tokens):
            if not (word[i] or text[a] in "+([") or (i and (word[i - 1] or text[a - 1] in "@._%+-" and word[i])):
                continue
            for j in range(i + 1, min(len(tokens), i + MOST_TOKENS) + 1):
                b = tokens[j - 1][1]
                if "\n" in text[a:b]:
                    break
                if not word[j - 1] or (j < len(tokens) and word[j]):
                    continue
                if sum_[j] - sum_[i] < 7 and not _AT.search(text, a, b) and not (sum_[j] - sum_[i] >= 4 and text.count(".", a, b) == 3):
                    continue
                self.segments.append((i, j))
                self.seen.append(features(text, a, b))


class Field:
    """A semi-Markov conditional random field over segments: entities of at most MOST_TOKENS tokens and single others."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.weights = np.zeros((0, len(KINDS)))

    def _rows(self, seen: list[str], grow: bool) -> list[int]:
        if grow:
            return [self.number.setdefault(f, len(self.number)) for f in seen]
        return [self.number[f] for f in seen if f in self.number]

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[r].sum(axis=0) for r in rows]).reshape(-1, len(KINDS))

    def fit(self, lattices: list[Lattice], golds: list[dict[tuple[int, int], int]], rounds: int = 30, rate: float = 0.3, shrink: float = 1e-4) -> None:
        """Gradient steps on the likelihood of the given segmentations, summed over all others by the forward and
        backward sums of the lattice."""
        rows = [[self._rows(s, True) for s in x.seen] for x in lattices]
        self.weights = np.zeros((len(self.number), len(KINDS)))
        squares = np.full_like(self.weights, 1e-8)
        rng = np.random.default_rng(7)
        for _ in range(rounds):
            for k in rng.permutation(len(lattices)):
                x = lattices[k]
                score = self.scores(rows[k])
                share = self._marginals(x, score)
                for m, seg in enumerate(x.segments):
                    wanted = np.zeros(len(KINDS))
                    if seg in golds[k]:
                        wanted[golds[k][seg]] = 1
                    step = wanted - share[m]
                    if np.abs(step).max() > 1e-3:
                        r = rows[k][m]
                        gradient = step - shrink * self.weights[r]
                        squares[r] += gradient**2
                        self.weights[r] += rate * gradient / np.sqrt(squares[r])

    @staticmethod
    def _marginals(x: Lattice, score: np.ndarray) -> np.ndarray:
        """Probability of each segment with each kind."""
        n = x.size
        ending: dict[int, list[int]] = {}
        starting: dict[int, list[int]] = {}
        for m, (i, j) in enumerate(x.segments):
            ending.setdefault(j, []).append(m)
            starting.setdefault(i, []).append(m)
        own = np.logaddexp.reduce(score, axis=1) if len(score) else np.zeros(0)
        ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            ahead[j] = np.logaddexp.reduce([ahead[j - 1], *[ahead[x.segments[m][0]] + own[m] for m in ending.get(j, ())]])
        for i in range(n - 1, -1, -1):
            behind[i] = np.logaddexp.reduce([behind[i + 1], *[behind[x.segments[m][1]] + own[m] for m in starting.get(i, ())]])
        out = np.zeros_like(score)
        for m, (i, j) in enumerate(x.segments):
            out[m] = np.exp(ahead[i] + score[m] + behind[j] - ahead[n])
        return out

    def decode(self, x: Lattice) -> list[tuple[int, int, int]]:
        """The best segmentation's entities (start token, end token, kind), boundaries and kinds chosen together."""
        score = self.scores([self._rows(s, False) for s in x.seen])
        kind = score.argmax(axis=1) if len(score) else []
        ending: dict[int, list[int]] = {}
        for m, (_, j) in enumerate(x.segments):
            ending.setdefault(j, []).append(m)
        best, via = [0.0] * (x.size + 1), [-1] * (x.size + 1)
        for j in range(1, x.size + 1):
            best[j] = best[j - 1]
            for m in ending.get(j, ()):
                value = best[x.segments[m][0]] + score[m][kind[m]]
                if value > best[j]:
                    best[j], via[j] = value, m
        out, j = [], x.size
        while j > 0:
            if via[j] < 0:
                j -= 1
            else:
                i, _ = x.segments[via[j]]
                out.append((i, j, int(kind[via[j]])))
                j = i
        return out[::-1]


def _shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        out = [text[lo:hi] for text in batch.column(0).to_pylist() if text for lo, hi in regions(text)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["region"])


def _variants(region: str, spans: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """The region as it is, and with each span written in other ways that people use."""
    yield region, spans
    for kind, start, end in spans:
        span = region[start:end]
        if kind == "email":
            other = [span.replace("@", " (at) "), span.replace("@", " [at] ").replace(".", " [dot] ")]
        elif kind == "phone" and span.startswith("+1 "):
            other = [span[3:], re.sub(r"[ ()-]+", "-", span[3:]).strip("-"), re.sub(r"[ ()-]+", ".", span[3:]).strip(".")]
        elif kind == "card" and len(span) == 16 and span.isdigit():
            parts = [span[k : k + 4] for k in range(0, 16, 4)]
            other = [".".join(parts), "/".join(parts), "  ".join(parts)]
        elif kind == "ip":
            other = [span.replace(".", "[.]")]
        else:
            continue
        for new in other:
            yield region[:start] + new + region[end:], [(kind, start, start + len(new))]


def trained(docs: DataFrame, documents: int = 4000, limit: int = 1500) -> Broadcast:
    """A field fitted on regions of at most about `documents` documents, taken by hash of their text, `limit` regions at
    most. The base spans there, and other ways to write them, are what it learns to find; all else there is not."""
    total = docs.count()
    spot = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    some = docs.where(spot * total < documents).select("text").mapInArrow(_shown, "region string")
    held = [r.region for r in some.distinct().orderBy(F.xxhash64("region"), "region").limit(limit).collect()]
    lattices, golds = [], []
    for region in held:
        for text, spans in _variants(region, base_spans(region)):
            x = Lattice(text, 0, len(text))
            place = {(x.tokens[i][0], x.tokens[j - 1][1]): (i, j) for i, j in x.segments}
            gold: dict[tuple[int, int], int] = {}
            used: list[tuple[int, int]] = []
            for kind, start, end in spans:
                at = place.get((start, end))
                if at and all(at[1] <= a or b <= at[0] for a, b in used):
                    gold[at] = KINDS.index(kind)
                    used.append(at)
            if x.segments:
                lattices.append(x)
                golds.append(gold)
    field = Field()
    field.fit(lattices, golds, rounds=max(3, min(30, 20_000 // max(1, len(lattices)))))
    return docs.sparkSession.sparkContext.broadcast(field)


def spans_of(text: str | None, field: Field) -> list[dict]:
    """Base spans, and those entities of the field's best segmentations that touch no base span, by kind, then start."""
    if not text:
        return []
    base = base_spans(text)
    out = [{"kind": k, "start": a, "end": b, "base": True} for k, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    reach = list(accumulate((b for _, b in taken), max))
    for lo, hi in regions(text):
        x = Lattice(text, lo, hi)
        if not x.segments:
            continue
        for i, j, kind in field.decode(x):
            start, end = x.tokens[i][0], x.tokens[j - 1][1]
            # Base spans that begin before this one ends must end before it begins.
            before = bisect_left(taken, (end,))
            if not before or reach[before - 1] <= start:
                out.append({"kind": KINDS[kind], "start": start, "end": end, "base": False})
    return sorted(out, key=lambda s: (KINDS.index(s["kind"]), s["start"]))


def _found(batches: Iterator[pa.RecordBatch], field: Broadcast, text: str, into: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text, 16 << 20):
        out = [spans_of(t, field.value) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        yield appended(batch, **{into: pa.array(out, _ARROW)})


def personal_data(docs: DataFrame, field: Broadcast, text: str = "text", into: str = "spans") -> DataFrame:
    """`docs` with the personal data of their whole texts: kind, start, end (code points, end exclusive) and whether a
    fixed pattern gives the span. The field adds spans, it takes none away.

    Null and empty texts: none. Spans of different kinds may overlap if patterns give them; the field's never overlap
    others. Repeated rows get equal results. A column named as `into` is replaced. No rows: no rows.
    """
    plain = docs.drop(into)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(partial(_found, field=field, text=text, into=into), f"{schema}, `{into}` {SPANS}")
