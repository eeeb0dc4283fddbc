"""Fill-in-middle beside brute force over code points."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from forecourt.llm import fill_middle

from .conftest import ODD


def by_hand(doc_id, text, percent=90, spm=20):
    text = text or ""
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = fill_middle.restored(fill_middle.transformed(docs, **options)).collect()
    assert len(found) == len(rows)
    forms = set()
    for r in found:
        assert tuple(r.fim) == by_hand(r.doc_id, r.text, options.get("percent", 90), options.get("spm_percent", 20)), r.doc_id
        assert r.restored == (r.text or "")
        forms.add(r.fim.form)
    return forms


def test_every_form_and_character(spark):
    rng = random.Random(5)
    signs = "ab <>PSM/ \n\té漢😀"
    rows = [(i, "".join(rng.choice(signs) for _ in range(rng.randrange(0, 60)))) for i in range(800)]
    rows += [(1000 + i, t) for i, t in enumerate(["<P", "S>", "<", ">", "<M><", "a<S>b", "<<PP>>", "😀", "é" * 7])]
    assert check(spark, rows) == {"plain", "psm", "spm"}
    assert check(spark, rows, percent=100, spm_percent=100) == {"plain", "spm"}
    assert check(spark, rows[:50], percent=0) == {"plain"}


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    check(spark, rows)
    kept = fill_middle.restored(fill_middle.transformed(odd))
    assert kept.columns == [*odd.columns, "fim", "restored"] and kept.count() == odd.count()
    assert fill_middle.restored(fill_middle.transformed(empty)).collect() == []
    again = fill_middle.transformed(fill_middle.transformed(odd.withColumnRenamed("key", "fim")))
    assert again.columns.count("fim") == 1 and again.count() == odd.count()


def test_texts_longer_than_a_block(spark, monkeypatch):
    """Blocks of a few bytes cut through characters, marks and rows; the result is the same."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("aé漢😀<P>"), size=k)) for k in (0, 1, 5, 40, 200)] + [t or "" for t in ODD]
    plan = [(i, t, *by_hand(i, t)) for i, t in enumerate(texts)]
    fields = [pa.array([p[2] for p in plan], pa.int64()), pa.array([p[3] for p in plan]), pa.array([p[4] for p in plan], pa.int64()),
              pa.array([p[5] for p in plan], pa.int64()), pa.array([p[1] for p in plan])]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(plan))), pa.StructArray.from_arrays(fields, fields=list(fill_middle._ARROW))],
                                       names=["doc_id", "fim"])
    for block, together in ((7, 50), (64, 1), (1 << 20, 1 << 22)):
        monkeypatch.setattr(fill_middle, "BLOCK", block)
        monkeypatch.setattr(fill_middle, "TOGETHER", together)
        made = list(fill_middle._scattered(iter([batch.slice(2), batch.slice(0, 2)]), "fim"))
        outputs = {i: s["output"] for b in made for i, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
        assert outputs == {p[0]: p[6] for p in plan}, block
        back = {i: t for b in fill_middle._restored(iter(made), "fim", "back") for i, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)}
        assert back == {p[0]: p[1] for p in plan}, block


def test_the_bytes_of_a_slice():
    texts = pa.array(["ab", "", "é漢", "z"])[1:]
    held, at = fill_middle._bytes(texts)
    assert held.tobytes() == "é漢z".encode() and at.tolist() == [0, 0, 5, 6]


@pytest.mark.parametrize("ranks", [[0, 3, 5], [5, 0, 2], [2, 2]])
def test_places_of_code_points(ranks, monkeypatch):
    monkeypatch.setattr(fill_middle, "BLOCK", 3)
    text = "aé漢😀z"
    assert fill_middle._places(np.frombuffer(text.encode(), np.uint8), np.array(ranks)).tolist() == [len(text[:k].encode()) for k in ranks]
