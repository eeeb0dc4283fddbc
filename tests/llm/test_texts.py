"""Language, benchmark passages, packing, personal data, licences, model scores and tool calls beside brute force."""

import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.llm import decontamination, language, licences, lm_scoring, packing, personal, tool_calls

from .conftest import DOCS, ODD, prose, rows_of

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def by_id(df):
    return {None if r.doc_id != r.doc_id else int(r.doc_id): r for r in df.toPandas().itertuples()}


# Language


def code_lengths(texts, spelled):
    """Bits of each symbol by the definition, from counts in dictionaries."""
    counts = Counter()
    for t in texts:
        for i in range(language.ORDER, len(t)):
            for k in range(language.ORDER + 1):
                counts[t[i - k : i], t[i]] += 1
    totals, kinds = Counter(), Counter()
    for (context, _), n in counts.items():
        totals[context] += n
        kinds[context] += 1
    bits = 0.0
    for i in range(language.ORDER, len(spelled)):
        for k in range(language.ORDER, -1, -1):
            context = spelled[i - k : i]
            if not totals[context]:
                continue
            n = counts[context, spelled[i]]
            whole = totals[context] + kinds[context]
            if n:
                bits += math.log2(whole / n)
                break
            bits += math.log2(whole / kinds[context])
        else:
            bits += 8
    return bits


TONGUES = {"en": "the thing is that they were there with the others and nothing else", "fr": "le chat est sur la table avec des fleurs et une élève",
           "de": "der Hund und die Katze sind nicht auf dem Tisch über das"}


def test_code_lengths_beside_the_definition(spark):
    rows = [(k, f"{t} {k} {t[k % 9:]}", lang, None, 0) for k, (lang, t) in enumerate([*TONGUES.items()] * 5)]
    model = language.trained(spark.createDataFrame(rows, DOCS)).value
    asked = ["the cat and the dog", "une table", "Über 漢字 the", "zzz qqq", "x", "é" * 300]
    raw = [language.spelled(t) for t in asked]
    for chunk in (7, 50, 1 << 18):
        found = model.costs(raw, chunk)
        for i, r in enumerate(raw):
            for j, lang in enumerate(model.langs):
                texts = [language.spelled(t) for _, t, x, *_ in rows if x == lang]
                assert found[i, j] == pytest.approx(code_lengths(texts, r), rel=1e-4)


def test_predictions(spark, odd):
    rows = [(k, f"{t} {t[k % 9:]}", lang, None, 0) for k, (lang, t) in enumerate([*TONGUES.items()] * 5)]
    model = language.trained(spark.createDataFrame(rows, DOCS), rows=2)
    found = by_id(language.predicted(odd, model, into=("kind", "key")))
    assert found[0].kind == found[1].kind == found[2].kind == found[3].kind == language.UNKNOWN and found[0].key == 0
    assert found[4].kind in TONGUES and 0 < found[4].key <= 1
    asked = spark.createDataFrame([(1, "with nothing there"), (2, "des élève sur la"), (3, "nicht auf dem Tisch")], "doc_id long, text string")
    assert [r.lang_pred for r in language.predicted(asked, model).orderBy("doc_id").collect()] == ["en", "fr", "de"]


def test_numbers_that_count_as_word_characters_are_no_letters(spark):
    for text in ("² ½", "①", "ⅷ", "12 _ ٣", "\u0301"):
        assert language.spelled(text) == b""
    assert language.spelled("a²b Éc½") == language.spelled("a b éc") and language.spelled("ab²").strip() == b"ab"
    model = language.trained(spark.createDataFrame(rows_of([TONGUES["en"], TONGUES["fr"]]), DOCS).withColumn("lang", F.coalesce("lang", F.lit("fr"))))
    found = by_id(language.predicted(spark.createDataFrame(rows_of(["² ½", "①", "the thing"]), DOCS), model, into=("kind", "key")))
    assert [found[k].kind == language.UNKNOWN for k in range(3)] == [True, True, False]


def test_no_languages(spark, odd, empty):
    model = language.trained(empty)
    assert {r.lang_pred for r in language.predicted(odd, model).collect()} == {language.UNKNOWN}
    assert language.predicted(empty, model).count() == 0


def test_the_sample_is_bounded_and_even(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"),
                                    F.when(F.col("id") % 10 == 0, "aa").otherwise("bb").alias("lang"))
    assert {r.lang: r["count"] for r in language.sampled(docs, 100).groupBy("lang").count().collect()} == {"aa": 100, "bb": 100}


def test_a_rare_language_is_learned_beside_a_large_one(spark):
    docs = spark.range(5001).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 7, "zwq zwq").otherwise("a b").alias("text"),
                                    F.when(F.col("id") == 7, "aa").otherwise("bb").alias("lang"))
    found = language.predicted(docs.where("doc_id in (7, 8)"), language.trained(docs))
    assert {r.doc_id: r.lang_pred for r in found.collect()} == {7: "aa", 8: "bb"}


def test_held_out(spark):
    got = spark.range(50).select("id", language.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


# Benchmark passages


def hits_of(texts, items, size=10):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    low = lambda t: (t or "").translate({k: k + 32 for k in range(65, 91)})
    windows = {}
    for item, t in items:
        w = word.findall(low(t))
        for k in range(max(1, len(w) - size + 1)) if w and item is not None else ():
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(item))
    out = []
    for t in texts:
        w = word.findall(low(t))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if names := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= names
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block", [10, 50_000])
def test_contamination_beside_brute_force(spark, block):
    rng = random.Random(1)
    items = [(k, prose(100 + k, n)) for k, n in enumerate([3, 9, 10, 11, 40, 1, 25])] + [(7, None), (8, "..."), (None, prose(104, 40)), (9, prose(104, 40))]
    texts = []
    for _ in range(30):
        parts = [prose(rng.randrange(1000), 20)]
        for _, t in rng.sample([i for i in items if i[1]], 2):
            w = t.split(" ")
            cut = rng.randrange(len(w))
            parts.append(rng.choice([t, " ".join(w[cut:]), t.upper().replace(" ", "-\n")]))
        texts.append(" ".join(parts))
    texts += [None, "", items[5][1], "!!", prose(104, 40) * 3]
    docs, bench = spark.createDataFrame(rows_of(texts), DOCS), spark.createDataFrame(items, "item_id long, text string")
    found = by_id(decontamination.contamination(docs, bench, block=block))
    for k, want in enumerate(hits_of(texts, items)):
        c = found[k].contamination
        assert (c.n_words, c.n_hit, list(c.items)) == want
        assert sum(s.end - s.start for s in c.spans) == c.n_hit


def test_contamination_of_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, prose(2, 60)), (2, "")], "item_id long, text string")
    found = decontamination.contamination(odd, bench, into="row").toPandas()
    assert len(found) == len(ODD) + 3 and sum(r.n_hit > 0 for r in found.row) == 5
    assert {r.contamination.n_hit for r in decontamination.contamination(odd, bench.where("item_id = 2")).collect()} == {0}
    assert decontamination.contamination(empty, bench).count() == 0


# Packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB é'sßÀ_1²\t\n.<|>!İ漢́ \x1c")) , max_size=25), max_size=6), st.integers(0, 3))
def test_ids_beside_the_tokenizer(texts, most):
    own = packing.Ids(TOKENIZER, most)
    for _ in range(2):
        assert own.many(texts) == [own.whole(t) for t in texts]


def test_ids_of_special_tokens_and_prose():
    own = packing.Ids(TOKENIZER)
    texts = ["<|endoftext|> a", "it's we'll I'd o'clock 'S", prose(1, 500), "Grüße, ÉCOLE naïve! 3.14 x_y", ""]
    assert own.many(texts) == [own.whole(t) for t in texts]


def check_packing(rows, texts, size):
    own = packing.Ids(TOKENIZER)
    want = {k: np.frombuffer(own.whole(t or "") + np.array([1], "<u4").tobytes(), "<u4") for k, t in texts.items()}
    pieces, windows = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and (want[r.doc_id][r.start : r.start + r.length] == ids).all()
        assert r.doc_tokens == len(want[r.doc_id])
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for k, ids in want.items():
        assert sorted(pieces[k])[0][0] == 0 and sum(n for _, n in pieces[k]) == len(ids)
    for held in windows.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= size
    return windows


@pytest.mark.parametrize("size,most", [(64, 4), (2048, 64)])
def test_packing_is_whole(spark, size, most):
    texts = {k: prose(k, 5 + 13 * k) for k in range(80)} | {200: None, 201: "", 202: prose(5, 6000)}
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string").repartition(5)
    windows = check_packing(packing.packed(docs, TOKENIZER, size, most, leftovers=8).collect(), texts, size)
    used = sum(n for held in windows.values() for _, n in held)
    assert used / (size * len(windows)) > 0.8


def test_packing_of_odd_rows(odd, empty):
    rows = packing.packed(odd, TOKENIZER).toPandas()
    totals = rows.groupby(rows.doc_id.fillna(-1)).length.sum()
    assert len(totals) == len(ODD) + 1 and totals[7] == 2 * totals[9]
    assert packing.packed(empty, TOKENIZER).count() == 0


def test_open_windows_are_bounded_and_best_fit():
    out = []
    w = packing.Windows(10, 2, out.append)
    for n in (6, 7, 3, 9, 4, 10):
        w.place(n, n)
    assert out == [[7, 3], [6, 4], [10]] and w.open == [(9, [9])]


# Personal data


def plain_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and personal.luhn(d):
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "B.c", "@", "@x.yz", ".", "-", "+", "+1 (555) 555-1234", "10.2.3.4", "256", "1.1.1.1.1", "4111 1111 1111 1111",
                                 " ", "\n", "0", "7", "(", "é", "٣", "%", "_"]), max_size=14).map("".join))
def test_base_spans_beside_the_patterns(text):
    assert personal.base_spans(text) == plain_spans(text)


@pytest.fixture(scope="module")
def field(spark):
    rng = random.Random(6)
    rows = []
    for k in range(150):
        kind = ("mail me at %s.%d@mail%d.example.com please" % (prose(k, 1), k, k % 7), "call +1 (%03d) 555-%04d now" % (k + 200, k * 37 % 10000),
                "host %d.%d.%d.%d is up" % tuple(rng.randrange(256) for _ in range(4)), "order 20240101%06d, version 2.0.1" % k,
                "token %040x here" % rng.getrandbits(160))[k % 5]
        rows.append((k, prose(k, 12) + " " + kind + " " + prose(k + 500, 12)))
    return personal.trained(spark.createDataFrame(rows, "doc_id long, text string"), documents=10**6)


def test_the_field_keeps_base_spans_and_adds_spelled_out_ones(field):
    text = "write to jane.doe (at) mail3.example.com or jo.1@mail2.example.com, call (212) 555-0199 today, version 2.0.1, id 99887766554433"
    found = personal.spans_of(text, field.value)
    assert [(s["kind"], s["start"], s["end"]) for s in found if s["base"]] == plain_spans(text)
    added = {(s["kind"], text[s["start"] : s["end"]]) for s in found if not s["base"]}
    assert ("email", "jane.doe (at) mail3.example.com") in added and ("phone", "(212) 555-0199") in added
    assert all("2.0.1" not in t and "9988" not in t for _, t in added)


def test_every_variant_is_a_candidate_without_other_triggers():
    spans = {"email": "jo@mailhostofdepartment.examplecompanyname.com", "phone": "+1 (415) 555-0100", "card": "4111111111111111", "ip": "192.168.10.20"}
    for kind, span in spans.items():
        for new, ((_, start, end),) in personal._variants(f"write {span} now", [(kind, 6, 6 + len(span))]):
            text = "so it was said " * 9 + new + " as it was said" * 9
            start, end = start + 135, end + 135
            found = []
            for lo, hi in personal.regions(text):
                x = personal.Lattice(text, lo, hi)
                found += [(x.tokens[i][0], x.tokens[j - 1][1]) for i, j in x.segments]
            assert (start, end) in found, text[start:end]


def test_long_sides_of_a_sign_are_shown_whole():
    local = "a" * 70
    text = f"write to {local}@{'b' * 60}.example.com, please"
    assert any(lo <= 9 and hi >= text.index(",") for lo, hi in personal.regions(text))


def test_segmentations_sum_to_one_and_the_best_is_the_best(field):
    x = personal.Lattice("call 212-555-0199 or 10.0.0.1 at 4111 1111 1111 1111", 0, 52)
    f = field.value
    score = f.scores([f._rows(s, False) for s in x.seen])

    def every(at):
        if at == x.size:
            yield ()
            return
        yield from every(at + 1)
        for m, (i, j) in enumerate(x.segments):
            if i == at:
                for k in range(len(personal.KINDS)):
                    for rest in every(j):
                        yield ((m, k), *rest)

    paths = list(every(0))
    totals = np.array([sum(score[m][k] for m, k in p) for p in paths])
    share = np.exp(totals - np.logaddexp.reduce(totals))
    own = f._marginals(x, score)
    for m in range(len(x.segments)):
        for k in range(len(personal.KINDS)):
            assert own[m, k] == pytest.approx(sum(s for s, p in zip(share, paths) if (m, k) in p), abs=1e-9)
    best = paths[int(totals.argmax())]
    assert sorted((*x.segments[m], k) for m, k in best) == sorted(f.decode(x)) or np.sort(totals)[-1] - np.sort(totals)[-2] < 1e-9


def test_personal_data_of_odd_rows(odd, empty, field):
    found = personal.personal_data(odd, field, into="row").toPandas()
    assert len(found) == len(ODD) + 3 and all(len(r) == 0 for r in found.row)
    assert personal.personal_data(empty, field).count() == 0
    many = " ".join(["9" * 50_000, "a" * 50_000, "1.2.3.4"])
    assert [s["kind"] for s in personal.spans_of(many, field.value)] == ["ip"]


# Licences


def dice_of(texts, at_least=0.8):
    import regex

    def bigrams(t):
        w = regex.sub(r"[^\p{L}\p{N}]+", " ", t.lower()).strip(" ").split(" ")
        return set(zip(w, w[1:]))

    made = {n: bigrams(t) for n, t in licences.TEMPLATES.items()}
    out = []
    for t in texts:
        units = (t.split("\n") + ([t] if "\n" in t else [])) if t else []
        names, top = [], []
        for u in units:
            b = bigrams(u)
            score = max(((2 * len(b & m) / (len(b) + len(m)), n) for n, m in made.items()), key=lambda x: x[0])
            if score[0] >= at_least:
                names.append(min(n for n, m in made.items() if 2 * len(b & m) / (len(b) + len(m)) == score[0]))
                top.append(score[0])
        out.append((len(names), ",".join(sorted(set(names))), max(top, default=0.0)))
    return out


def test_licences_beside_all_templates(spark):
    rng = random.Random(8)
    texts = [None, "", "\n", "of the MIT", prose(3, 30)]
    for t in licences.TEMPLATES.values():
        w = t.split(" ")
        texts += [t, t.upper(), prose(1, 9) + "\n" + t + "\n" + prose(2, 9), "\n".join(" ".join(w[k : k + 9]) for k in range(0, len(w), 9))]
        for _ in range(3):
            v = list(w)
            for _ in range(max(1, len(v) // rng.choice((4, 8, 16)))):
                v[rng.randrange(len(v))] = "other"
            texts.append(" ".join(v))
    found = by_id(licences.scanned(spark.createDataFrame(rows_of(texts), DOCS)))
    for k, want in enumerate(dice_of(texts)):
        assert (found[k].n_notices, found[k].licences, found[k].best_dice) == (*want[:2], pytest.approx(want[2]))


def test_licences_of_odd_rows(odd, empty):
    assert [r.n_notices for r in licences.scanned(odd).collect()] == [0] * (len(ODD) + 3)
    assert licences.scanned(empty).count() == 0


# Model scores


def defined_scores(texts, target):
    """Mean losses of each text by the definition, from counts in dictionaries."""
    cut = [[w.decode() for w in decontamination.words(t)] for t in texts]
    often = {w for w, n in Counter(w for c in cut for w in c).items() if n >= lm_scoring.LEAST}
    cut = [[w if w in often else None for w in c] for c in cut]
    sides = [[c for c, t in zip(cut, target, strict=True) if t], cut]
    single, double = ([Counter(g for c in side for g in grams(c)) for side in sides] for grams in (lambda w: w, lambda w: list(zip(w, w[1:]))))
    out = []
    for w in cut:
        bits = []
        for one, two in zip(single, double):
            alone = lambda x: (one[x] + 1) / (sum(one.values()) + len(often) + 1)  # noqa: E731, B023
            loss = [-math.log2(alone(w[0]))] if w else []
            for a, b in zip(w, w[1:]):
                share = sum(n for (x, _), n in two.items() if x == a)
                rest = 1 - lm_scoring.LAMBDA * share / max(one[a], 1)
                loss.append(-math.log2(lm_scoring.LAMBDA * two[a, b] / max(one[a], 1) + rest * alone(b)))
            bits.append(sum(loss) / len(loss) if w else None)
        out.append((len(w), *bits))
    return out


@pytest.mark.parametrize(("block", "keys"), [(1 << 18, 1 << 20), (64, 50), (1, 7)])
def test_scores_beside_the_definition(spark, monkeypatch, block, keys):
    """Few large blocks and parts, or many small ones, down to a block for each text."""
    monkeypatch.setattr(lm_scoring, "BLOCK", block)
    monkeypatch.setattr(lm_scoring, "KEYS", keys)
    texts = [prose(k, 40) + f" only{k}" + " twice two" * (k < 2) for k in range(30)] + [None, "", "unseen words", prose(3, 40) + " only3", "only1"]
    chosen = [k % 2 == 0 and k < 20 for k in range(len(texts))]
    docs = spark.createDataFrame(rows_of(texts), DOCS).repartition(3)
    target = spark.createDataFrame([*[(k,) for k, t in enumerate(chosen) if t], (None,), (4,), (999,)], "doc_id long")
    found = by_id(lm_scoring.scored(docs, target))
    assert len(found) == len(texts)
    for k, (n, a, b) in enumerate(defined_scores(texts, chosen)):
        assert found[k].n_tokens == n
        if n:
            assert (found[k].target_bits, found[k].background_bits) == (pytest.approx(a, rel=1e-9), pytest.approx(b, rel=1e-9))
            assert found[k].difference == pytest.approx(a - b, abs=1e-9)
        else:
            assert math.isnan(found[k].difference)


def test_both_models_sum_to_one(spark):
    """What may follow a known word, the unknown word among it, has shares that add to one."""
    words = ["aa", "bb", "cc"]
    texts = [" ".join(words * 3), "aa cc aa", "zz aa yy aa", "aa", *[f"aa {w}" for w in [*words, "new"]]]
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    found = by_id(lm_scoring.scored(docs, docs.where("doc_id < 2").select("doc_id")))
    for side in ("target_bits", "background_bits"):
        start = getattr(found[3], side)
        assert sum(2 ** (start - 2 * getattr(found[4 + k], side)) for k in range(4)) == pytest.approx(1, rel=1e-9)


def test_words_of_a_small_target_count_beside_a_large_corpus(spark):
    """Three occurrences in 400,000 tokens are enough."""
    texts = ["rareone raretwo"] * 3 + ["often " * 4000] * 100
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    found = by_id(lm_scoring.scored(docs, docs.where("doc_id < 3").select("doc_id")))
    # Known words: three counts of six, one added for each of three words and the unknown one.
    first, then = -math.log2(4 / 10), -math.log2(lm_scoring.LAMBDA + (1 - lm_scoring.LAMBDA) * 4 / 10)
    assert found[0].target_bits == pytest.approx((first + then) / 2, abs=1e-6)


def test_scores_of_odd_rows(odd, empty):
    found = lm_scoring.scored(odd, odd.where("doc_id = 7").select("doc_id"))
    assert found.count() == len(ODD) + 3
    assert lm_scoring.scored(odd, empty.select("doc_id")).where("n_tokens > 0 and difference is null").count() == 0
    assert lm_scoring.scored(empty, empty.select("doc_id")).count() == 0


# Tool calls


SCHEMA = [("find", "query", "string", True), ("find", "limit", "integer", False), ("sum", "values", "array", True), ("sum", "scale", "number", False),
          ("set", "flag", "boolean", True), ("set", "extra", "object", False)]
CALLS = [
    ("c", "a", None, 0, "find", '{"limit": 3, "query": "x \\"y\\" é"}'), ("c", "b", "a", 2, "sum", '{"values":[1, 2.50],"scale":2}'),
    ("c", "d", "b", 1, "set", '{"flag":"yes","other":1}'), ("c", "e", "zzz", 5, "find", "not json"), ("c", "f", "g", 6, "find", '{"query":"q"}'),
    ("c", "g", "f", 7, "nothing", "{}"), ("c", "h", "g", 8, "set", '{"flag":true,"extra":{"b":1,"a":[]}}'), ("c", "a", None, 4, "set", "{}"),
    ("c", None, None, 9, "set", "{}"), ("d", "a", None, 0, None, None), ("c", "i", "i", 9, "find", "[1]"),
]
RESULTS = [("c", "a", 1, "line\none"), ("c", "a", 3, "later"), ("c", "b", 0, None), ("c", "lost", 9, "who"), ("e", "a", 1, "other")]


def tool_frames(spark):
    return (spark.createDataFrame(CALLS, "conv_id string, call_id string, parent_id string, turn int, name string, arguments string"),
            spark.createDataFrame(RESULTS, "conv_id string, call_id string, turn int, content string"),
            spark.createDataFrame(SCHEMA, "name string, param string, type string, required boolean"))


def test_tool_calls(spark):
    found = {(r.conv_id, r.call_id): r for r in tool_calls.linked_calls(*tool_frames(spark)).collect()}
    assert len(found) == 11
    say = {k: (r.level, r.status, r.errors) for k, r in found.items()}
    assert say == {
        ("c", "a"): (0, "linked", ""), ("c", "b"): (1, "linked", "early"), ("c", "d"): (2, "unanswered", "unknown:other,type:flag"),
        ("c", "e"): (0, "unanswered", "arguments,parent"), ("c", "f"): (None, "cycle", ""), ("c", "g"): (None, "cycle", "tool"),
        ("c", "h"): (None, "cycle", ""), ("c", "i"): (None, "cycle", "arguments"), ("d", "a"): (0, "unanswered", "arguments,tool"),
        ("c", "lost"): (None, "orphan", ""), ("e", "a"): (None, "orphan", "")}
    assert json.loads(found["c", "a"].message) == {"arguments": {"limit": 3, "query": 'x "y" é'}, "id": "a", "name": "find", "result": "line\none"}
    assert found["c", "h"].message == '{"arguments":{"extra":{"a":[],"b":1},"flag":true},"id":"h","name":"set","result":null}'


def test_long_chains_take_few_rounds(spark):
    rows = [("c", str(k), str(k - 1) if k else None, k, "find", "{}") for k in range(300)]
    calls = spark.createDataFrame(rows, "conv_id string, call_id string, parent_id string, turn int, name string, arguments string")
    assert {(r.call_id, r.level) for r in tool_calls._levels(calls.select("conv_id", "call_id", "parent_id")).collect()} == {(str(k), k) for k in range(300)}


def test_no_calls(spark):
    calls, results, schemas = tool_frames(spark)
    assert tool_calls.linked_calls(calls.limit(0), results.limit(0), schemas.limit(0)).count() == 0
    assert tool_calls.linked_calls(calls.limit(0), results, schemas).count() == 4



def test_repeated_and_null_rows_of_schemas(spark):
    calls = spark.createDataFrame([("c", f"k{i}", None, i, n, a) for i, (n, a) in enumerate([
        ("f", '{"x": 1}'), ("f", '{"x": 123456789012345678901234567890}'), ("f", '{"x": 1.5}'), ("g", "{}"), ("g", '{"y": 1}'), (None, "{}"), ("h", "{}")])],
        "conv_id string, call_id string, parent_id string, turn int, name string, arguments string")
    results = spark.createDataFrame([], "conv_id string, call_id string, turn int, content string")
    schemas = spark.createDataFrame([("f", "x", "integer", True), ("f", "x", "integer", True), ("f", "x", "string", None), ("f", None, "string", True),
                                     ("g", None, None, None), (None, "x", "string", True), ("h", "z", "string", None)],
                                    "name string, param string, type string, required boolean")
    found = {r.call_id: r.errors for r in tool_calls.linked_calls(calls, results, schemas).collect()}
    assert found == {"k0": "", "k1": "", "k2": "type:x", "k3": "", "k4": "unknown:y", "k5": "tool", "k6": ""}
