"""Near copies, fuzzy lines, connected groups and spot signatures beside brute force."""

import random
import re

import numpy as np
import pytest

from forecourt.llm import lines, linking, near_dedup, spotsigs

from .conftest import DOCS, ODD, prose, rows_of


def groups_of(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def shingle_set(text, size=2):
    low = (text or "").translate({k: k + 32 for k in range(65, 91)})
    w = re.findall("[^\x20\x09-\x0d]+", low)
    return set(zip(*[w[k:] for k in range(size)], strict=False)) if len(w) >= size else {tuple(w)} if w else set()


def linked_sets(sets, percent=80):
    return [(a, b) for a in range(len(sets)) for b in range(a)
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]


def edited(text, rng, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_components_are_connected_groups(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 400)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(250)]
    found = linking.components(spark.createDataFrame([*links, (7, 7), (None, 3), links[0]], "a long, b long")).collect()
    wanted = groups_of(1000, links)
    assert {r.id: r.component for r in found} == {k: g for k, g in enumerate(wanted) if g != k}


def test_components_of_no_links(spark):
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_buckets_lose_no_link_and_try_few_pairs(spark):
    """A chain of links inside one bucket, a large group, and members that link to none of the hubs."""
    n = 300
    links = {(a, b) for a in range(n) for b in range(a) if a - b <= 2 and a % 100 and b % 100}
    buckets = [(key, i) for key in range(3) for i in range(n)]
    tried = []

    def confirm(pairs):
        some = pairs.collect()
        tried.append(len(some))
        keep = [(r.a, r.b) for r in some if (r.b, r.a) in links]
        return spark.createDataFrame(keep, "a long, b long")

    found = {r.id: r.component for r in linking.linked(spark.createDataFrame(buckets, "key long, id long"), confirm).collect()}
    assert [found.get(k, k) for k in range(n)] == groups_of(n, links)


@pytest.mark.parametrize("block", [300, 1 << 16])
def test_near_copies_beside_brute_force(spark, monkeypatch, block):
    """A crowd of copies with more or fewer edits: some link to all others, some to few, some to none."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(5)
    source = prose(11, 120)
    texts = [source] + [edited(source, rng, rng.randrange(1, 14)) for _ in range(60)] + [prose(k, 80) for k in range(20, 50)]
    texts += [edited(t, rng, rng.randrange(1, 12)) for t in texts[61:80]] + [source.upper(), source.replace(" ", "\n\t"), "a b", "A  b", "b a"]
    sets = [shingle_set(t) for t in texts]
    found = near_dedup.near_copies(spark.createDataFrame(rows_of(texts), DOCS)).toPandas().set_index("doc_id")
    assert [found.component_id[k] for k in range(len(texts))] == groups_of(len(texts), linked_sets(sets))
    assert [found.n_shingles[k] for k in range(len(texts))] == [len(s) for s in sets]
    assert (found.kept == (found.index == found.component_id)).all()


def test_near_copies_of_odd_rows(odd):
    found = near_dedup.near_copies(odd).toPandas()
    assert len(found) == len(ODD) + 3
    wanted = groups_of(len(ODD), linked_sets([shingle_set(t) for t in ODD]))
    for r in found.itertuples():
        if np.isnan(r.doc_id):
            assert r.kept and np.isnan(r.component_id)
        else:
            assert r.component_id == wanted[int(r.doc_id)]
            assert r.kept == (r.component_id == r.doc_id)


def test_one_document_with_two_texts_connects_their_groups(spark):
    a, b = prose(1, 50), prose(2, 50)
    found = near_dedup.near_copies(spark.createDataFrame([(5, a), (3, b), (5, b), (9, a)], "doc_id long, text string")).toPandas()
    assert set(found.component_id) == {3}


def test_no_documents(empty):
    assert near_dedup.near_copies(empty).count() == 0
    assert lines.without_repeats(empty).count() == 0
    assert spotsigs.with_next(empty).count() == 0


def test_registers_of_a_union_are_the_larger_ones():
    s = near_dedup.Sketch()
    a, b = (near_dedup.shingles(near_dedup.words(prose(k, 300)), 2) for k in (1, 2))
    both = np.maximum(near_dedup.registers(a, s), near_dedup.registers(b, s))
    assert (near_dedup.registers(np.union1d(a, b), s) == both).all()


@pytest.mark.parametrize("common", [0, 30, 70, 85, 95])
def test_the_likelihood_keeps_pairs_at_the_threshold_and_drops_distant_ones(common):
    s = near_dedup.Sketch()
    rng = np.random.default_rng(common)
    kept = 0
    for _ in range(20):
        both, left, right = (rng.integers(0, 2**63, n, np.uint64) for n in (common * 4, (100 - common) * 2, (100 - common) * 2))
        sets = [np.unique(np.concatenate([both, x])) for x in (left, right)]
        r = [near_dedup.registers(x, s)[None, :] for x in sets]
        kept += near_dedup.likely(*r, *[np.array([float(len(x))]) for x in sets], s)[0]
    assert kept == (20 if common >= 85 else 0) or common == 70


def fuzzy(texts, least=5, percent=80):
    """Lines dropped, by comparing all pairs of kinds with the operator's own hashes."""
    import regex

    normal = lambda line: regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" ")
    places = [(d, at, normal(line)) for d, t in enumerate(texts) if t is not None for at, line in enumerate(t.split("\n"))]
    return [p for p in places if len(p[2].split(" ")) >= least and p[2]]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def alike(x, y):
    """Edit similarity of 0.8 in words."""
    x, y = x.split(" "), y.split(" ")
    return abs(len(x) - len(y)) <= max(len(x), len(y)) // 5 and distance(x, y) <= max(len(x), len(y)) * 20 // 100


def test_fuzzy_lines_beside_all_pairs(spark):
    rng = random.Random(9)
    base = [prose(k, 40) for k in range(12)]
    texts = []
    for d in range(30):
        some = [rng.choice(base) for _ in range(4)]
        some = [s if rng.random() < 0.5 else edited(s, rng, 1) if rng.random() < 0.7 else s.upper() + " !!" for s in some]
        texts.append("\n".join([*some, "short line", prose(1000 + d, 12)]))
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    places = fuzzy(texts)
    hashes = {(r.doc_id, r.at): (r.kind, r.hash) for r in lines.hashed_lines(lines.keyed(docs), 5).collect()}
    assert set(hashes) == {(d, at) for d, at, _ in places}
    kinds = {p: hashes[p[0], p[1]] for p in places}
    index = list(places)
    links = []
    for a in range(len(index)):
        for b in range(a):
            x, y = index[a][2], index[b][2]
            far = bin((kinds[index[a]][1] ^ kinds[index[b]][1]) & (2**64 - 1)).count("1")
            if x == y or (far <= lines.FAR and alike(x, y)):
                links.append((a, b))
    gone = {index[k][:2] for k, g in enumerate(groups_of(len(index), links)) if g != k}
    found = lines.without_repeats(docs).toPandas().set_index("doc_id")
    assert any(x != y for (a, b) in links for x, y in [(index[a][2], index[b][2])])
    for d, text in enumerate(texts):
        kept = [line for at, line in enumerate(text.split("\n")) if (d, at) not in gone]
        assert found.text[d] == "\n".join(kept)
        assert found.lines[d].n_dropped == text.count("\n") + 1 - len(kept)


def test_lines_of_odd_rows(odd):
    found = lines.without_repeats(odd, into="row").toPandas()
    assert len(found) == len(ODD) + 3 and list(found.columns)[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    by = {int(r.doc_id): r for r in found.itertuples() if not np.isnan(r.doc_id)}
    assert by[0].text is None and by[1].text == "" and by[3].text == ODD[3]
    assert by[7].text == ODD[7] and by[9].text == ""  # a copy without another line
    assert by[13].text == prose(5, 40)  # its first line is in document 12


def test_simhash_of_long_lines(spark):
    """Narrow and wide counters give what the definition gives, and a line that is too long for narrow ones is there."""
    many = [f"w{k}" for k in range(70_000)]
    docs = spark.createDataFrame([(1, " ".join(many)), (2, prose(3, 300)), (3, "one one one one two")], "doc_id long, text string")
    rows = lines.keyed(docs)
    found = {r.doc_id: r.hash for r in lines.hashed_lines(rows, 5).collect()}
    assert set(found) == {1, 2, 3}
    wide = {r.doc_id: r.hash for r in lines.simhashed(lines.plain_lines(rows, 5), 32).collect()}
    assert wide == found
    from pyspark.sql import functions as F
    words = docs.where("doc_id = 2").select(F.explode(F.array_distinct(F.split(F.lower("text"), " "))).alias("w")).select(F.xxhash64("w").alias("h")).collect()
    value = sum(1 << b for b in range(64) if 2 * sum(r.h >> b & 1 for r in words) > len(words))
    assert found[2] & (2**64 - 1) == value


@pytest.mark.parametrize("kinds", [10, 2**20, 2**30, 2**36])
def test_block_keys_share_one_within_the_distance(spark, kinds):
    rng = random.Random(kinds)
    pairs = []
    for _ in range(60):
        h = rng.getrandbits(64)
        other = h
        for bit in rng.sample(range(64), lines.FAR):
            other ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (h, other)))
    from pyspark.sql import functions as F
    df = spark.createDataFrame(pairs, "a long, b long")
    keys = lambda c: F.array(*lines.block_keys(F.col(c), kinds))
    assert df.where(F.arrays_overlap(keys("a"), keys("b"))).count() == 60


def signatures(text, chain=2):
    import regex

    w = [x for x in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if x]
    content, out, seen = [x for x in w if x not in spotsigs.COMMON], set(), 0
    for i, x in enumerate(w):
        if x in spotsigs.COMMON:
            if i - seen + chain - 1 < len(content):
                out.add((x, *content[i - seen : i - seen + chain]))
            seen += 1
    return out or ({tuple(w)} if w else set())


def test_spot_signatures_and_neighbours(spark):
    texts = [prose(k, 30 + k) for k in range(40)] + ["", None, "no sign here", "the the of"]
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    found = {r.doc_id: r for r in spotsigs.with_next(docs).collect()}
    for k, t in enumerate(texts):
        assert found[k].text == (t or "") and found[k].next_text == (texts[k - 1] or "")
        assert len(found[k].signatures) == len(signatures(t)) and found[k].signatures == sorted(found[k].signatures)
        assert found[k].next_signatures == found[k - 1 if k else len(texts) - 1].signatures


def test_neighbours_across_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "BUCKET", 4)
    rng = random.Random(2)
    ids = rng.sample(range(-(10**12), 10**12), 200) + list(range(50))
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    order = sorted(ids, reverse=True)
    found = {r.doc_id: r.next_text for r in spotsigs.with_next(docs).collect()}
    assert found == {i: f"text {order[(k + 1) % len(order)]}" for k, i in enumerate(order)}


def test_spot_signatures_of_odd_rows(odd):
    found = spotsigs.with_next(odd).toPandas()
    assert len(found) == len(ODD) + 3 and found.next_text.notna().all()


def test_likeness_and_groups_beside_all_pairs(spark):
    rng = random.Random(4)
    texts = [prose(k, 90) for k in range(8)]
    texts += [edited(t, rng, rng.randrange(1, 6)) for t in texts * 5] + [texts[0], "", None]
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    prints = spotsigs.with_signatures(docs, "text", "signatures").selectExpr("doc_id as id", "signatures")
    sets = [signatures(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    found = {r.id: r.component for r in spotsigs.near_groups(prints).collect()}
    assert [found.get(k, k) for k in range(len(texts))] == groups_of(len(texts), links)
