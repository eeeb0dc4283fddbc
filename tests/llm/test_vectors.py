"""Searches over vectors beside brute force."""

import numpy as np
import pytest

from forecourt.llm import negatives, neighbours

VECTORS = "vec_id bigint, embedding array<float>, label int"


def table(spark, ids, vectors, labels):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], k)
                                  for i, v, k in zip(ids, vectors, labels, strict=True)], VECTORS)


def clustered(n, d, seed, near=0.3):
    """Some directions with copies, near copies, and rows of other lengths around them."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((7, d))
    rows = centres[rng.integers(0, 7, n)] + near * rng.standard_normal((n, d)) * rng.integers(0, 2, (n, 1))
    return np.round(rows * rng.choice([0.01, 1, 4], (n, 1)), 3).astype(np.float32), rng.integers(0, 3, n)


# Hard negatives


def mined(ids, vectors, labels, every, positives=5, negatives=10, low=30, high=90):
    whole = [[int(np.floor(256 * float(x))) for x in v] for v in vectors]
    score = lambda i, j: sum(a * b for a, b in zip(whole[i], whole[j], strict=True))
    out = []
    for a, anchor in enumerate(ids):
        if anchor % every:
            continue
        others = sorted((-score(a, j), ids[j], labels[j] == labels[a]) for j in range(len(ids)) if ids[j] != anchor)
        for s, positive, _ in [o for o in others if o[2]][:positives]:
            fit = [o for o in others if not o[2] and low * -s <= 100 * -o[0] <= high * -s]
            out += [(anchor, positive, k, n, -s, -t) for k, (t, n, _) in enumerate(fit[:negatives], start=1)]
    return sorted(out)


@pytest.mark.parametrize(("n", "d", "every", "seed"), [(400, 8, 7, 1), (300, 3, 5, 2), (250, 40, 4, 3)])
def test_hard_negatives_as_by_hand(spark, monkeypatch, n, d, every, seed):
    monkeypatch.setattr(negatives, "TOGETHER", 20)  # several blocks of anchors
    vectors, labels = clustered(n, d, seed)
    ids = np.random.default_rng(seed).permutation(n).tolist()
    found = negatives.hard_negatives(table(spark, ids, vectors.tolist(), labels.tolist()), every=every)
    assert sorted(map(tuple, found.collect())) == mined(ids, vectors, labels.tolist(), every)


def test_windows_leave_nothing_out(monkeypatch):
    """Every pair within the bounds lies in the stretch of its block, whatever the norms and the signs."""
    rng = np.random.default_rng(4)
    rows, _ = clustered(500, 6, 5)
    rows = np.vstack([negatives._whole(rows, 256.0), np.zeros((2, 6)), -negatives._whole(rows[:40], 256.0)])
    references = negatives._directions(rows[:100], 8)
    angles = negatives._angles(rows, references).astype(np.float32).astype(np.float64)
    scores = rows @ rows.T
    least = rng.uniform(-1, 1, len(rows)) * np.abs(scores).max(1)
    most = least + rng.uniform(0, 1, len(rows)) * np.abs(scores).max(1)
    asked = negatives.Anchors(np.arange(len(rows)), np.zeros(len(rows)), rows, angles, least, most)
    scored = 0
    for own in range(len(references)):
        order = np.argsort(angles[:, own], kind="stable")[rng.integers(0, 3) :: 3]
        seen = np.zeros((len(rows), len(order)), bool)
        for k, start, end in negatives._windows(asked, own, rows[order], angles[order]):
            seen[k, start:end] = True
        inside = (scores[:, order] >= least[:, None]) & (scores[:, order] <= most[:, None])
        assert not (inside & ~seen).any()
        scored += seen.mean() / len(references)
    assert scored < 0.9


def test_far_blocks_are_not_scored():
    """Two bundles of rows at right angles: an anchor meets no row of the other one."""
    rng = np.random.default_rng(6)
    rows = np.round(1000 * np.repeat(np.eye(2, 16), 200, axis=0) + rng.normal(0, 20, (400, 16)))
    references = negatives._directions(rows, 2)
    angles = negatives._angles(rows, references)
    high = np.full(2, np.inf)
    asked = negatives.Anchors(np.array([0, 399]), np.zeros(2), rows[[0, 399]], angles[[0, 399]], np.full(2, 5e5), high)
    for block, met in ((rows[:200], 0), (rows[200:], 1)):
        a = negatives._angles(block, references)
        own = int(np.argmin(a.mean(0)))
        order = np.argsort(a[:, own])
        assert {k for k, _, _ in negatives._windows(asked, own, block[order], a[order])} == {met}


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors, labels = clustered(120, 4, 7)
    rows = [(i, v, k) for i, (v, k) in enumerate(zip(vectors.tolist(), labels.tolist(), strict=True))]
    odd = [(None, [1, 1, 1, 1], 1), (200, None, 1), (210, [1, 1, nan, 1], 1), (220, [1, 1, -inf, 1], 0), (230, [1, None, 1, 1], 0),
           (240, [1, 1, 1, 1], None), (250, [1, 1, 1], 1), (260, [], 0), rows[5], rows[10]]
    zeros = [(300, [0, 0, 0, 0], 1), (310, [0, 0, 0, 0], 0)]
    df = table(spark, *zip(*rows, *odd, *zeros, strict=True))
    from pyspark.sql import functions as F

    df = df.select("*", *[F.lit(1).alias(c) for c in ("score", "rank", "vector", "ref", "whole", "anchor", "Label2")])
    kept = rows + zeros
    wanted = mined(*[list(x) for x in zip(*kept, strict=True)], 10)
    assert sorted(map(tuple, negatives.hard_negatives(df, every=10).collect())) == wanted
    empty = negatives.hard_negatives(df.where("vec_id < 0"))
    assert empty.collect() == [] and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.hard_negatives(df.where("vec_id in (1, 2, 3)")).collect() == []


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [2.0**22, 2.0**20 + 1], 1), (1, [2.0**22 - 1, 1.0], 1), (2, [2.0**21 + 3, 2.0**20 + 1], 2), (3, [2.0**21 + 3, 2.0**20 + 1 / 256], 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = sorted(map(tuple, negatives.hard_negatives(df, every=100).collect()))
    assert found == mined([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], 100) and len(found) == 2


# Nearest neighbours


def brute(ids, vectors, every, most):
    x = np.asarray(vectors, np.float64)
    out = {}
    for a in np.flatnonzero(np.asarray(ids) % every == 0):
        s = (x * x[a]).sum(1)
        others = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[a]]
        out[int(ids[a])] = [(int(ids[j]), float(s[j])) for j in others[:most]]
    return out


def searched(df, **options):
    found = {}
    for r in neighbours.nearest(df, **options).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def recall(found, wanted):
    return np.mean([len({i for i, _ in found[q]} & {i for i, _ in w}) / len(w) for q, w in wanted.items()])


@pytest.mark.parametrize(("n", "d", "seed"), [(3000, 24, 1), (2500, 64, 2)])
def test_neighbours_reach_the_recall(spark, monkeypatch, n, d, seed):
    """Rows without any clusters, the hardest case, of several lengths: the largest products must be found."""
    monkeypatch.setattr(neighbours, "RUN", 256)
    monkeypatch.setattr(neighbours, "CHUNK", 8)
    monkeypatch.setattr(neighbours, "FIRST", 32)
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((n, d)) * rng.uniform(0.5, 1.5, (n, 1))).astype(np.float32)
    ids = rng.permutation(n)
    df = table(spark, ids.tolist(), x.tolist(), [None] * n).repartition(5)
    wanted = brute(ids, x, 20, 20)
    for few in (1 << 30, 0):  # queries broadcast, and shuffled
        monkeypatch.setattr(neighbours, "FEW_BYTES", few)
        found = searched(df)
        assert found.keys() == wanted.keys() and all(len(f) == 20 for f in found.values())
        assert recall(found, wanted) >= 0.9
        near = {int(i): v for i, v in zip(ids, x.astype(np.float64), strict=True)}
        assert all(s == pytest.approx(float((near[q] * near[i]).sum()), rel=1e-12, abs=1e-12) for q, f in found.items() for i, s in f)


def test_neighbours_among_copies_and_clusters(spark, monkeypatch):
    """A third of all rows are one vector, another third lies close together: ties go to the smaller ids."""
    monkeypatch.setattr(neighbours, "RUN", 128)
    monkeypatch.setattr(neighbours, "FIRST", 16)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[:500] = x[0]
    x[500:1000] = x[500] + 0.02 * x[500:1000]
    ids = rng.permutation(1500)
    wanted = brute(ids, x, 20, 20)
    found = searched(table(spark, ids.tolist(), x.tolist(), [1] * 1500))
    assert recall(found, wanted) >= 0.9
    for a in np.flatnonzero((ids % 20 == 0) & (np.arange(1500) < 500)):
        assert [i for i, _ in found[int(ids[a])]] == [i for i, _ in wanted[int(ids[a])]]


def test_odd_vectors_are_not_searched(spark):
    nan, inf = float("nan"), float("inf")
    x, _ = clustered(60, 5, 8)
    x += 1
    rows = [(i, v, 1) for i, v in enumerate(x.tolist())]
    odd = [(None, x[0].tolist(), 1), (200, None, 1), (220, [1, 1, nan, 1, 1], 1), (240, [1, 1, -inf, 1, 1], 0), (260, [1, None, 1, 1, 1], 0),
           (280, [0, 0, 0, 0, 0], 1), (300, [1, 1, 1], 1), (320, [], 0), rows[5], rows[20]]
    from pyspark.sql import functions as F

    df = table(spark, *zip(*rows, *odd, strict=True)).select("*", *[F.lit(1).alias(c) for c in ("score", "rank", "vector", "code", "run", "query_id")])
    for most in (20, 100):
        wanted = brute(np.arange(60), x, 20, most)
        found = searched(df, most=most, recall=1.0)
        assert {q: [i for i, _ in f] for q, f in found.items()} == {q: [i for i, _ in w] for q, w in wanted.items()}
    few = searched(df.where("vec_id in (0, 7, 200)"))
    assert {q: [i for i, _ in f] for q, f in few.items()} == {0: [7]}
    assert searched(df.where("vec_id = 0")) == {} and searched(df.where("vec_id < 0")) == {}
    assert neighbours.nearest(df.where("vec_id < 0")).columns == ["query_id", "rank", "vec_id", "score"]
    doubles = df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    assert searched(doubles, most=3, recall=1.0).keys() == {0, 20, 40}


def test_prefixes():
    codes = np.sort(np.random.default_rng(1).integers(0, 1 << 60, 1000))
    for least in (1, 7, 100, 1000, 5000):
        for code in (codes[3], np.int64(0), np.int64((1 << 60) - 1)):
            start, end = neighbours._descent(codes, code, least)
            wanted = min(k for k in range(61) if np.count_nonzero(codes >> k == code >> k) >= min(least, 1000))
            assert np.flatnonzero(codes >> wanted == code >> wanted).tolist() == list(range(start, end))
    level = neighbours._level(np.array([1.0, 0.4, -1.0, -np.inf]), np.ones(4), 1.0, 0.9)
    assert level[0] == neighbours.BITS and level[1] == 2 and level[3] == 0
