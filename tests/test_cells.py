"""Pairs, neighbours and components of vectors that are dealt out in cells, against brute force."""

import numpy as np
import pytest

from weftline.operators import vectors


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(vectors, "_BLOCK", 16)
    monkeypatch.setattr(vectors, "_SCANNED", 10)


@pytest.fixture(scope="module")
def some(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1200, 16)).astype(np.float32)
    x[700:720] = x[3]
    df = spark.createDataFrame([(i, v.tolist(), "abc"[i % 3] if i % 50 else None) for i, v in enumerate(x)], "k long, v array<float>, g string").repartition(4).localCheckpoint()
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    return df, unit @ unit.T


def moved(spark):
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    none = sc._gateway.new_array(sc._gateway.jvm.double, 0)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, none, None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_neighbours_move_little(spark, small, some):
    df, s = some
    before = moved(spark)
    got = {(r["a"], r["rank"]): r["b"] for r in vectors.nearest(df, "k", "v", 2, 0.3).collect()}
    assert moved(spark) - before < 1200 * 16 * 3 + 10_000
    s = np.where(np.eye(1200, dtype=bool), -1, s.round(12))
    for a in range(1200):
        best = [b for b in np.lexsort((np.arange(1200), -s[a]))[:2] if s[a, b] >= 0.3]
        assert [got.get((a, i + 1)) for i in range(len(best))] == best
    assert [got[3, 1], got[3, 2], got[719, 1], got[719, 2]] == [700, 701, 3, 700]


def test_all_pairs_meet(spark, small, some):
    df, s = some
    got = {(r["a"], r["b"]) for r in vectors.similar_pairs(df, "k", "v", 0.3).collect()}
    assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(np.triu(s >= 0.3, 1))), strict=True))
    apart = {(r["a"], r["b"]) for r in vectors.similar_pairs(df, "k", "v", 0.3, ["g"]).collect()}
    assert apart == {(a, b) for a, b in got if a % 3 == b % 3 and a % 50 and b % 50}


def test_groups_move_no_pairs(spark, small, some):
    df, s = some
    before = moved(spark)
    got = {(r["a"], r["b"]): r["cosine"] for r in vectors.nearest_groups(df, "k", "v", "g", 0.3).collect()}
    assert moved(spark) - before < 1200 * 17 + 1000
    name = np.array(["abc"[i % 3] if i % 50 else "" for i in range(1200)])
    want = {(a, b): s[np.ix_(name == a, name == b)].max() for a, b in ("ab", "ac", "bc")}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-12 for p in want)


def test_components_move_forests(spark, small, some):
    df, s = some
    before = moved(spark)
    got = {r["k"]: r["cluster"] for r in vectors.similar_components(df, "k", "v", 0.5, ["g"]).collect()}
    assert moved(spark) - before < 1200 * 16 * 5
    want = np.arange(1200)
    key = np.arange(1200)
    linked = (s >= 0.5) & (key[:, None] % 3 == key % 3) & (key[:, None] % 50 > 0) & (key % 50 > 0)
    for _ in range(40):
        want = np.minimum(want, np.where(linked, want[None, :], 1200).min(axis=1))
    assert got == dict(enumerate(want.tolist()))
