import math

import numpy as np
from pyspark.sql import functions as F

from trendlake.llm import _topk, topk_search
from trendlake.llm.topk_search import search

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(given, k):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in given if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(usable):
        if i is None or i % 50:
            continue
        held = lambda s: max(min(s, 2**63 - 1), -(2**63))
        scored = [(-held(sum(x * y for x, y in zip(q, v, strict=False))), j is None, j or 0) for b, (j, v) in enumerate(usable) if a != b]
        out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(df, k=5):
    got = search(df, F.col("id") % 50 == 0, k=k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 12))
    given = [(i, (centres[i // 100] + 0.2 * rng.normal(size=12)).tolist()) for i in range(600)]
    given += [(i, [0.5] * 12) for i in range(600, 700)]  # ties
    df = spark.createDataFrame(given, SCHEMA)
    assert found(df) == brute(given, 5)
    monkeypatch.setattr(_topk, "PACK_ROWS", 64)
    monkeypatch.setattr(_topk, "PACK_VALUES", 500)
    assert found(df.repartition(3), k=7) == brute(given, 7)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    given = [
        (0, [1.0, -2.0]), (0, [1.0, -2.0]), (0, [1.0, -2.5]), (50, [1.0]), (100, []), (None, [3.0, 1.0]), (None, None),
        (150, None), (200, [nan, 1.0]), (250, [inf]), (300, [1.0, None]), (1, [1.0, -2.0, 4.0]), (2, [0.0, 0.0]), (3, [-1.0, 0.001]),
    ]
    df = spark.createDataFrame(given, SCHEMA)
    more = df.select("*", F.lit(1).alias("id"), F.lit(2).alias("vector"), F.lit(3).alias("copies"), F.lit(4).alias("VEC_ID"))
    for k in (1, 3, 20):
        assert found(more, k) == brute(given, k)
    assert found(df.where("false")) == []
    assert found(df.where("vec_id = 50")) == []


def test_tiles_meet_without_a_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(3)
    given = [(i, rng.normal(size=6).tolist()) for i in range(900)]
    df = spark.createDataFrame(given, SCHEMA)
    want = brute(given, 4)
    for name, value in (("TILE_CHUNKS", 2), ("TILE_PACKS", 3), ("CHUNK", 5)):
        monkeypatch.setattr(topk_search, name, value)
    monkeypatch.setattr(_topk, "PACK_ROWS", 32)
    assert found(df.repartition(4), 4) == want
    chunks = spark.range(9).selectExpr("id AS chunk", "1 AS n", "1 AS dim", "array(id) AS flat")
    packs = spark.range(7).selectExpr("id AS pack", "1 AS pack_dim", "array(id) AS pack_high", "array(id) AS pack_low")
    bounds = topk_search._bounds(chunks, packs)
    assert sorted((r.chunk, r.pack) for r in bounds.collect()) == [(c, p) for c in range(9) for p in range(7)]
    plan = spark._jvm.PythonSQLUtils.explainString(bounds._jdf.queryExecution(), "simple")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Broadcast" not in plan


def test_very_large_components_stay_exact(spark):
    near = [(50 * i, [1.0e7 + 3 * i, -1.0, 0.004 * i]) for i in range(9)]
    beyond = [(50 * i, [3.0e15 + i * 1e14, -1.0]) for i in range(6)]
    for given in (near, beyond):
        assert found(spark.createDataFrame(given, SCHEMA), 3) == brute(given, 3)


def test_bounds_hold_and_blocks_are_left_out():
    rng = np.random.default_rng(8)
    vectors = np.sort(rng.integers(0, 1000, (640, 4)), axis=0)
    queries = vectors[::50]
    spans = _topk._blocks(len(vectors))
    high = np.array([vectors[a:b].max(axis=0) for a, b in spans])
    low = np.array([vectors[a:b].min(axis=0) for a, b in spans])
    limits = _topk.bound(queries, high, low)
    scores = queries @ vectors.T
    for s, (a, b) in enumerate(spans):
        assert (scores[:, a:b].max(axis=1) <= limits[:, s]).all()
    seen = []
    plain = _topk.dot

    def counted(a, b):
        seen.append(len(a) * len(b))
        return plain(a, b)

    _topk.dot, least = counted, np.full(len(queries), -(2**63))
    try:
        _topk.best(queries, np.full(len(queries), -1), least, vectors, np.arange(640), np.ones(640, int), high, low, 5)
    finally:
        _topk.dot = plain
    assert sum(seen) < len(queries) * len(vectors) / 2
