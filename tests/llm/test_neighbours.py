import numpy as np
import pytest
from pyspark.sql import functions as F

from ostraka.llm import neighbours as nb


def brute(rows, k, least):
    """{(group, key): [(key, cosine)]}: by cosine, then key; a repeated key counts once."""
    out = {}
    groups = {}
    for g, key, v in rows:
        if g is not None and v is not None and len(v):
            unit = nb.unit_rows(np.asarray([v], dtype=np.float32))[0]
            if not np.isnan(unit[0]):
                groups.setdefault(g, {}).setdefault(key, unit)
    for g, members in groups.items():
        for key, v in members.items():
            near = sorted(((1.0 if (v == w).all() else round(float(v.astype(float) @ w.astype(float)), 9), other) for other, w in members.items() if other != key), key=lambda x: (-x[0], x[1]))
            out[g, key] = [(o, s) for s, o in near if s >= least][:k]
    return out


def found(spark, rows, k, **options):
    df = spark.createDataFrame([(g, x, c, [float(a) for a in v] if v is not None else None, "z") for g, (x, c), v in rows], "m string, x bigint, c int, v array<float>, key string")
    got = {}
    for r in nb.similar_vectors(df, "m", ["x", "c"], "v", k, **options).collect():
        got.setdefault((r.grp, (r.a.k0, r.a.k1)), []).append(((r.b.k0, r.b.k1), r.similarity))
    return got


def sample(n=240, dims=8, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims))
    base[n // 2 :] = base[: n - n // 2] + 0.15 * rng.normal(size=(n - n // 2, dims))
    return [("a" if i % 3 else "b", (i, i % 2), v) for i, v in enumerate(base)]


def test_factor_one_is_exact(spark):
    rows = sample()
    got = found(spark, rows, 5, factor=1.0, least_shards=4, shard_bytes=1280)
    want = brute(rows, 5, -1)
    assert {k: [x for x, _ in v] for k, v in got.items()} == {k: [x for x, _ in v] for k, v in want.items()}


def test_bounded_search_with_a_factor_keeps_recall(spark):
    rows = sample(900, 16, 4)
    got, want = found(spark, rows, 10, least=0.9, factor=4.0, least_shards=4), brute(rows, 10, 0.9)
    hits = sum(len({x for x, _ in v} & {x for x, _ in got.get(k, ())}) for k, v in want.items())
    assert hits >= 0.95 * sum(map(len, want.values()))
    assert all(s >= 0.9 - 1e-6 for v in got.values() for _, s in v)


def test_copies_ties_and_unusable_vectors(spark):
    one, two = [1.0, 0, 0], [0, 1.0, 0]
    rows = [("m", (i, 0), one if i % 3 else [2.0, 0, 0]) for i in range(40)] + [("m", (100, 0), two), ("m", (101, 0), [0.6, 0.8, 0]), ("m", (101, 0), [0.6, 0.8, 0])]
    rows += [("m", (200, 0), [0, 0, 0]), ("m", (201, 0), None), ("m", (202, 0), []), ("m", (203, 0), [float("nan"), 1, 1]), ("m", (204, 0), [1.0, 2.0]), ("m", (206, 0), [1.0, 2.1]), (None, (205, 0), one), ("n", (1, 0), one)]
    got = found(spark, rows, 3, least=0.5, factor=1.0)
    assert [x for x, _ in got["m", (20, 0)]] == [(0, 0), (1, 0), (2, 0)]
    assert [x for x, _ in got["m", (1, 0)]] == [(0, 0), (2, 0), (3, 0)]
    assert [x for x, _ in got["m", (101, 0)]] == [(100, 0), (0, 0), (1, 0)]
    assert [x for x, _ in got["m", (100, 0)]] == [(101, 0)]
    assert not [k for k in got if k[1][0] >= 200 and k[1][0] not in (204, 206)] and ("n", (1, 0)) not in got
    # a rarer length is a space of its own
    assert [x for x, _ in got["m", (204, 0)]] == [(206, 0)] and [x for x, _ in got["m", (206, 0)]] == [(204, 0)]
    assert found(spark, [], 3) == {}


def test_samples_and_shards_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(nb, "SAMPLE_BYTES", 4096)
    rows = sample(900, 16, 4)
    got, want = found(spark, rows, 5, factor=1.0, sample_rows=8, shard_bytes=512), brute(rows, 5, -1)
    assert {k: [x for x, _ in v] for k, v in got.items()} == {k: [x for x, _ in v] for k, v in want.items()}


def test_queries_limit_who_asks(spark):
    rows = sample(120)
    df = spark.createDataFrame([(g, x, c, [float(a) for a in v]) for g, (x, c), v in rows], "m string, x bigint, c int, v array<float>")
    got = nb.similar_vectors(df, "m", ["x", "c"], "v", 4, factor=1.0, query=F.col("x") % 50 == 0).collect()
    want = brute(rows, 4, -1)
    assert {(r.grp, r.a.k0) for r in got} == {(g, x) for g, (x, _), _ in rows if x % 50 == 0}
    for r in got:
        assert (r.b.k0, r.b.k1) in {x for x, _ in want[r.grp, (r.a.k0, r.a.k1)]}


@pytest.mark.parametrize("bad", [{"k": 0}, {"k": 1, "factor": 0.5}])
def test_parameters_are_checked(spark, bad):
    df = spark.createDataFrame([("m", 1, [1.0])], "m string, x int, v array<float>")
    with pytest.raises(ValueError):
        nb.similar_vectors(df, "m", ["x"], "v", **bad)
