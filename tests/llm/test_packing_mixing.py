import random

import pytest
from pyspark.sql import functions as F

from ostraka.llm import mixing, packing


def check(sizes, capacity):
    bins = {}
    for size, number in zip(sizes, packing.best_fit(sizes, capacity)):
        bins.setdefault(number, []).append(size)
    for items in bins.values():
        assert sum(items) <= capacity.tokens and len(items) <= (capacity.items or len(sizes))
        assert len(items) == 1 or sum(x * x for x in items) <= (capacity.attention or float("inf"))
    return bins


def choose_among_all(sizes, capacity, weights=(1.0, 0.02, 0.1)):
    """Best fit that looks at every container for every item."""
    bins, out = [], [0] * len(sizes)
    for at in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size, best = sizes[at], None
        for k, (left, items, cost, age) in enumerate(bins):
            if left >= size and items > 0 and cost >= size * size:
                norm = weights[0] * ((left - size) / capacity.tokens) ** 2
                norm += weights[1] * ((items - 1) / capacity.items) ** 2 if capacity.items else 0
                norm += weights[2] * ((cost - size * size) / capacity.attention) ** 2 if capacity.attention else 0
                if best is None or (round(norm, 12), left) < best[:2]:
                    best = (round(norm, 12), left, k)
        if best is None:
            bins.append([capacity.tokens, capacity.items or len(sizes), capacity.attention or float("inf"), 0])
            k = len(bins) - 1
        else:
            k = best[2]
        bins[k] = [bins[k][0] - size, bins[k][1] - 1, bins[k][2] - size * size, 0]
        out[at] = k
    return out, len(bins)


CAPACITIES = [packing.Capacity("a", 100), packing.Capacity("b", 100, items=3), packing.Capacity("c", 100, attention=4000.0), packing.Capacity("d", 100, items=4, attention=3000.0)]


@pytest.mark.parametrize("capacity", CAPACITIES)
def test_every_limit_holds(capacity):
    rng = random.Random(1)
    sizes = [rng.randint(0, 100) for _ in range(500)]
    bins = check(sizes, capacity)
    assert sum(map(len, bins.values())) == 500
    if capacity.name == "a":
        assert len(bins) <= 1.02 * sum(sizes) / 100 + 1


@pytest.mark.parametrize("capacity", CAPACITIES)
def test_the_choice_is_that_among_all_containers(capacity):
    rng = random.Random(7)
    sizes = rng.sample(range(1, 3000), 400)
    wide = packing.Capacity(capacity.name, 3000, capacity.items, capacity.attention and 900.0 * capacity.attention)
    found = packing.best_fit(sizes, wide)
    assert (max(found) + 1) == choose_among_all(sizes, wide)[1]


def test_each_limit_binds():
    rng = random.Random(2)
    sizes = [rng.randint(1, 60) for _ in range(600)]
    free = packing.best_fit(sizes, packing.Capacity("free", 100))
    few = check(sizes, packing.Capacity("few", 100, items=2))
    cheap = check(sizes, packing.Capacity("cheap", 100, attention=2500.0))
    assert max(map(len, few.values())) == 2 and len(few) > max(free) + 1
    assert len(cheap) > max(free) + 1
    assert any(sum(x * x for x in b) > 2500 for b in check(sizes, packing.Capacity("free", 100)).values())
    # an item that alone exceeds the cost isn't cut; it stands by itself
    assert [b for b in cheap.values() if max(b) > 50 and len(b) > 1] == []


def test_packing_of_tables(spark):
    rows = [(i, 10 + i % 50, "x") for i in range(300)] + [(1000, 950, None), (1001, None, None), (1001, 0, None), (None, 7, None), (1002, -3, None)]
    df = spark.createDataFrame(rows, "id int, size bigint, container string")
    runs = [packing.Capacity("short", 100), packing.Capacity("long", 400)]
    got = packing.pack(df, "id", "size", runs, shard_items=120).collect()
    for run in runs:
        mine = [r for r in got if r.run_name == run.name]
        bins = {}
        for r in mine:
            bins[r.container] = bins.get(r.container, 0) + r.tokens
        assert max(bins.values()) <= run.tokens
        assert sum(r.tokens for r in mine) == sum(max(0, s or 0) for _, s, _ in rows)
        pieces = sorted((r.piece_index, r.first_token, r.tokens) for r in mine if r.id == 1000)
        assert len(pieces) == -(-950 // run.tokens) and pieces[0][2] == run.tokens and sum(p[2] for p in pieces) == 950
        assert sum(r.piece_index > 0 for r in mine) == len(pieces) - 1
        assert len(mine) == len(rows) + len(pieces) - 1
    again = packing.pack(df.repartition(7), "id", "size", runs, shard_items=120).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    copies = spark.createDataFrame([(5, 10)] * 3000, "id int, size bigint")
    assert packing.pack(copies, "id", "size", runs[:1], shard_items=1000).groupBy("container").count().count() == 300
    assert packing.pack(df.limit(0), "id", "size", runs).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, "container", "size", runs)
    with pytest.raises(ValueError):
        packing.Capacity("x", 0)


def documents(spark, n=3000):
    rng = random.Random(3)
    rows = [(i, rng.choices(["a", "b", "c"], [70, 25, 5])[0], int(rng.lognormvariate(5, 1)) + 1) for i in range(n)]
    return spark.createDataFrame([*rows, (-1, None, 50), (-2, "a", None), (-3, "a", 0), (-4, "other", 9)], "id int, source string, n bigint")


TARGETS = [mixing.Target("m", "a", 0.5, 1), mixing.Target("m", "b", 0.3, 2), mixing.Target("m", "c", 0.2, 4), mixing.Target("even", "b", 0.5, 3), mixing.Target("even", "c", 0.5, 3)]


def test_shares_are_reached_within_the_caps(spark):
    mix = mixing.mix_sources(documents(spark), "id", "source", "n", TARGETS)
    caps = {(t.mix, t.source): t.max_repeats for t in TARGETS}
    rows = mix.collect()
    assert sorted(map(str, mixing.mix_sources(documents(spark).repartition(9), "id", "source", "n", TARGETS).collect())) == sorted(map(str, rows))
    assert all(1 <= r.copies <= caps[r.mix_name, r.source] and r.id >= 0 for r in rows)
    assert len({(r.mix_name, r.id) for r in rows}) == len(rows)
    for r in mixing.reached_shares(mix, "id", TARGETS).collect():
        assert r.share == pytest.approx(r.target_share, abs=0.004)


def test_rates_are_the_nearest_in_entropy(spark):
    lengths = spark.createDataFrame([("m", "a", 1.0, 10, 5), ("m", "a", 1.0, 100, 3), ("m", "b", 4.0, 20, 2)], "mix string, source string, cap double, tokens bigint, documents bigint")
    want = {TARGETS[0]: 120.0, mixing.Target("m", "b", 0.5, 4): 100.0}
    lam = mixing.tilts(lengths, want, 10.0)
    import math

    a, b = (lam[t] for t in want)
    assert 5 * 10 * math.exp(a) + 3 * 100 * math.exp(10 * a) == pytest.approx(120.0)
    assert 2 * 20 * math.exp(2 * b) == pytest.approx(100.0)


def test_sources_without_documents_and_bad_targets(spark):
    df = documents(spark, 200)
    targets = [mixing.Target("m", "a", 0.5, 1), mixing.Target("m", "nothing", 0.5, 2)]
    shares = {r.source: r.share for r in mixing.reached_shares(mixing.mix_sources(df, "id", "source", "n", targets), "id", targets).collect()}
    assert shares == {"a": 1.0, "nothing": 0.0}
    assert mixing.mix_sources(df.limit(0), "id", "source", "n", targets).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(df.withColumn("copies", F.col("id")), "copies", "source", "n", targets)
    for bad in ([mixing.Target("m", "a", 0.4, 1)], [mixing.Target("m", "a", 1.0, 0)], [mixing.Target("m", "a", 0.5, 1)] * 2):
        with pytest.raises(ValueError):
            mixing.checked(bad)


def test_one_long_document_and_equal_ones(spark):
    df = spark.createDataFrame([(i, "a", 10) for i in range(50)] + [(99, "b", 100)], "id int, source string, n bigint")
    targets = [mixing.Target("m", "a", 0.5, 3), mixing.Target("m", "b", 0.5, 2)]
    shares = {r.source: r.tokens for r in mixing.reached_shares(mixing.mix_sources(df, "id", "source", "n", targets), "id", targets).collect()}
    assert shares == {"a": 200, "b": 200}
    assert df.agg(F.sum("n")).first()[0] == 600
