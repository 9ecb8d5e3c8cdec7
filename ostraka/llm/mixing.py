"""Problem 9: documents of several sources mixed to target shares of tokens by entropy balancing.

Among all document rates that give every source its share of the tokens, the ones nearest to "each
document once" in entropy are exponentially tilted: rate = min(cap, exp(lambda * tokens)), with one
lambda for each source of a mix. Newton steps on the convex dual find the lambdas; the sums of every
step come from one distributed aggregation over the counts of equal lengths. The rates are then
rounded to copies with two thresholds per source, for long documents and for short ones, that are set
so that the tokens come out right.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ostraka.session import cut

#: Newton stops when every source is this near to its target, relatively.
TOLERANCE = 1e-9
#: A source that ends further from its target, relatively, is an error. The steps end by themselves: each halves a bracket.
LOOSE = 1e-6
#: Steps of the rounding threshold between -1 and 1.
LEVELS = 1 << 14


@dataclass(frozen=True)
class Target:
    mix: str
    source: str
    share: float
    max_repeats: int


def checked(targets: Sequence[Target]) -> list[Target]:
    """Targets must be positive shares of a mix that sum to 1, each source once."""
    seen: set[tuple[str, str]] = set()
    sums: dict[str, float] = {}
    for t in targets:
        if t.share < 0 or t.max_repeats < 1 or (t.mix, t.source) in seen:
            raise ValueError(f"bad target {t}")
        seen.add((t.mix, t.source))
        sums[t.mix] = sums.get(t.mix, 0) + t.share
    if any(abs(s - 1) > 1e-6 for s in sums.values()):
        raise ValueError(f"shares must sum to 1: {sums}")
    return [t for t in targets if t.share > 0]


def wanted_tokens(targets: Sequence[Target], available: dict[str, int]) -> dict[Target, float]:
    """Tokens that each source must give: the largest mix in which every source keeps within its cap.

    Sources without tokens get none; the shares of the others of that mix are scaled up.
    """
    out = {}
    for mix in dict.fromkeys(t.mix for t in targets):
        own = [t for t in targets if t.mix == mix and available.get(t.source, 0) > 0]
        whole = sum(t.share for t in own)
        if own:
            total = min(t.max_repeats * available[t.source] * whole / t.share for t in own)
            out |= {t: total * t.share / whole for t in own}
    return out


def _lookup(values: dict[tuple[str, str], float], mix: Column, source: Column) -> Column:
    pairs = [F.lit(x) for (m, s), v in values.items() for x in (f"{m}\0{s}", float(v))]
    return F.create_map(*pairs)[F.concat(mix, F.lit("\0"), source)]


def tilts(lengths: DataFrame, want: dict[Target, float], unit: float) -> dict[Target, float]:
    """Lambda of every target, by safeguarded Newton steps on the logarithm of the tokens given.

    ``lengths`` has mix, source, cap, tokens and documents, one row for each length. All targets
    step together; each step is one aggregation whose result is one row for each target.
    """
    lam = {t: 0.0 for t in want}
    low, high = {t: -math.inf for t in want}, {t: math.inf for t in want}
    done: set[Target] = set()
    by_name = {(t.mix, t.source): t for t in want}
    x = F.col("tokens") / F.lit(unit)
    gaps: dict[Target, float] = {}
    while len(done) < len(want):
        at = _lookup({(t.mix, t.source): v for t, v in lam.items()}, F.col("mix"), F.col("source"))
        free = F.least(at * x, F.lit(700.0)) < F.ln(F.col("cap"))
        rate = F.when(free, F.exp(F.least(at * x, F.lit(700.0)))).otherwise(F.col("cap"))
        mass = F.col("documents") * F.col("tokens") * rate
        sums = lengths.groupBy("mix", "source").agg(F.sum(mass).alias("given"), F.sum(F.when(free, mass * x).otherwise(0.0)).alias("slope"))
        for r in sums.collect():
            t = by_name[r["mix"], r["source"]]
            if t in done:
                continue
            gap = gaps[t] = math.log(r["given"] / want[t]) if r["given"] > 0 else -math.inf
            if abs(gap) < TOLERANCE:
                done.add(t)
                continue
            if gap > 0:
                high[t] = lam[t]
            else:
                low[t] = lam[t]
            step = lam[t] - gap * r["given"] / r["slope"] if r["slope"] > 0 and math.isfinite(gap) else math.nan
            if not low[t] < step < high[t]:
                step = (low[t] + high[t]) / 2 if math.isfinite(low[t] + high[t]) else lam[t] - math.copysign(max(1.0, abs(lam[t])), gap)
            if step == lam[t] or step > 1e6:  # between neighbouring numbers, or all at their cap
                done.add(t)
            else:
                lam[t] = step
    loose = {f"{t.mix}/{t.source}": gap for t, gap in gaps.items() if abs(gap) > LOOSE}
    if loose:
        raise ArithmeticError(f"no rates give these sources their tokens: {loose}")
    return lam


def mix_sources(sizes: DataFrame, key: str, source: str, tokens: str, targets: Sequence[Target]) -> DataFrame:
    """The selection of every mix: mix_name, key, source, tokens, copies (at least 1).

    Documents of a source that a mix doesn't name, with null source, or without tokens, aren't
    selected. Repeated keys are documents of their own. The result depends on keys, sources and tokens
    alone, not on how the rows are parted. An empty table gives no rows.
    """
    if key in ("mix_name", "source", "tokens", "copies"):
        raise ValueError(f"the key column {key!r} clashes with a column that is made")
    targets = checked(targets)
    named = sorted({t.source for t in targets})
    given = sizes.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(tokens).cast("bigint").alias("tokens")).filter((F.col("tokens") > 0) & F.col("source").isin(named))
    rows = cut(given.groupBy("key", "source", "tokens").agg(F.count(F.lit(1)).alias("n")))
    lengths = cut(rows.groupBy("source", "tokens").agg(F.sum("n").alias("documents")))
    available = {r["source"]: r["n"] for r in lengths.groupBy("source").agg(F.sum(F.col("tokens") * F.col("documents")).alias("n")).collect()}
    want = wanted_tokens(targets, available)
    empty = f"mix_name string, {key} {sizes.schema[key].dataType.simpleString()}, source string, tokens bigint, copies int"
    if not want:
        return sizes.sparkSession.createDataFrame([], empty)
    by_source = {s: [t for t in want if t.source == s] for s in named}
    uses = F.create_map(*[x for s, own in by_source.items() if own for x in (F.lit(s), F.array(*[F.struct(F.lit(t.mix).alias("mix"), F.lit(float(t.max_repeats)).alias("cap")) for t in own]))])
    spread = lambda df: df.withColumn("use", F.explode(uses[F.col("source")])).select("*", F.col("use.mix").alias("mix"), F.col("use.cap").alias("cap")).drop("use")
    counts = lengths.agg(F.sum("documents").alias("n")).first()["n"]
    unit = sum(available.values()) / counts
    lam = tilts(spread(lengths), want, unit)

    exponent = F.least(_lookup({(t.mix, t.source): v for t, v in lam.items()}, F.col("mix"), F.col("source")) * F.col("tokens") / F.lit(unit), F.lit(700.0))
    rate = F.least(F.exp(exponent), F.col("cap"))
    chance = F.pmod(F.xxhash64("key", "tokens", "row", "mix"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rated = spread(rows.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))).withColumn("rate", rate).withColumn("whole", F.floor("rate").cast("int"))
    rated = rated.withColumn("level", F.floor((chance - (F.col("rate") - F.col("whole")) + 1) * (LEVELS // 2)).cast("int")).withColumn("room", (F.col("whole") < F.col("cap")).cast("int"))

    # two thresholds for each target, that of the long documents first: one that leaves a rest which the short ones can give
    mean = F.create_map(*[x for r in lengths.groupBy("source").agg((F.sum(F.col("tokens") * F.col("documents")) / F.sum("documents")).alias("mean")).collect() for x in (F.lit(r["source"]), F.lit(float(r["mean"])))])
    rated = rated.withColumn("long", F.col("tokens") > mean[F.col("source")])
    by_level = cut(
        rated.groupBy("mix", "source", "long", "level").agg(F.sum(F.col("whole") * F.col("tokens")).alias("base"), F.sum(F.col("room") * F.col("tokens")).alias("more"), F.sum(F.col("rate") * F.col("tokens")).alias("expected"))
    )
    goal = _lookup({(t.mix, t.source): v for t, v in want.items()}, F.col("mix"), F.col("source"))
    short = by_level.filter("not long").groupBy("mix", "source").agg(F.sum("base").alias("least"), F.sum("more").alias("span"), F.sum("expected").alias("expected"))
    first = _thresholds(by_level.filter("long").join(short.select("mix", "source", "least", "span", F.col("expected").alias("others")), ["mix", "source"], "left"), goal)
    given = _lookup({k: float(v[1]) for k, v in first.items()}, F.col("mix"), F.col("source")) if first else F.lit(None).cast("double")
    rest = by_level.filter("not long").select("*", F.coalesce(given, F.lit(0.0)).alias("least"), F.lit(0.0).alias("span"), F.coalesce(given, F.lit(0.0)).alias("others"))
    second = _thresholds(rest, goal)
    named_level = lambda found: F.coalesce(_lookup({k: float(v[0]) for k, v in found.items()}, F.col("mix"), F.col("source")), F.lit(-1.0)) if found else F.lit(-1.0)
    threshold = F.when(F.col("long"), named_level(first)).otherwise(named_level(second))
    copies = F.col("whole") + F.when((F.col("room") == 1) & (F.col("level") <= threshold), 1).otherwise(0)
    return rated.withColumn("copies", copies).filter("copies > 0").select(F.col("mix").alias("mix_name"), F.col("key").alias(key), "source", "tokens", F.col("copies").cast("int").alias("copies"))


def _thresholds(by_level: DataFrame, goal: Column) -> dict[tuple[str, str], tuple[int, float]]:
    """(level, tokens given) of every target: the level up to which one more copy of each document is best.

    ``least`` and ``span`` tell what documents without a threshold yet can add, ``others`` what they are
    expected to. The best level leaves the goal within their reach, or nearest to it; then it is the one
    whose expected sum is nearest. One row for each target comes to the driver.
    """
    whole = Window.partitionBy("mix", "source")
    upto = whole.orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    add = (F.coalesce("least", F.lit(0.0)), F.coalesce("span", F.lit(0.0)), F.coalesce("others", F.lit(0.0)))
    levels = by_level.select("mix", "source", "level", (F.sum("base").over(whole) + F.sum("more").over(upto)).alias("sum"), *[c.alias(n) for c, n in zip(add, ("low", "span", "others"))])
    none = by_level.groupBy("mix", "source").agg(F.sum("base").alias("sum"), *[F.max(c).alias(n) for c, n in zip(add, ("low", "span", "others"))]).select("mix", "source", F.lit(-1).alias("level"), "sum", "low", "span", "others")
    rest = goal - F.col("sum")
    miss = F.greatest(F.col("low") - rest, rest - F.col("low") - F.col("span"), F.lit(0.0))
    ranked = levels.unionByName(none).withColumn("miss", miss).withColumn("off", F.abs(rest - F.col("others")))
    best = ranked.groupBy("mix", "source").agg(F.min(F.struct("miss", "off", "level", "sum")).alias("b"))
    return {(r["mix"], r["source"]): (r["b"]["level"], float(r["b"]["sum"])) for r in best.collect()}


def reached_shares(selection: DataFrame, key: str, targets: Sequence[Target]) -> DataFrame:
    """What a selection reached: one row for each target, also for those without documents."""
    spark = selection.sparkSession
    goals = spark.createDataFrame([(t.mix, t.source, float(t.share), int(t.max_repeats)) for t in targets], "mix_name string, source string, target_share double, max_repeats int")
    given = selection.groupBy("mix_name", "source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("copies").alias("most_copies"))
    joined = goals.join(given, ["mix_name", "source"], "left").fillna(0, ["tokens", "documents", "most_copies"])
    total = F.sum("tokens").over(Window.partitionBy("mix_name"))
    return joined.withColumn("share", F.coalesce(F.try_divide(F.col("tokens").cast("double"), total), F.lit(0.0)))
