"""Problem 8: items packed into containers of fixed capacity by vector best-fit.

A container has three capacities: tokens, number of items, and attention cost (the sum of squared
lengths). Items are dealt by the hash of their keys to shards of bounded size; in each shard they are
taken from the largest to the smallest and put where the weighted norm of what would be left is least,
among all containers that have room under every constraint. Only an item that alone exceeds the tokens
is cut, into full pieces and a rest; one that alone exceeds the attention cost stands by itself.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.session import cut

#: Items that one task packs, about; every shard may leave a few containers that aren't full.
SHARD_ITEMS = 25_000
#: Equal items (of one key and size) that are dealt together at most.
DEALT_TOGETHER = 500


@dataclass(frozen=True)
class Capacity:
    """Limits of one container; without ``items`` or ``attention`` there is no such limit."""

    name: str
    tokens: int
    items: int | None = None
    attention: float | None = None

    def __post_init__(self):
        if not self.tokens or self.tokens < 1 or self.items is not None and self.items < 1 or self.attention is not None and self.attention < 1:
            raise ValueError(f"capacities of {self.name!r} must be at least 1")


def best_fit(sizes: Sequence[int], capacity: Capacity, weights: tuple[float, float, float] = (1.0, 0.02, 0.1)) -> list[int]:
    """The container number of every item, in the order given; no size may exceed ``capacity.tokens``.

    The weights are those of the residual tokens, items and cost, each relative to its capacity. The
    open containers are kept in order of residual tokens. Since the norm is at least its part of the
    tokens, only those are compared whose tokens alone don't make it larger than that of the first that
    fits; the choice is the same as among all. Equal norms go to the container with less room, then to
    the older one.
    """
    lengths = np.asarray(sizes, dtype=np.int64)
    if not len(lengths):
        return []
    least = int(lengths.min())
    most_items, most_cost = capacity.items or len(lengths), capacity.attention
    w_tokens, w_items = weights[0] / capacity.tokens**2, weights[1] / most_items**2 if capacity.items else 0.0
    w_cost = weights[2] / most_cost**2 if most_cost else 0.0
    left = np.empty(1024, dtype=np.int64)
    items, cost, number = np.empty(1024, dtype=np.int64), np.empty(1024), np.empty(1024, dtype=np.int64)
    columns = [left, items, cost, number]
    n = made = 0
    out = [0] * len(lengths)
    for at in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[at])
        square = float(size) * size
        chosen = -1
        low = int(columns[0][:n].searchsorted(size))
        while low < n:
            fits = columns[2][low:n] >= square
            first = low + int(fits.argmax())
            if not fits[first - low]:
                break
            bound = w_tokens * (int(columns[0][first]) - size) ** 2 + w_items * (int(columns[1][first]) - 1) ** 2 + (w_cost * (float(columns[2][first]) - square) ** 2 if most_cost else 0.0)
            high = int(columns[0][first:n].searchsorted(size + math.sqrt(bound / w_tokens), side="right")) + first
            rest = slice(first, max(high, first + 1))
            norm = w_tokens * (columns[0][rest] - size).astype(np.float64) ** 2
            if w_items:
                norm += w_items * (columns[1][rest] - 1).astype(np.float64) ** 2
            if most_cost:
                norm += w_cost * (columns[2][rest] - square) ** 2
                norm[columns[2][rest] < square] = np.inf
            chosen = first + int(norm.argmin())
            break
        if chosen < 0:
            tokens_left, items_left, cost_left, own = capacity.tokens, most_items, most_cost if most_cost else math.inf, made
            made += 1
        else:
            tokens_left, items_left, cost_left, own = (int(columns[0][chosen]), int(columns[1][chosen]), float(columns[2][chosen]), int(columns[3][chosen]))
            for c in columns:
                c[chosen : n - 1] = c[chosen + 1 : n]
            n -= 1
        out[at] = own
        after = (tokens_left - size, items_left - 1, cost_left - square, own)
        # what has no room for the smallest item needn't be looked at again
        if after[0] >= least and after[1] > 0 and after[2] >= float(least) * least:
            if n == len(columns[0]):
                columns = [np.concatenate([c, np.empty_like(c)]) for c in columns]
            place = int(columns[0][:n].searchsorted(after[0], side="right"))
            for c, v in zip(columns, after):
                c[place + 1 : n + 1] = c[place:n]
                c[place] = v
            n += 1
    return out


def pack(sizes: DataFrame, key: str, tokens: str, capacities: Sequence[Capacity], shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Every item in a container of every run: run_name, container, key, piece_index, first_token, tokens.

    An item over the capacity comes in pieces, numbered from 0; others have piece 0 only. A null or
    negative size counts as 0 and takes an item's place. Repeated keys are items of their own; null
    keys too. The result depends on keys and sizes alone, not on how the rows are parted. An empty
    table gives no rows.
    """
    names = [c.name for c in capacities]
    if len(set(names)) != len(names):
        raise ValueError("runs must have different names")
    made = {"run_name", "container", "piece_index", "first_token", "tokens"}
    if key in made:
        raise ValueError(f"the key column clashes with {sorted(made)}")
    each = sizes.select(F.col(key), F.greatest(F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)), F.lit(0)).alias("__size"))
    # equal items are counted, not carried one by one, and come apart again where they are packed
    rows = cut(each.groupBy(key, "__size").agg(F.count(F.lit(1)).alias("__n")))
    shards = max(1, -(-(rows.agg(F.sum("__n").alias("n")).first()["n"] or 0) // shard_items))
    runs = F.explode(F.array(*[F.struct(F.lit(i).alias("run"), F.lit(c.tokens).cast("bigint").alias("largest")) for i, c in enumerate(capacities)]))
    blocks = rows.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__n") - 1) / DEALT_TOGETHER))))
    dealt = blocks.withColumn("__hash", F.xxhash64(key, "__size", "__block")).withColumn("__n", F.least(F.lit(DEALT_TOGETHER).cast("bigint"), F.col("__n") - F.col("__block") * DEALT_TOGETHER).cast("int"))
    items = dealt.withColumn("__run", runs).select(key, F.col("__run.run").alias("__run"), F.col("__run.largest").alias("__largest"), F.pmod(F.col("__hash"), F.lit(shards)).alias("__shard"), "__hash", "__size", "__n")
    schema = T.StructType([T.StructField("run_name", T.StringType()), T.StructField("container", T.LongType()), sizes.schema[key], T.StructField("piece_index", T.IntegerType()), T.StructField("first_token", T.LongType()), T.StructField("tokens", T.LongType())])
    packed = tuple(capacities)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("__size", "descending"), ("__hash", "ascending")])
        capacity = packed[group["__run"][0].as_py()]
        base = group["__shard"][0].as_py() << 32
        size, copies = group["__size"].to_numpy(), group["__n"].to_numpy()
        whole = np.repeat(np.arange(len(size)), copies)
        pieces = np.maximum(1, -(-size[whole] // capacity.tokens))
        owner = np.repeat(whole, pieces)
        piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = piece * capacity.tokens
        length = np.minimum(capacity.tokens, size[owner] - first)
        containers = np.asarray(best_fit(length, capacity), dtype=np.int64) + base
        return pa.table({"run_name": pa.array([capacity.name] * len(owner), pa.string()), "container": containers, key: group[key].take(pa.array(owner)), "piece_index": piece.astype(np.int32), "first_token": first, "tokens": length})

    return items.groupBy("__run", "__shard").applyInArrow(run, schema)
