"""Problem 4: the k most similar vectors of every vector, by vantage-point trees.

Vectors of one group (a model) are scaled to length one and compared by angle, which is a metric.
Exact copies are searched once. A routing tree, fitted on a bounded sample, deals the vectors to
shards; inside a shard a vantage-point tree leads all queries of the shard down together. A branch
is passed over when the triangle inequality, with the search radius divided by ``factor``, says that
nothing near enough lies in it; factor one makes the search exact. The same rule decides which other
shards a query has to visit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.session import cut

#: Vectors of each space from which the routing tree is fitted: so many, or SAMPLE_PER_SHARD for each shard, but
#: never more than SAMPLE_BYTES, so that the driver holds a bounded sample of whatever collection.
SAMPLE_ROWS = 4_096
SAMPLE_PER_SHARD = 16
SAMPLE_BYTES = 1 << 26
#: A shard holds about so many bytes of different vectors; a space has at least LEAST_SHARDS shards, for parallel work.
SHARD_BYTES = 1 << 25
LEAST_SHARDS = 8
LEAF_ROWS = 256
BLOCK_ROWS = 2_048
#: Rows that are widened to double precision at a time.
WIDE_ROWS = 16_384
#: Components are compared to so many decimals when copies are told.
DECIMALS = 6
COSINE_DECIMALS = 9


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, as float32 rounded to DECIMALS; zero or unfinite rows become NaN."""
    wide = np.asarray(values, dtype=np.float64)
    with np.errstate(all="ignore"):
        out = wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))
    out[~np.isfinite(out).all(axis=1)] = np.nan
    return np.round(out, DECIMALS).astype(np.float32) + np.float32(0)


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def dots(vectors: np.ndarray, rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Products of some rows with a point in double precision, a piece at a time; the vectors stay in single."""
    out, wide = np.empty(len(rows)), point.astype(np.float64)
    for begin in range(0, len(rows), WIDE_ROWS):
        out[begin : begin + WIDE_ROWS] = vectors[rows[begin : begin + WIDE_ROWS]].astype(np.float64) @ wide
    return out


@dataclass
class Node:
    """An inner node splits by the angle to its vantage point; a leaf has rows (or, routing, a shard)."""

    point: np.ndarray | None = None
    radius: float = 0.0
    inside: "Node | None" = None
    outside: "Node | None" = None
    rows: np.ndarray | None = None
    shard: int = -1


def build(vectors: np.ndarray, rows: np.ndarray, leaf: int, rng: np.random.Generator) -> Node:
    """A vantage-point tree; equal angles are dealt by order, so that it is always balanced."""
    if len(rows) <= leaf:
        return Node(rows=np.sort(rows))
    candidates = rng.choice(rows, size=min(5, len(rows)), replace=False)
    probe = vectors[rng.choice(rows, size=min(64, len(rows)), replace=False)].astype(np.float64)
    spread = angles(probe @ vectors[candidates].astype(np.float64).T).std(axis=0)
    point = vectors[candidates[int(spread.argmax())]]
    away = angles(dots(vectors, rows, point))
    order = np.argsort(away, kind="stable")
    half = len(rows) // 2
    radius = float(away[order[half - 1]] + away[order[half]]) / 2
    return Node(point, radius, build(vectors, rows[order[:half]], leaf, rng), build(vectors, rows[order[half:]], leaf, rng))


def route(node: Node, vectors: np.ndarray, reach: float) -> list[tuple[np.ndarray, int, bool]]:
    """(rows, shard, home): the shards of every vector, its own and those within reach of a border."""
    out: list[tuple[np.ndarray, int, bool]] = []
    stack = [(node, np.arange(len(vectors)), np.ones(len(vectors), dtype=bool))]
    while stack:
        at, rows, home = stack.pop()
        if not len(rows):
            continue
        if at.point is None:
            out += [(rows[home], at.shard, True), (rows[~home], at.shard, False)]
            continue
        away = angles(dots(vectors, rows, at.point)) - at.radius
        inner = away <= 0
        for child, own, near in ((at.inside, inner, away <= reach), (at.outside, ~inner, away >= -reach)):
            take = own | near
            stack.append((child, rows[take], (home & own)[take]))
    return [x for x in out if len(x[0])]


def search(node: Node, vectors: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, least: float, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """For every query the rows and cosines of its k best, below ``least`` cut off; -1 where there are fewer.

    ``own`` is the row of the query itself, or -1. All queries go down the tree together; a query is
    left out of a branch when its radius, the angle of its k-th best so far, can't reach over the
    border even after division by ``factor``. Of equal cosines the lower row is kept.
    """
    n = len(queries)
    found = np.full((n, k), -1, dtype=np.int64)
    cosines = np.full((n, k), -np.inf)
    widest = float(angles(np.array([least]))[0])

    def radius(rows: np.ndarray) -> np.ndarray:
        worst = cosines[rows, k - 1]
        return np.where(np.isfinite(worst), angles(np.where(np.isfinite(worst), worst, 1.0)), widest).clip(max=widest)

    def visit(at: Node, rows: np.ndarray) -> None:
        if at.point is None:
            for begin in range(0, len(rows), BLOCK_ROWS):
                part = rows[begin : begin + BLOCK_ROWS]
                # rounded, so that equal pairs are equal in whatever block they are multiplied
                similar = np.round(queries[part].astype(np.float64) @ vectors[at.rows].astype(np.float64).T, COSINE_DECIMALS)
                similar[(similar < np.maximum(cosines[part, k - 1], least)[:, None]) | (at.rows[None, :] == own[part][:, None])] = -np.inf
                better = np.isfinite(similar).any(axis=1)
                if better.any():
                    part, similar = part[better], similar[better]
                    every = np.concatenate([cosines[part], similar], axis=1)
                    best = np.argsort(-every, axis=1, kind="stable")[:, :k]
                    numbers = np.concatenate([found[part], np.broadcast_to(at.rows, similar.shape)], axis=1)
                    cosines[part] = np.take_along_axis(every, best, axis=1)
                    found[part] = np.where(np.isfinite(cosines[part]), np.take_along_axis(numbers, best, axis=1), -1)
            return
        away = angles(dots(queries, rows, at.point)) - at.radius
        inner = away <= 0
        for child, first in ((at.inside, inner), (at.outside, ~inner)):
            if first.any():
                visit(child, rows[first])
        for child, other in ((at.inside, ~inner), (at.outside, inner)):
            late = rows[other]
            late = late[np.abs(away[other]) <= radius(late) / factor]
            if len(late):
                visit(child, late)

    if len(vectors) and n:
        visit(node, np.arange(n))
    return found, cosines


@F.arrow_udf(T.BinaryType())
def _unit(values: pa.Array) -> pa.Array:
    out: list[bytes | None] = [None] * len(values)
    lengths = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    for size in np.unique(lengths[lengths > 0]):
        at = np.nonzero(lengths == size)[0]
        flat = values.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        for i, row in zip(at, unit_rows(flat.reshape(-1, size))):
            if not np.isnan(row[0]):
                out[i] = row.tobytes()
    return pa.array(out, pa.binary())


def unit_vector(vector: Column) -> Column:
    """A vector scaled to length one, as float32 bytes; null for null, empty, all-zero and unfinite vectors."""
    return _unit(vector)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.float32).reshape(len(values), -1)


def _numbered(node: Node, numbers) -> Node:
    """A routing tree: leaves get shard numbers instead of rows."""
    if node.point is None:
        return Node(shard=next(numbers))
    return Node(node.point, node.radius, _numbered(node.inside, numbers), _numbered(node.outside, numbers))


def routing_trees(unique: DataFrame, sample_rows: int, shard_bytes: int, least_shards: int) -> dict[tuple[str, int], Node]:
    """The tree of shards of every space: a group and the bytes of its vectors.

    Only one row for each space, and the sample, come to the driver. The sample is what a hash of the
    vectors picks, so that it needs no order and no window. Its bound limits the number of shards: a
    space of more than SAMPLE_BYTES / SAMPLE_PER_SHARD shards' worth has larger shards.
    """
    spaces = {(r["grp"], r["size"]): r["count"] for r in unique.groupBy("grp", F.length("v").alias("size")).count().collect()}
    if not spaces:
        return {}
    shards, wanted = {}, {}
    for (group, size), count in spaces.items():
        most = max(64, SAMPLE_BYTES // size)
        shards[group, size] = max(min(least_shards, -(-count // 16)), min(-(-count * size // shard_bytes), most // SAMPLE_PER_SHARD))
        wanted[group, size] = min(most, max(sample_rows, SAMPLE_PER_SHARD * shards[group, size]))
    name = lambda group, size: f"{size}\0{group}"
    share = F.create_map(*[x for k, n in wanted.items() for x in (F.lit(name(*k)), F.lit(min(1.0, n / spaces[k])))])
    picked = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < F.ceil(share[F.concat_ws("\0", F.length("v").cast("string"), "grp")] * F.lit(float(1 << 30)))
    samples: dict[tuple[str, int], list[bytes]] = {k: [] for k in spaces}
    for r in unique.filter(picked).select("grp", "v").collect():
        samples[r["grp"], len(r["v"])].append(bytes(r["v"]))
    trees = {}
    for (group, size), found in samples.items():
        if not found:  # a few vectors, of which the hash picked none
            trees[group, size] = Node(shard=0)
            continue
        vectors = _matrix(pa.array(sorted(found), pa.binary()))
        depth = min(math.ceil(math.log2(shards[group, size])), max(0, int(math.log2(max(1, len(vectors) // 8)))))
        tree = build(vectors, np.arange(len(vectors)), max(1, -(-len(vectors) // 2**depth)), np.random.default_rng(len(vectors)))
        trees[group, size] = _numbered(tree, iter(range(1 << 30)))
    return trees


def similar_vectors(
    df: DataFrame, group: str, keys: Sequence[str], vector: str, k: int, least: float = -1.0, factor: float = 6.0, query: Column | None = None,
    sample_rows: int = SAMPLE_ROWS, shard_bytes: int = SHARD_BYTES, least_shards: int = LEAST_SHARDS,
) -> DataFrame:
    """The k most similar other keys of every key of one group: grp, a, b (structs of the keys), similarity.

    Repeated keys of a group count once (of several vectors that of the least digest is taken). ``query`` limits the keys that
    ask, not those that may be found. Vectors without a direction or of null group neither ask nor are
    found; those of each length within a group are a space of their own, as vectors of two lengths have
    no angle. Only partners of a cosine of ``least`` or more are given. Of equally similar keys the
    lower come first; copies are searched once and expanded at the end. An empty table gives no rows.
    The number of groups must be small.
    """
    if k < 1 or factor < 1 or not keys:
        raise ValueError("k and factor must be at least 1, and there must be keys")
    asks = F.lit(True) if query is None else F.coalesce(query, F.lit(False))
    rows = df.select(F.col(group).cast("string").alias("grp"), F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)]).alias("key"), asks.alias("asks"), unit_vector(F.col(vector)).alias("v"))
    # copies are told by a digest; keys and digests are settled first, so that a vector is moved once, and no copy of it
    each = rows.filter(F.col("v").isNotNull() & F.col("grp").isNotNull()).withColumn("cid", F.unhex(F.md5("v")))
    rows = cut(each.groupBy("grp", "key").agg(F.min("cid").alias("cid"), F.max("asks").alias("asks")))
    owners = rows.groupBy("grp", "cid").agg(F.min("key").alias("uid"), F.max("asks").alias("asks"), F.count(F.lit(1)).alias("copies"))
    unique = cut(each.groupBy("grp", "cid").agg(F.first("v").alias("v")).join(owners, ["grp", "cid"]))
    trees = routing_trees(unique, sample_rows, shard_bytes, least_shards)
    reach = float(angles(np.array([least]))[0]) / factor
    uid_type, grp_type = unique.schema["uid"].dataType, T.StringType()
    dealt_schema = T.StructType([T.StructField("grp", grp_type), T.StructField("size", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("home", T.BooleanType()), T.StructField("asks", T.BooleanType()), T.StructField("uid", uid_type), T.StructField("v", T.BinaryType())])

    def deal(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            groups = table["grp"].to_numpy()
            asking = table["asks"].to_numpy()
            lengths = pc.binary_length(table["v"]).to_numpy()
            for name, size in set(zip(groups.tolist(), lengths.tolist())):
                tree = trees[name, size]
                at = np.nonzero((groups == name) & (lengths == size))[0]
                mine = table.take(pa.array(at))
                for found, shard, home in route(tree, _matrix(mine["v"]), reach):
                    if not home:
                        found = found[asking[at[found]]]
                    if len(found):
                        part = mine.take(pa.array(found))
                        n = part.num_rows
                        columns = [part["grp"], pa.array([size] * n, pa.int32()), pa.array([shard] * n, pa.int32()), pa.array([home] * n), part["asks"], part["uid"], part["v"]]
                        yield from pa.table(columns, names=["grp", "size", "shard", "home", "asks", "uid", "v"]).to_batches()

    dealt = unique.select("grp", "asks", "uid", "v").mapInArrow(deal, dealt_schema)
    pair_schema = T.StructType([T.StructField("grp", grp_type), T.StructField("a", uid_type), T.StructField("b", uid_type), T.StructField("back", T.BooleanType()), T.StructField("similarity", T.DoubleType())])

    def look(table: pa.Table) -> pa.Table:
        parts = table["uid"].combine_chunks().flatten()
        by = pa.table(parts, names=[f"k{i}" for i in range(len(parts))])
        table = table.take(pc.sort_indices(by, sort_keys=[(n, "ascending") for n in by.column_names], null_placement="at_start"))
        home = np.nonzero(table["home"].to_numpy())[0]
        ask = np.nonzero(table["asks"].to_numpy())[0]
        every = _matrix(table["v"])
        vectors = every[home]
        own = np.full(table.num_rows, -1, dtype=np.int64)
        own[home] = np.arange(len(home))
        tree = build(vectors, np.arange(len(vectors)), LEAF_ROWS, np.random.default_rng(len(vectors))) if len(home) else Node(rows=home)
        found, cosines = search(tree, vectors, every[ask], own[ask], k, least, factor)
        which, place = np.nonzero(found >= 0)
        uid = table["uid"].combine_chunks()
        a = uid.take(pa.array(ask[which]))
        at = home[found[which, place]]
        back = table["asks"].to_numpy()[at]
        return pa.table([pa.array([table["grp"][0].as_py()] * len(which), pa.string()), a, uid.take(pa.array(at)), pa.array(back, pa.bool_()), pa.array(cosines[which, place])], names=["grp", "a", "b", "back", "similarity"])

    one_way = cut(dealt.groupBy("grp", "size", "shard").applyInArrow(look, pair_schema))
    both = one_way.select("grp", "a", "b", "similarity").unionByName(one_way.filter("back").select("grp", F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    pairs = both.groupBy("grp", "a", "b").agg(F.max("similarity").alias("similarity"))

    # members of the vectors that occur under several keys; all others are their own only member
    several = unique.filter("copies > 1").select("grp", "cid", "uid")
    owned = rows.select("grp", "key", "asks", "cid").join(several, ["grp", "cid"], "left").select("grp", "key", "asks", F.coalesce("uid", "key").alias("uid"))
    members = rows.select("grp", "key", "cid").join(several, ["grp", "cid"]).select("grp", "uid", "key").withColumn("place", F.row_number().over(Window.partitionBy("grp", "uid").orderBy("key"))).filter(F.col("place") <= k + 1)
    partners = pairs.join(members.select("grp", F.col("uid").alias("b"), F.col("key").alias("other")), ["grp", "b"], "left").select("grp", "a", F.coalesce("other", "b").alias("key"), "similarity")
    copies = members.select("grp", F.col("uid").alias("a"), "key", F.lit(1.0).alias("similarity"))
    nearest = Window.partitionBy("grp", "a").orderBy(F.desc("similarity"), "key")
    ranked = partners.unionByName(copies).withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= k + 1)
    lists = ranked.groupBy("grp", F.col("a").alias("uid")).agg(F.array_sort(F.collect_list(F.struct("place", "key", "similarity"))).alias("list"))
    answers = owned.filter("asks").join(lists, ["grp", "uid"])
    others = F.slice(F.filter("list", lambda x: x["key"] != F.col("key")), 1, k)
    return answers.select("grp", F.col("key").alias("a"), F.explode(others).alias("x")).select("grp", "a", F.col("x.key").alias("b"), "x.similarity")
