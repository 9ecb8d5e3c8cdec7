"""Retrieval of translations by the vectors of transcriptions, and its measures.

Documents are compared by their nearest pair of chunks. The vectors of each model are dealt to blocks
of bounded size, every pair of a query block and a candidate block is one task, and its products are
matrix multiplications; only counts and the nearest few of each query leave the task. Documents of very
many chunks are dealt in parts; the distances of their parts are put together before they are ranked.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ostraka.functions.text import language_label
from ostraka.session import cut

BLOCK_ROWS = 32_768
TILE_ROWS = 128
#: Chunks of queries that are worth a task of their own.
LEAST_ROWS = 256
#: Chunks of a document that stay together.
SPLIT_ROWS = 4_096
DECIMALS = 10
RANKS = (1, 2, 3, 4, 5)


def chunk_group(chunks):
    return F.when(chunks == 1, "1 chunk").when(chunks <= 3, "2-3 chunks").otherwise("4+ chunks")


def query_documents(transcriptions: DataFrame, translations: DataFrame) -> DataFrame:
    """(model_name, tm_id, source_path, language, chunks) of transcriptions that have a translation in that model."""
    pairs = translations.select("model_name", "tm_id").distinct()
    grouped = transcriptions.groupBy("model_name", "tm_id").agg(F.min("source_path").alias("source_path"), F.min("language").alias("language"), F.count(F.lit(1)).alias("chunks"))
    return grouped.join(pairs, ["model_name", "tm_id"], "left_semi")


def _unit(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _distances(queries: np.ndarray, candidates: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least distance of one query document to every candidate document, a tile of query chunks at a time."""
    out = None
    for begin in range(0, len(queries), TILE_ROWS):
        tile = np.fmin.reduceat(np.fmin.reduce(1 - queries[begin : begin + TILE_ROWS] @ candidates.T, axis=0), starts)
        out = tile if out is None else np.fmin(out, tile)
    # equal vectors are at equal distance, whatever the order in which a product was summed
    return np.round(out, DECIMALS)


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(lists):
        return np.zeros((0, 1))
    lengths = lists.value_lengths()
    if pc.min(lengths).as_py() != pc.max(lengths).as_py():
        raise ValueError("vectors of one model have several dimensions")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _tiles(starts: np.ndarray, n: int):
    """Runs of documents (first, after the last) that have about TILE_ROWS chunks together, one at least."""
    first, ends = 0, np.r_[starts[1:], n]
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + TILE_ROWS, side="right")))
        yield first, last
        first = last


def _by_document(table: pa.Table, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Table]:
    """Ids and first rows of the documents (or their parts) of one side, all vectors, and the first rows' columns."""
    part = table.filter(pc.equal(table["side"], side)).sort_by([("tm_id", "ascending"), ("part", "ascending")])
    ids, parts = np.asarray(part["tm_id"].to_pylist(), dtype=object), part["part"].to_numpy()
    starts = np.nonzero(np.r_[True, (ids[1:] != ids[:-1]) | (parts[1:] != parts[:-1])])[0] if len(ids) else np.zeros(0, dtype=np.int64)
    return ids[starts], starts, _unit(_vectors(part["embedding"])), part.take(pa.array(starts))


def _dealt(rows: DataFrame, documents: DataFrame, split_rows: int) -> DataFrame:
    """Chunks with the part of the document that they belong to; ``documents`` has its number of chunks."""
    marked = rows.filter(F.col("embedding").isNotNull()).select("model_name", "tm_id", "embedding", F.xxhash64(*rows.columns).alias("__hash"))
    parts = documents.withColumn("parts", F.ceil(F.col("chunks") / split_rows).cast("int")).drop("chunks")
    return marked.join(parts, ["model_name", "tm_id"]).withColumn("part", F.pmod(F.col("__hash"), F.col("parts")).cast("int")).drop("__hash")


def _numbers(rows: DataFrame, block_rows: int, least: int = 1) -> dict[str, int]:
    """Blocks of every model, ``least`` of them where they have LEAST_ROWS; one row for each model comes to the driver."""
    return {r["model_name"]: max(1, -(-r["count"] // block_rows), min(least, r["count"] // LEAST_ROWS)) for r in rows.groupBy("model_name").count().collect()}


def _of_model(numbers: dict[str, int]):
    return F.create_map(*[x for m, n in numbers.items() for x in (F.lit(m), F.lit(n))])[F.col("model_name")] if numbers else F.lit(1)


def target_ranks(transcriptions: DataFrame, translations: DataFrame, block_rows: int = BLOCK_ROWS, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Every query document with the rank of its own translation among all of its model, and its five nearest.

    Order: distance, record (as text), path. First each query's distance to its own translation is
    found, then how many candidates come before that; only counts and five candidates for each query
    and block leave a task, never all pairs, but for those of documents that are dealt in parts. A
    vector of length zero is at distance NaN, which is last; rows without a vector don't count.
    """
    key = ["model_name", "tm_id"]
    queries = query_documents(transcriptions, translations)
    candidates = translations.groupBy(*key).agg(F.min("source_path").alias("path"), F.count(F.lit(1)).alias("chunks"))
    # written once: each is read four times
    asked = cut(_dealt(transcriptions, queries.select(*key, "chunks", F.lit("").alias("path")), split_rows))
    given = cut(_dealt(translations, candidates, split_rows))
    n_q, n_c = _numbers(asked, block_rows, transcriptions.sparkSession.sparkContext.defaultParallelism), _numbers(given, block_rows)

    # distances to the own translation: a query and its translation hash alike, each part meets each part
    parts_of = lambda rows, name: rows.select(*key, F.col("parts").alias(name)).distinct()
    bucket = F.pmod(F.xxhash64("tm_id"), 8 * (F.coalesce(_of_model(n_q), F.lit(1)) + F.coalesce(_of_model(n_c), F.lit(1)))).cast("int").alias("bucket")
    columns = (*key, "embedding", "part", bucket)
    mine = asked.join(parts_of(given, "others"), key).select(F.lit("q").alias("side"), *columns, F.col("part").alias("q"), F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("c"))
    other = given.join(parts_of(asked, "others"), key).select(F.lit("c").alias("side"), *columns, F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("q"), F.col("part").alias("c"))

    def own(table: pa.Table) -> pa.Table:
        q_ids, q_at, q, _ = _by_document(table, "q")
        c_ids, c_at, c, _ = _by_document(table, "c")
        place = {t: i for i, t in enumerate(c_ids)}
        q_ends, c_ends = np.r_[q_at[1:], len(q)], np.r_[c_at[1:], len(c)]
        rows = []
        for n, tm in enumerate(q_ids):
            if tm in place:
                i = place[tm]
                rows.append((tm, float(_distances(q[q_at[n] : q_ends[n]], c[c_at[i] : c_ends[i]], np.zeros(1, dtype=np.int64))[0])))
        return pa.table([pa.array([table["model_name"][0].as_py()] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())], names=["model_name", "tm_id", "target"])

    found = mine.unionByName(other).groupBy("model_name", "bucket", "q", "c").applyInArrow(own, "model_name string, tm_id string, target double")
    targets = cut(found.groupBy(*key).agg(F.min("target").alias("target")))

    # every block of queries meets every block of candidates of its model
    columns = (*key, "path", "embedding", "part", "parts", "target")
    q_side = asked.join(targets, key, "left").select(F.lit("q").alias("side"), *columns, F.pmod(F.xxhash64("tm_id", "part"), _of_model(n_q)).cast("int").alias("q"), F.explode(F.sequence(F.lit(0), F.coalesce(_of_model(n_c), F.lit(1)) - 1)).alias("c"))
    c_side = given.withColumn("target", F.lit(None).cast("double")).select(F.lit("c").alias("side"), *columns, F.explode(F.sequence(F.lit(0), F.coalesce(_of_model(n_q), F.lit(1)) - 1)).alias("q"), F.pmod(F.xxhash64("tm_id", "part"), _of_model(n_c)).cast("int").alias("c"))
    near_schema = "model_name string, tm_id string, ahead bigint, near array<struct<distance:double,tm_id:string,path:string>>, other string, path string, distance double"

    def near(table: pa.Table) -> pa.Table:
        q_ids, q_at, q, q_rows = _by_document(table, "q")
        c_ids, c_at, c, c_rows = _by_document(table, "c")
        names, whole = c_rows["path"].to_pylist(), c_rows["parts"].to_numpy() == 1
        places = np.nonzero(whole)[0]
        q_ends, q_whole, goals = np.r_[q_at[1:], len(q)], q_rows["parts"].to_numpy() == 1, q_rows["target"].to_pylist()
        counts: list[tuple] = []
        pairs: list[tuple] = []
        for first, last in _tiles(q_at, len(q)) if len(c_ids) else ():
            begin, end = q_at[first], q_ends[last - 1]
            if last - first == 1:
                tile = _distances(q[begin:end], c, c_at)[None, :]
            else:
                tile = np.round(np.fmin.reduceat(np.fmin.reduceat(1 - q[begin:end] @ c.T, c_at, axis=1), q_at[first:last] - begin, axis=0), DECIMALS)
            # a target at NaN is met as no target: candidates before it are counted as those that aren't NaN
            goal = np.array([np.inf if g is None or np.isnan(g) else g for g in goals[first:last]])
            sort = np.where(np.isnan(tile[:, places]), np.inf, tile[:, places])
            # ids are in order, so those before a query's own are the first so many
            earlier = np.searchsorted(c_ids[places], q_ids[first:last])
            ahead = (sort < goal[:, None]).sum(axis=1)
            few = min(len(RANKS), sort.shape[1])
            bound = np.partition(sort, few - 1, axis=1)[:, few - 1] if few else goal
            for n in range(first, last):
                d, tm = tile[n - first], q_ids[n]
                apart = np.nonzero(~whole)[0] if q_whole[n] else np.arange(len(d))
                pairs += [(tm, c_ids[i], names[i], float(d[i])) for i in apart]
                if q_whole[n]:
                    own = sort[n - first]
                    near_by = np.nonzero(own <= bound[n - first])[0] if few else np.zeros(0, dtype=np.int64)
                    best = places[near_by[np.argsort(own[near_by], kind="stable")[:few]]]
                    equal = int((own[: earlier[n - first]] == goal[n - first]).sum())
                    counts.append((tm, int(ahead[n - first]) + equal, [{"distance": float(d[i]), "tm_id": c_ids[i], "path": names[i]} for i in best]))
        a, b, model = len(counts), len(pairs), table["model_name"][0].as_py()
        near_type = pa.list_(pa.struct([("distance", pa.float64()), ("tm_id", pa.string()), ("path", pa.string())]))
        columns = [
            pa.array([model] * (a + b), pa.string()), pa.array([r[0] for r in counts] + [r[0] for r in pairs], pa.string()), pa.array([r[1] for r in counts] + [None] * b, pa.int64()),
            pa.array([r[2] for r in counts] + [None] * b, near_type), *[pa.array([None] * a + [r[i] for r in pairs], t) for i, t in ((1, pa.string()), (2, pa.string()), (3, pa.float64()))],
        ]
        return pa.table(columns, names=["model_name", "tm_id", "ahead", "near", "other", "path", "distance"])

    met = cut(q_side.unionByName(c_side).groupBy("model_name", "q", "c").applyInArrow(near, near_schema))
    whole = met.filter("near is not null").select(*key, "ahead", "near")
    pairs = met.filter("other is not null").groupBy(*key, "other").agg(F.min("distance").alias("distance"), F.min("path").alias("path")).join(targets, key, "left")
    last = F.lit(float("inf"))
    at, goal = F.when(F.isnan("distance"), last).otherwise(F.col("distance")), F.when(F.col("target").isNull() | F.isnan("target"), last).otherwise(F.col("target"))
    before = ((at < goal) | (at == goal) & (F.col("other") < F.col("tm_id"))).cast("bigint")
    counted = pairs.groupBy(*key).agg(F.sum(before).alias("ahead"), F.array().cast("array<struct<distance:double,tm_id:string,path:string>>").alias("near"))
    first = pairs.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy("distance", "other"))).filter(F.col("place") <= len(RANKS))
    best = first.select(*key, F.lit(0).cast("bigint").alias("ahead"), F.array(F.struct("distance", F.col("other").alias("tm_id"), "path")).alias("near"))
    every = whole.unionByName(counted).unionByName(best)
    merged = every.groupBy(*key).agg((F.sum("ahead") + 1).cast("int").alias("rank"), F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, len(RANKS)).alias("nearest"))
    out = queries.join(merged, key, "left")
    return out.withColumn("language_label", language_label(F.col("language"))).withColumn("chunk_group", chunk_group(F.col("chunks")))


def retrieval_measures(ranks: DataFrame) -> DataFrame:
    """recall at 1 to 5 and mean reciprocal rank: in total, by language and by group of chunks."""
    hits = [F.count_if(F.col("rank") <= k).alias(f"hits_{k}") for k in RANKS]
    sums = ranks.groupingSets([["model_name"], ["model_name", "language_label"], ["model_name", "chunk_group"]], "model_name", "language_label", "chunk_group").agg(
        F.grouping("language_label").alias("no_language"), F.grouping("chunk_group").alias("no_group"), F.count(F.lit(1)).alias("queries"), *hits, F.sum(F.coalesce(1.0 / F.col("rank"), F.lit(0.0))).alias("reciprocal_sum")
    )
    kind = F.when(F.col("no_language") == 0, "language").when(F.col("no_group") == 0, "chunks").otherwise("total")
    value = F.coalesce("language_label", "chunk_group", F.lit("all"))
    recalls = [F.coalesce(F.try_divide(F.col(f"hits_{k}").cast("double"), F.col("queries")), F.lit(0.0)).alias(f"recall_{k}") for k in RANKS]
    return sums.select("model_name", kind.alias("slice_kind"), value.alias("slice_value"), "queries", *recalls, F.coalesce(F.try_divide("reciprocal_sum", "queries"), F.lit(0.0)).alias("mrr"))


def collection_statistics(vectors: DataFrame) -> DataFrame:
    """Documents, chunks, documents of several chunks, least and greatest dimension of every model."""
    each = vectors.groupBy("model_name", "tm_id").agg(F.count(F.lit(1)).alias("chunks"), F.min(F.size("embedding")).alias("low"), F.max(F.size("embedding")).alias("high"))
    return each.groupBy("model_name").agg(F.count(F.lit(1)).alias("documents"), F.sum("chunks").alias("chunks"), F.count_if(F.col("chunks") > 1).alias("chunked_documents"), F.min("low").alias("min_dims"), F.max("high").alias("max_dims"))


@dataclass(frozen=True)
class Evaluation:
    """The measures of one or more models, as rows, and their report.

    ``sides`` has, for each model, the statistics of its transcriptions and of its translations;
    ``scope`` says which sample was evaluated, where it was one.
    """

    rows: list
    sides: dict = field(default_factory=dict)
    scope: str | None = None

    def _summary(self) -> list[str]:
        lines = [
            "| Model | Dimensions | Transcriptions | Translations | Paired | Transcription chunks | Translation chunks | Multi-chunk transcriptions | Multi-chunk translations | " + " | ".join(f"recall@{k}" for k in RANKS) + " |",
            "|---|" + "---:|" * (8 + len(RANKS)),
        ]
        totals = {r["model_name"]: r for r in self.rows if r["slice_kind"] == "total"}
        for model in sorted(totals):
            a, b = self.sides[model]
            counts = (a["min_dims"], a["documents"], b["documents"], totals[model]["queries"], a["chunks"], b["chunks"], a["chunked_documents"], b["chunked_documents"])
            shares = " | ".join(f"{100 * totals[model][f'recall_{k}']:.2f}%" for k in RANKS)
            lines.append(f"| {model.replace('|', chr(92) + '|')} | " + " | ".join(map(str, counts)) + f" | {shares} |")
        return [*lines, ""]

    def to_markdown(self) -> str:
        lines = [self.scope, ""] if self.scope else []
        lines += self._summary() if self.sides else []
        lines += ["| Model | Slice | Queries | " + " | ".join(f"recall@{k}" for k in RANKS) + " | MRR |", "|---|---|---:|" + "---:|" * (len(RANKS) + 1)]
        for r in sorted(self.rows, key=lambda r: (r["model_name"], {"total": 0, "language": 1, "chunks": 2}[r["slice_kind"]], r["slice_value"])):
            shares = " | ".join(f"{100 * r[f'recall_{k}']:.2f}%" for k in RANKS)
            name = r["model_name"].replace("|", "\\|")
            lines.append(f"| {name} | {r['slice_value']} | {r['queries']} | {shares} | {100 * r['mrr']:.2f}% |")
        return "\n".join(lines) + "\n"


def evaluate(transcriptions: DataFrame, translations: DataFrame, scope: str | None = None) -> Evaluation:
    """Measures of every model that has both kinds of vectors; the report's rows come to the driver."""
    sides: list[dict] = []
    for name, side in (("transcription", transcriptions), ("translation", translations)):
        found = collection_statistics(side).collect()
        sides.append({r["model_name"]: r for r in found})
        if not found:
            raise ValueError(f"there are no {name} vectors")
        if any(r["min_dims"] != r["max_dims"] for r in found):
            raise ValueError(f"{name} vectors of one model have several dimensions")
    rows = retrieval_measures(target_ranks(transcriptions, translations)).collect()
    if not rows:
        raise ValueError("no record has both kinds of vectors")
    return Evaluation(rows, {m: (a, sides[1][m]) for m, a in sides[0].items() if m in sides[1]}, scope)
