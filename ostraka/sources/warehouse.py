"""A folder of Parquet tables as the store of a corpus, and the commands on it.

Every write makes a new version of a table, or of a part of it, in a folder of its own; one small file
says which versions are current, and is replaced by a rename. So a reader sees the old tables or the
new ones, several tables change together, and a failed write leaves the old ones. The vectors of each
model are a part of their table: a model is replaced or deleted without touching the others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.functions.languages import edition_language
from ostraka.functions.text import CHUNK_WORDS, lexemes
from ostraka.operators import embeddings, evaluate, lemmas, metadata, search
from ostraka.session import cut
from ostraka.sources import corpus, dumps
from ostraka.sources.tables import table

CURRENT, OLD = "current.json", "-replaced"
KINDS = {"transcription": "transcription_embeddings", "translation": "translation_embeddings"}
DOCUMENTS = T.StructType([T.StructField(n, t) for n, t in (
    ("transcription_id", T.LongType()), ("source_path", T.StringType()), ("tm_id", T.LongType()), ("xml_content", T.StringType()), ("type", T.StringType()), ("language", T.StringType()),
    ("text", T.StringType()), ("text_vector", T.StringType()), ("lemma_text", T.StringType()), ("lemma_vector", T.StringType()),
)])
VECTORS = T.StructType([T.StructField(n, t) for n, t in (
    ("xml_id", T.LongType()), ("model_name", T.StringType()), ("chunk_index", T.IntegerType()), ("source_path", T.StringType()), ("tm_id", T.StringType()), ("language", T.StringType()),
    ("document_text", T.StringType()), ("input_hash", T.StringType()), ("embedding", T.ArrayType(T.FloatType())), ("updated_at", T.TimestampType()),
)])


@F.arrow_udf(T.StringType())
def _term_vector(values: pa.Array) -> pa.Array:
    out: list[str | None] = []
    for words in values.to_pylist():
        places: dict[str, list[str]] = {}
        for i, w in enumerate(words or (), 1):
            places.setdefault(w, []).append(str(i))
        out.append(None if words is None else " ".join(f"'{w}':{','.join(places[w])}" for w in sorted(places)))
    return pa.array(out, pa.string())


def term_vector(text: Column) -> Column:
    """A text's lexemes in order with their places: 'a':1,3 'b':2. Null for null."""
    return _term_vector(lexemes(text))


@dataclass(frozen=True)
class Warehouse:
    """The tables under ``root``."""

    spark: SparkSession
    root: str
    #: Chunks that the last embedding left without a vector of their own, by kind of document.
    skipped: dict[str, DataFrame] = field(default_factory=dict, compare=False)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _current(self) -> dict[str, dict[str, str]]:
        """Table to part to folder; a folder of Parquet tables that was written otherwise has none."""
        files, where = self._files(), self._path(CURRENT)
        if not files.exists(where):
            return {}
        stream = files.open(where)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _swap(self, changes: dict[tuple[str, str], str | None]) -> None:
        """Makes new versions current, all at once; a part whose folder is None goes. Versions before the last are removed."""
        files, before = self._files(), self._current()
        after = {n: dict(parts) for n, parts in before.items() if n != OLD}
        for (name, part), folder in changes.items():
            after.setdefault(name, {}).pop(part, None)
            if folder is not None:
                after[name][part] = folder
        dead = [before[n][p] for n, p in changes if p in before.get(n, {})]
        staged, where = self._path(f"{CURRENT}.{uuid.uuid4().hex}"), self._path(CURRENT)
        stream = files.create(staged, True)
        stream.write(json.dumps(after | {OLD: {str(i): f for i, f in enumerate(dead)}}).encode())
        stream.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri() if where.toUri().getScheme() else files.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(files.makeQualified(staged), files.makeQualified(where), options)
        for folder in before.get(OLD, {}).values():  # a reader of the version just replaced may still be at work
            files.delete(self._path(folder), True)

    def exists(self, name: str) -> bool:
        return bool(self._current().get(name)) or self._files().exists(self._path(f"{name}.parquet"))

    def parts(self, name: str) -> list[str]:
        return sorted(self._current().get(name, {}))

    def read(self, name: str, schema: T.StructType | None = None, part: str | None = None) -> DataFrame:
        """The table, or a part of it; where it doesn't exist and a schema is given, an empty one.

        With a schema, columns that older versions lack are null.
        """
        found = self._current().get(name)
        if found is not None and (part is None or part in found):
            folders = [self._path(f).toString() for p, f in sorted(found.items()) if part is None or p == part]
            if folders:
                reader = self.spark.read if schema is None else self.spark.read.schema(schema)
                return reader.parquet(*folders)
        elif found is None and part is None and (schema is None or self.exists(name)):
            return table(self.spark, self.root, name)
        if schema is None:
            raise FileNotFoundError(f"{self.root} has no table {name!r}")
        return self.spark.createDataFrame([], schema)

    def write(self, name: str, df: DataFrame, order: Sequence[str] = (), part: str = "") -> None:
        """A new version of a table, or of one part of it."""
        self.write_together({name: df}, order, part)

    def write_together(self, tables: dict[str, DataFrame], order: Sequence[str] = (), part: str = "") -> None:
        """New versions of several tables, which become current together or not at all."""
        folders = {}
        for name, df in tables.items():
            folder = f"versions/{name}-{uuid.uuid4().hex}"
            (df.sortWithinPartitions(*order) if order else df).write.parquet(self._path(folder).toString())
            folders[name, part] = folder
        self._swap(folders)

    def next_id(self, name: str, key: str) -> int:
        """The number after the greatest one in use, from which later rows go on."""
        return (self.read(name).agg(F.max(key).alias("n")).first()["n"] or 0) + 1 if self.exists(name) else 1

    # metadata

    def ingest_metadata(self, source: str) -> None:
        """The six tables anew, from one parse of each record; a bad record leaves all tables as they were."""
        found = corpus.records(self.spark, source).select("source_rank", F.col("metadata_path").alias("source_path"))
        files = corpus.xml_files(self.spark, source, corpus.HGV, True).unionByName(corpus.xml_files(self.spark, source, corpus.DCLP, True))
        parsed = metadata.extracted(files)
        ranked = cut(parsed.join(found, "source_path").withColumn("parts", F.split("source_path", "/")))
        self.write_together({name: metadata.metadata_table(ranked, name, ("source_rank", "parts")) for name in metadata.TABLES})

    def dump_metadata(self, target: str) -> None:
        for name, spec in metadata.TABLES.items():
            dumps.dump_csv(self.read(name), f"{target}/{name}", spec.names, [spec.key or "source_path"])

    # documents

    def ingest_documents(self, source: str) -> None:
        found = corpus.records(self.spark, source)
        files = corpus.xml_files(self.spark, source, "", recursive=True)
        rows = corpus.document_table(found, files).withColumn("parts", F.split("source_path", "/"))
        numbered = metadata.numbered(rows, "transcription_id", ["type", "parts", "xml_content"]).withColumn("transcription_id", F.col("transcription_id").cast("bigint"))
        self.write("transcriptions", numbered.withColumn("lemma_text", F.lit(None).cast("string")).select(*[c for c in DOCUMENTS.fieldNames() if not c.endswith("_vector")]))

    def dump_documents(self, target: str) -> None:
        rows = self.read("transcriptions").withColumn("text_vector", term_vector(F.col("text"))).withColumn("lemma_vector", term_vector(F.col("lemma_text")))
        dumps.dump_csv(rows, target, DOCUMENTS.fieldNames(), ["transcription_id"])

    def import_documents(self, source: str) -> None:
        """A dump back in place of the table; the vectors of terms are made anew when they are needed."""
        self.write("transcriptions", dumps.read_csv(self.spark, source, DOCUMENTS).drop("text_vector", "lemma_vector"))

    def append_documents(self, documents: DataFrame, order: Sequence[str]) -> None:
        """Further documents, in the columns of the table without its key, numbered on from the greatest id."""
        start = self.next_id("transcriptions", "transcription_id") - 1
        new = metadata.numbered(documents, "transcription_id", list(order)).withColumn("transcription_id", F.col("transcription_id").cast("bigint") + start)
        old = self.read("transcriptions")
        self.write("transcriptions", old.unionByName(new, allowMissingColumns=True).select(*old.columns))

    def lemmatize(self, factory: lemmas.Factory = lemmas.lower_case_pipeline, max_words: int = 50) -> None:
        d = self.read("transcriptions")
        tag = F.when(F.col("type") == "translation", F.col("language")).otherwise(edition_language(F.col("xml_content")))
        self.write("transcriptions", lemmas.lemmatized(d, tag, factory, max_words))

    def search(self, query_text: str, limit: int, use_lemmas: bool = False, metadata_filter: search.MetadataFilter | None = None) -> DataFrame:
        parts = {n: self.read(n) for n in metadata.TABLES if self.exists(n)}
        return search.bm25_search(self.read("transcriptions"), query_text=query_text, limit=limit, use_lemmas=use_lemmas, metadata_filter=metadata_filter, metadata=parts)

    # vectors

    def embed(self, model: str, embed: embeddings.Embed, stale_only: bool = False, sample: int | None = None, seed: int = 0, chunk_size: int = CHUNK_WORDS) -> int:
        """Vectors of all documents, or of a sample of paired records; rows of the model outside go. The number embedded."""
        documents, done = self.read("transcriptions"), 0
        if sample is not None:
            documents = documents.join(embeddings.sampled_records(documents, sample, seed), "tm_id", "left_semi")
        for kind, name in KINDS.items():
            tag = edition_language(F.col("xml_content")) if kind == "transcription" else F.col("language")
            chunks = cut(embeddings.document_chunks(documents.filter(F.col("type") == kind), model, tag, chunk_size))
            stored = cut(self.read(name, VECTORS, model))
            after, work = embeddings.refreshed(stored, chunks, model, embed, stale_only)
            after = cut(after)
            bad = after.agg(F.count_distinct(F.size("embedding")).alias("n")).first()["n"]
            if bad > 1:
                raise ValueError(f"vectors of {model!r} have several dimensions")
            fresh = after.join(stored, [*embeddings.KEY, "input_hash", "updated_at"], "left_anti").count()
            done += fresh
            self.skipped[kind] = cut(chunks.join(after.select(*embeddings.KEY, "input_hash"), [*embeddings.KEY, "input_hash"], "left_anti").select(*embeddings.KEY))
            self.write(name, after, embeddings.KEY, model)
        return done

    def delete_model(self, model: str) -> int:
        """Rows that go with the model; the other models' files aren't touched."""
        held = {name: self.read(name, VECTORS, model).count() for name in KINDS.values() if model in self.parts(name)}
        self._swap({(name, model): None for name in held})
        return sum(held.values())

    def dump_model(self, target: str, model: str, kind: str = "transcription") -> int:
        return dumps.dump_embeddings(self.read(KINDS[kind], VECTORS, model), target, model)

    def import_model(self, source: str, model: str, kind: str = "transcription") -> int:
        after = cut(dumps.import_embeddings(self.spark, source, self.spark.createDataFrame([], VECTORS), model))
        self.write(KINDS[kind], after, embeddings.KEY, model)
        return after.count()

    def vector_of(self, model: str, path: str, kind: str = "transcription") -> list[float] | None:
        row = embeddings.first_embedding(self.read(KINDS[kind], VECTORS, model), model, path).first()
        return None if row is None else list(row["embedding"])

    def evaluate(self, model: str | None = None, sample: int | None = None, seed: int = 0) -> evaluate.Evaluation:
        sides = [self.read(n, VECTORS) for n in KINDS.values()]
        if model is not None:
            sides = [s.filter(F.col("model_name") == model) for s in sides]
        if sample is not None:
            chosen = embeddings.sampled_records(self.read("transcriptions"), sample, seed).select(F.col("tm_id").cast("string").alias("tm_id"))
            sides = [s.join(chosen, "tm_id", "left_semi") for s in sides]
        return evaluate.evaluate(*sides, None if sample is None else f"A sample of {sample} paired records, seed {seed}.")
