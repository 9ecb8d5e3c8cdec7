"""Profiles of a corpus: paths and values, dates, places against a gazetteer, bibliography references."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.functions import dates
from ostraka.functions.text import normalize_lookup, split_variants, words
from ostraka.operators.render import local, parse

MANY_VALUES = 10_000


def element_inventory(records: DataFrame, key: str, xml: str) -> DataFrame:
    """(key, kind, path, name, value, times): elements by path, attributes with values, errors.

    A record that isn't well-formed gives one row of kind ``error``. Counts are made inside each
    record, so that only its different paths and values are shuffled.
    """
    fields = (("kind", T.StringType(), pa.string()), ("path", T.StringType(), pa.string()), ("name", T.StringType(), pa.string()), ("value", T.StringType(), pa.string()), ("times", T.LongType(), pa.int64()))
    schema = T.StructType([records.schema[key], *[T.StructField(n, t) for n, t, _ in fields]])

    def profile(text: str) -> dict[tuple, int]:
        counts: dict[tuple, int] = {}
        stack = [(parse(text), "")]
        while stack:
            node, above = stack.pop()
            path = f"{above}/{local(node)}"
            item = ("element", path, local(node), None)
            counts[item] = counts.get(item, 0) + 1
            for name, value in node.attrib.items():
                item = ("attribute", path, name.rpartition("}")[2], value)
                counts[item] = counts.get(item, 0) + 1
            if node.attrib:
                item = ("attribute_set", path, ", ".join(sorted(n.rpartition("}")[2] for n in node.attrib)), None)
                counts[item] = counts.get(item, 0) + 1
            stack += [(c, path) for c in node if isinstance(c.tag, str)]
        return counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 128):
                part = batch.slice(begin, 128)
                at, rows = [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    if text is None:
                        continue
                    try:
                        found = profile(text)
                    except Exception as error:  # noqa: BLE001 - the parser raises several kinds
                        found = {("error", "", type(error).__name__, None): 1}
                    at += [i] * len(found)
                    rows += [(*k, n) for k, n in found.items()]
                if rows:
                    columns = [part.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, (_, _, t) in zip(zip(*rows), fields)]]
                    yield pa.RecordBatch.from_arrays(columns, names=[key, *[f[0] for f in fields]])

    return records.select(key, F.col(xml)).mapInArrow(run, schema)


# The fields of a metadata record that a database would hold, and where they stand.
FIELDS = (
    ("Document title", "/TEI/teiHeader/fileDesc/titleStmt/title"), ("Publication identifier", "/TEI/teiHeader/fileDesc/publicationStmt/idno"), ("Holding institution", "/TEI/teiHeader/fileDesc/sourceDesc/msDesc/msIdentifier/institution"),
    ("Collection", "/TEI/teiHeader/fileDesc/sourceDesc/msDesc/msIdentifier/collection"), ("Current settlement", "/TEI/teiHeader/fileDesc/sourceDesc/msDesc/msIdentifier/placeName/settlement"),
    ("Inventory identifier", "/TEI/teiHeader/fileDesc/sourceDesc/msDesc/msIdentifier/idno"), ("Material", "/TEI/teiHeader/fileDesc/sourceDesc/msDesc/physDesc/objectDesc/supportDesc/support/material"),
    ("Origin place", "/TEI/teiHeader/fileDesc/sourceDesc/msDesc/history/origin/origPlace"), ("Origin date", "/TEI/teiHeader/fileDesc/sourceDesc/msDesc/history/origin/origDate"), ("Provenance event", "/TEI/teiHeader/fileDesc/sourceDesc/msDesc/history/provenance"),
    ("Provenance place", "/TEI/teiHeader/fileDesc/sourceDesc/msDesc/history/provenance/p/placeName"), ("Keyword", "/TEI/teiHeader/profileDesc/textClass/keywords/term"), ("Revision event", "/TEI/teiHeader/revisionDesc/change"),
    ("Typed body division", "/TEI/text/body/div"), ("Division paragraph", "/TEI/text/body/div/p"), ("Structured bibliography entry", "/TEI/text/body/div/listBibl/bibl"), ("Inline illustration reference", "/TEI/text/body/div/p/bibl"),
    ("Image link", "/TEI/text/body/div/p/figure/graphic"), ("Mentioned date", "/TEI/text/body/div/list/item/date"),
)


def field_coverage(items: DataFrame, document: str, records: DataFrame, fields: Sequence[tuple[str, str]] = FIELDS) -> DataFrame:
    """Every field with its path: records that have it, their share of all, occurrences, and occurrences a record that has it."""
    whole = records.agg(F.count(F.lit(1)).alias("records"))
    named = items.sparkSession.createDataFrame(list(fields), "field string, path string")
    found = frequency(items.filter("kind = 'element'").join(named.select("path"), "path", "left_semi"), document, ["path"], F.col("times"))
    joined = named.join(found, "path", "left").fillna(0, ["documents", "occurrences"])
    total = F.lit(whole.first()["records"])
    return joined.select("field", "path", "documents", percentage(F.col("documents"), total).alias("coverage"), "occurrences", F.round(F.try_divide(F.col("occurrences").cast("double"), F.col("documents")), 2).alias("per_record"))


def leaf_values(nodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Texts of elements that hold no others, of an adjacency table, by label: how often, and in how many records."""
    elements = nodes.filter("kind = 'element'")
    inner = elements.select(*keys, F.col("parent_no").alias("node_no")).distinct()
    leaves = elements.filter("scalar is not null").join(inner, [*keys, "node_no"], "left_anti")
    return leaves.groupBy("label", F.col("scalar").alias("value")).agg(F.count(F.lit(1)).alias("times"), F.count_distinct(*keys).alias("records"))


def frequency(items: DataFrame, document: str, key: Sequence[str], times: Column | None = None) -> DataFrame:
    """Documents and occurrences of every key, with the least and most occurrences in a document that has it."""
    n = F.count(F.lit(1)) if times is None else F.sum(times)
    each = items.groupBy(document, *key).agg(n.alias("__n"))
    return each.groupBy(*key).agg(F.count(F.lit(1)).alias("documents"), F.sum("__n").alias("occurrences"), F.min("__n").alias("min_per_document"), F.max("__n").alias("max_per_document"))


def value_distribution(items: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Occurrences of every value of every key, and whether the key has more than 10,000 different ones."""
    counted = items.groupBy(*key, value).agg(F.count(F.lit(1)).alias("occurrences"))
    many = counted.groupBy(*key).agg((F.count(F.lit(1)) > MANY_VALUES).alias("many_values"))
    return counted.join(many, list(key))


def top_values(distribution: DataFrame, key: Sequence[str], value: str, count: str, limit: int) -> DataFrame:
    """The most frequent values of every key, ties by value; ``place`` from 1."""
    order = Window.partitionBy(*key).orderBy(F.desc(count), value)
    return distribution.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)


def cardinality_histogram(documents: DataFrame, items: DataFrame, document: str) -> DataFrame:
    """How many documents have so many items, those without any included."""
    counts = items.groupBy(document).agg(F.count(F.lit(1)).alias("items"))
    joined = documents.select(document).join(counts, document, "left")
    return joined.groupBy(F.coalesce("items", F.lit(0)).alias("items")).agg(F.count(F.lit(1)).alias("documents"))


def percentage(part: Column, whole: Column) -> Column:
    """Two decimals; 0 of an empty whole."""
    return F.coalesce(F.round(F.try_divide(100.0 * part, whole.cast("double")), 2), F.lit(0.0))


def coverage(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """field, present, total and percentage of the given columns, in one pass over the rows."""
    sums = rows.agg(F.count(F.lit(1)).alias("total"), *[F.count(F.nullif(F.col(c).cast("string"), F.lit(""))).alias(f"n_{c}") for c in columns])
    fields = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"n_{c}").alias("present")) for c in columns]))
    out = sums.select("total", fields.alias("f")).select("f.field", "f.present", "total")
    return out.withColumn("percentage", percentage(F.col("present"), F.col("total")))


def date_windows(rows: DataFrame, record: str, start: str, end: str, first: int, last: int) -> DataFrame:
    """Records of which any, and of which all, intervals overlap or lie in the window."""
    s, e = F.col(start), F.col(end)
    each = rows.groupBy(record).agg(
        F.bool_or(dates.overlaps(s, e, first, last)).alias("any_overlaps"), F.bool_and(dates.overlaps(s, e, first, last)).alias("all_overlap"),
        F.bool_or(dates.contained(s, e, first, last)).alias("any_contained"), F.bool_and(dates.contained(s, e, first, last)).alias("all_contained"),
    )
    return each.agg(*[F.count_if(F.col(c)).alias(c) for c in each.columns[1:]])


def gazetteer_names(gazetteer: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, id): every name of every entry in lookup form, each once."""
    every = F.explode(F.flatten(F.array(*[split_variants(F.coalesce(c, F.lit(""))) for c in columns])))
    return gazetteer.select(F.col("id"), every.alias("raw")).select(normalize_lookup(F.col("raw")).alias("name"), "id").filter("name <> ''").distinct()


def label_matches(labels: DataFrame, label: str, names: DataFrame) -> DataFrame:
    """Every different label with the number of entries of that name: none, single or ambiguous."""
    different = labels.select(F.col(label).alias("label")).filter(F.col("label").isNotNull()).distinct().withColumn("name", normalize_lookup(F.col("label")))
    counted = names.groupBy("name").agg(F.count_distinct("id").alias("entries"), F.min("id").alias("first_id"))
    joined = different.join(counted, "name", "left")
    entries = F.coalesce("entries", F.lit(0))
    return joined.select("label", entries.alias("entries"), F.when(entries == 0, "none").when(entries == 1, "single").otherwise("ambiguous").alias("status"), F.when(entries == 1, F.col("first_id")).alias("geo_id"))


def place_coverage(mentions: DataFrame, gazetteer: DataFrame, scope: str, reference: str) -> DataFrame:
    """Mentions of every scope: with a reference, with one that resolves, with coordinates, with dates."""
    known = gazetteer.select(F.col("id").alias("__id"), (F.coalesce("coordinates", F.lit("")) != "").alias("__xy"), (F.col("begin_date").isNotNull() | F.col("end_date").isNotNull()).alias("__dated"))
    joined = mentions.join(known, F.col(reference) == F.col("__id"), "left")
    return joined.groupBy(scope).agg(
        F.count(F.lit(1)).alias("mentions"), F.count(reference).alias("with_reference"), F.count("__id").alias("resolved"), F.count_if(F.col("__xy")).alias("with_coordinates"),
        F.count_if(F.col("__dated")).alias("with_dates"), F.count_distinct("__id").alias("entries"),
    )


def reference_resolution(references: DataFrame, reference: str, known: DataFrame, identifier: str) -> DataFrame:
    """Occurrences and different ids of references, and of those that resolve and that don't."""
    ids = references.filter(F.col(reference).isNotNull()).groupBy(F.col(reference).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    marked = ids.join(known.select(F.col(identifier).alias("id"), F.lit(True).alias("known")).distinct(), "id", "left")
    found = F.coalesce("known", F.lit(False))
    return marked.agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("ids"), F.count_if(found).alias("resolved"), F.count_if(~found).alias("missing"))


def length_profile(rows: DataFrame, text: str) -> DataFrame:
    """Exact percentiles of words in a text."""
    n = F.size(words(F.col(text)))
    shares = (0.1, 0.25, 0.5, 0.75, 0.9, 0.99)
    return rows.select(n.cast("double").alias("words")).agg(*[F.percentile("words", F.lit(p)).alias(f"p{int(100 * p)}") for p in shares], F.max("words").alias("longest"))
