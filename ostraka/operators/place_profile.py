"""Profiles of the place names in records: where they stand, what they refer to, how paragraphs put them together."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.operators.metadata import XML_ID, children, squeezed, under
from ostraka.operators.render import local, parse

#: References of each authority.
AUTHORITIES = {
    "trismegistos": r"(?:https?://)?(?:www\.)?trismegistos\.org/place/([0-9]+)\b", "pleiades": r"(?:https?://)?pleiades\.stoa\.org/places/([0-9]+)\b",
    "wikidata": r"(?:https?://)?www\.wikidata\.org/wiki/(Q[0-9]+)\b", "geonames": r"(?:https?://)?www\.geonames\.org/([0-9]+)\b",
}
FIELDS = ("scope", "paragraph", "label", "signature", "ref", "key")


def authorities(reference: Column) -> Column:
    """struct of the ids that a reference has of every authority, in order."""
    return F.struct(*[F.regexp_extract_all(F.coalesce(reference, F.lit("")), F.lit(p), F.lit(1)).alias(n) for n, p in AUTHORITIES.items()])


def place_signature(node: ET.Element) -> str:
    """Type, subtype, certainty and whether there is a reference."""
    parts = [node.get("type", "(no type)"), node.get("subtype"), f"cert={node.get('cert')}" if node.get("cert") else None, "ref" if node.get("ref") else None]
    return ":".join(p for p in parts if p)


def record_mentions(root: ET.Element) -> list[tuple]:
    """(scope, paragraph, label, signature, ref, key) of every place name; paragraphs count from 1, other places have none."""
    row = lambda scope, node, paragraph=None: (scope, paragraph, squeezed(node) or "(empty)", place_signature(node), node.get("ref"), node.get("key"))
    out = [row("current_settlement", n) for n in under(root, "msDesc", "msIdentifier", "placeName", "settlement")]
    for place in under(root, "msDesc", "history", "origin", "origPlace"):
        out += [row("origin_place_name", n) for n in place.iter() if n is not place and local(n) == "placeName"]
    paragraph = 0
    for event in under(root, "msDesc", "history", "provenance"):
        out += [row("provenance_place", n) for n in children(event, "placeName")]
        for p in children(event, "p"):
            paragraph += 1
            out += [row("provenance_place", n, paragraph) for n in children(p, "placeName")]
    return out


def paragraph_facts(root: ET.Element) -> list[tuple]:
    """(event type, paragraph id, excluded, with offset) of every paragraph of a provenance."""
    return [(e.get("type", "(none)"), p.get(XML_ID), bool(p.get("exclude")), any(local(c) == "offset" for c in p)) for e in under(root, "msDesc", "history", "provenance") for p in children(e, "p")]


def place_mentions(records: DataFrame, key: str = "tm_id", xml: str = "xml") -> DataFrame:
    """Place names of every record with the key; null or broken XML gives none. No shuffle."""
    kinds = [T.IntegerType() if f == "paragraph" else T.StringType() for f in FIELDS]
    schema = T.StructType([records.schema[key], *[T.StructField(f, t) for f, t in zip(FIELDS, kinds)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                try:
                    found = record_mentions(parse(text)) if text else []
                except (ET.ParseError, ValueError):
                    found = []
                at += [i] * len(found)
                rows += found
            if rows:
                columns = [pa.array(c, pa.int32() if f == "paragraph" else pa.string()) for c, f in zip(zip(*rows), FIELDS)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=[key, *FIELDS])

    return records.select(key, F.col(xml).alias("__xml")).mapInArrow(run, schema)


def scope_profile(mentions: DataFrame, gazetteer: DataFrame, key: str = "tm_id") -> DataFrame:
    """Names of every scope: how often, in how many records, with which references, and with one that resolves.

    A name with several ids counts once for each thing that any of them has.
    """
    marked = mentions.withColumn("__row", F.monotonically_increasing_id()).withColumn("a", authorities(F.col("ref")))
    ids = marked.select(key, "scope", "label", "ref", "key", "a", "__row", F.explode_outer("a.trismegistos").alias("__id"))
    known = gazetteer.select(F.col("id").cast("string").alias("__id"), F.lit(True).alias("__known"), (F.coalesce("coordinates", F.lit("")) != "").alias("__xy"), (F.col("begin_date").isNotNull() | F.col("end_date").isNotNull()).alias("__dated"))
    joined = ids.join(known, "__id", "left")
    each = joined.groupBy("__row", key, "scope", "label", "ref", "key", "a").agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for c, n in (("__known", "resolved"), ("__xy", "with_coordinates"), ("__dated", "with_dates"))])
    has = {n: F.size(F.col("a")[n]) > 0 for n in AUTHORITIES}
    return each.groupBy("scope").agg(
        F.count(F.lit(1)).alias("names"), F.count_distinct(key).alias("records"), F.count_distinct("label").alias("labels"), F.count_if(F.coalesce("ref", F.lit("")) != "").alias("with_ref"), F.count_if(F.coalesce("key", F.lit("")) != "").alias("with_key"),
        *[F.count_if(c).alias(f"with_{n}") for n, c in has.items()], F.count_if(F.size("a.trismegistos") > 1).alias("several_ids"), *[F.count_if(n).alias(n) for n in ("resolved", "with_coordinates", "with_dates")],
    )


def paragraph_profile(mentions: DataFrame, key: str = "tm_id") -> DataFrame:
    """Paragraphs by the signatures of their names in order, and by whether all, some or none of them have an id."""
    with_id = F.size(authorities(F.col("ref"))["trismegistos"]) > 0
    # a record's names come from one row in order; their number keeps it through the shuffle
    numbered = mentions.filter("paragraph is not null").withColumn("__at", F.monotonically_increasing_id())
    each = numbered.groupBy(key, "paragraph").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__at", "signature"))), lambda x: x["signature"]), " | ").alias("signatures"), F.count(F.lit(1)).alias("n"), F.count_if(with_id).alias("ids"))
    covered = F.when(F.col("ids") == F.col("n"), "all").when(F.col("ids") > 0, "some").otherwise("none")
    return each.groupBy("signatures", covered.alias("with_ids")).agg(F.count(F.lit(1)).alias("paragraphs"), F.count_distinct(key).alias("records"))
