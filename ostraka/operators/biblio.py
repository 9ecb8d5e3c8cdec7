"""Profiles of bibliography records, and of the pointers from metadata to them."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.operators.metadata import BIBLIO, XML_ID, children, squeezed
from ostraka.operators.profile import top_values
from ostraka.operators.render import local, parse

YEAR = re.compile(r"\b[12]\d{3}\b")


def biblio_id(node: ET.Element, path: str) -> str | None:
    """The number in the record's own xml:id (b123), else the name of a file named by a number."""
    m = re.fullmatch(r"b(\d+)", node.get(XML_ID) or "")
    stem = re.sub(r"\.xml\Z", "", path.rpartition("/")[2])
    return m[1] if m else stem if stem.isdigit() else None


def title_signature(node: ET.Element) -> str:
    """Level and type of a title, as far as it has them."""
    return ", ".join(f"{a}={node.get(a)}" for a in ("level", "type") if node.get(a) is not None) or "(no level/type)"


def contributor_shape(node: ET.Element) -> str:
    """Which parts of a name a contributor has, in order; plain text, or nothing."""
    return " + ".join(local(c) for c in node if isinstance(c.tag, str)) or ("text" if squeezed(node) else "empty")


def record_facts(xml: str, path: str) -> list[tuple[str, str | None, str | None]]:
    """(kind, value, detail) of one record: identity, type, titles, contributors, dates, scopes, relations, notes, segments."""
    root = parse(xml)
    numbers = {"file": re.sub(r"\.xml\Z", "", path.rpartition("/")[2]), "id": (root.get(XML_ID) or "")[1:] or None}
    numbers["idno"] = next((squeezed(n) for n in children(root, "idno") if n.get("type") == "pi"), None)
    agree = {v for v in numbers.values() if v}
    out: list[tuple[str, str | None, str | None]] = [("identity", "consistent" if len(agree) == 1 else "different", biblio_id(root, path)), ("type", root.get("type"), root.get("subtype"))]
    for node in root:
        name = local(node)
        if name == "title":
            out.append(("title", title_signature(node), squeezed(node)))
        elif name in ("author", "editor"):
            out.append(("contributor", f"{name}:{contributor_shape(node)}", squeezed(node)))
        elif name == "date":
            year = YEAR.search(squeezed(node) or "")
            out.append(("date", year[0] if year else None, squeezed(node)))
        elif name == "biblScope":
            out.append(("scope", node.get("unit") or node.get("type"), squeezed(node)))
        elif name == "relatedItem":
            for pointer in node.iter():
                m = BIBLIO.search(pointer.get("target") or "") if local(pointer) == "ptr" else None
                if m:
                    out.append(("relation", node.get("type"), m[1]))
        elif name in ("idno", "note", "seg"):
            out.append((name, node.get("type") or node.get("subtype"), squeezed(node)))
    return out


def biblio_facts(records: DataFrame, path: str = "source_path", xml: str = "xml") -> DataFrame:
    """(source_path, kind, value, detail); a record that isn't well-formed gives one row of kind error."""
    schema = "source_path string, kind string, value string, detail string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for where, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None:
                    continue
                try:
                    rows += [(where, *f) for f in record_facts(text, where or "")]
                except ET.ParseError:
                    rows.append((where, "error", None, None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["source_path", "kind", "value", "detail"])

    return records.select(F.col(path), F.col(xml)).mapInArrow(run, schema)


def fact_counts(facts: DataFrame) -> DataFrame:
    """Records and occurrences of every kind and value."""
    return facts.groupBy("kind", "value").agg(F.count_distinct("source_path").alias("records"), F.count(F.lit(1)).alias("occurrences"))


def relation_edges(facts: DataFrame) -> DataFrame:
    """The graph of records: (source, relation, target) with how often."""
    own = facts.filter("kind = 'identity' and detail is not null").select("source_path", F.col("detail").alias("source"))
    edges = facts.filter("kind = 'relation'").select("source_path", F.col("value").alias("relation"), F.col("detail").alias("target"))
    return edges.join(own, "source_path").groupBy("source", "relation", "target").agg(F.count(F.lit(1)).alias("times"))


def top_targets(edges: DataFrame, limit: int = 30) -> DataFrame:
    """The records most pointed to by each relation."""
    return top_values(edges.groupBy("relation", "target").agg(F.sum("times").alias("times")), ["relation"], "target", "times", limit)


def duplicate_ids(facts: DataFrame) -> DataFrame:
    return facts.filter("kind = 'identity' and detail is not null").groupBy(F.col("detail").alias("biblio_id")).agg(F.count(F.lit(1)).alias("records")).filter("records > 1")


def metadata_pointers(records: DataFrame, path: str = "source_path", xml: str = "xml") -> DataFrame:
    """(source_path, biblio_id, place): pointers to the bibliography and the type of the entry they stand in."""
    schema = T.StructType([T.StructField("source_path", T.StringType()), T.StructField("biblio_id", T.StringType()), T.StructField("place", T.StringType())])

    def pointers(text: str) -> list[tuple[str, str]]:
        out = []

        def walk(node: ET.Element, place: str) -> None:
            if local(node) == "bibl":
                place = node.get("type") or "bibl"
            m = BIBLIO.search(node.get("target") or "") if local(node) == "ptr" else None
            if m:
                out.append((m[1], place))
            for child in node:
                walk(child, place)

        walk(parse(text), "-")
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, *p) for w, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t is not None for p in pointers(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=schema.fieldNames())

    return records.select(F.col(path), F.col(xml)).mapInArrow(run, schema)
