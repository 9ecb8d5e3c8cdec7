"""Six relational tables, and those registered besides, from the metadata of records.

Every record is parsed once, into one struct with an array of rows for each table; the tables are
explosions of that struct. Numbering of rows needs no global sort: partitions are counted, and a
row's number is its place in its partition plus the counts of those before.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.functions.text import BIBLIO as BIBLIO_TARGET
from ostraka.functions.text import PERSEUS_AUTHOR, PLEIADES, TM_AUTHORWORK, TM_PLACE
from ostraka.operators.render import local, parse

# Placeholders, and the kinds that places may have.
NO_IDENTIFIER = ("", "hgvTEMP")
NO_VALUE = ("", "unbekannt", "keiner")
PLACE_TYPES = ("located", "found", "composed", "sent", "acquired", "received")
GRANULARITIES = ("settlement", "nome", "region")
REFERENCE_TM, REFERENCE_PLEIADES = re.compile(TM_PLACE), re.compile(PLEIADES)
AUTHORWORK, PERSEUS, BIBLIO = re.compile(TM_AUTHORWORK), re.compile(PERSEUS_AUTHOR), re.compile(BIBLIO_TARGET)
DATE = re.compile(r"(-?\d{4,})(?:-(\d{2})(?:-(\d{2}))?)?\Z")
XML_ID = "{http://www.w3.org/XML/1998/namespace}id"

I, S, B = T.IntegerType(), T.StringType(), T.BooleanType()


@dataclass(frozen=True)
class Table:
    """A table: its columns after the record's, its surrogate key, and what it holds."""

    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    key: str | None
    description: str

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.columns])

    @property
    def names(self) -> list[str]:
        head = ["source_path", "tm_id"] if self.key is None else [self.key, "tm_id"]
        return head + [n for n, _ in self.columns]


def _text(names: str) -> tuple[tuple[str, T.DataType], ...]:
    return tuple((n, S) for n in names.split())


BOUNDS = tuple((f"{side}_{part}", I) for side in ("not_before", "not_after") for part in ("year", "month", "day"))
TABLES = {
    t.name: t
    for t in (
        Table("papyri", (("dclp_id", I), *_text("dclp_hybrid_id ddb_perseus_style_id ddb_filename ddb_hybrid_id hgv_id ldab_id mp3_id title material current_location")), None, "One row for each metadata file: identifiers, title, material and present place."),
        Table("principal_editions", (("biblio_id", I), *_text("title author volume number page")), "principal_edition_id", "Principal editions of a record."),
        Table("keywords", (*_text("scheme keyword_type keyword"), ("uncertain", B)), "keyword_id", "Keywords of a record, with the mark of doubt apart."),
        Table("orig_dates", (*_text("date_text certainty precision"), *BOUNDS, ("alternative", B)), "date_id", "Dates of a record as bounds; a missing bound is open."),
        Table("orig_places", (*_text("full_place_name place_name"), ("tm_place_id", I), ("pleiades_place_id", I), *_text("place_type granularity")), "place_id", "Ancient places of a record."),
        Table("ancient_editions", (("title", S), ("tm_title_id", I), *_text("author perseus_author_urn")), "ancient_edition_id", "Ancient works that a record holds."),
    )
}


def table_summary() -> str:
    return "\n".join(f"{t.name}: {t.description}" for t in TABLES.values())


def catalog(name: str) -> str:
    """The columns of a table with their types."""
    if name not in TABLES:
        raise KeyError(f"no table {name!r}")
    types = dict(TABLES[name].columns) | {"source_path": S, "tm_id": I, TABLES[name].key: I}
    return "\n".join([TABLES[name].description, *(f"- {n}: {types[n].simpleString()}" for n in TABLES[name].names)])


def squeezed(node: ET.Element | None) -> str | None:
    """The text of a node with XML white space collapsed; null when blank or without node."""
    if node is None:
        return None
    return re.sub(r"[ \t\r\n]+", " ", "".join(node.itertext())).strip(" ") or None


def attribute(node: ET.Element | None, name: str) -> str | None:
    value = None if node is None else node.get(name)
    return (value.strip() or None) if value else None


def children(node: ET.Element, *path: str) -> Iterator[ET.Element]:
    """Descendants along a path of child names, in document order."""
    if not path:
        yield node
        return
    for child in node:
        if local(child) == path[0]:
            yield from children(child, *path[1:])


def under(root: ET.Element, first: str, *path: str) -> Iterator[ET.Element]:
    """Nodes along a path that begins at any element ``first``."""
    for node in root.iter():
        if local(node) == first:
            yield from children(node, *path)


def _first(nodes: Iterator[ET.Element]) -> ET.Element | None:
    return next(nodes, None)


def _raw(node: ET.Element | None, *nothing: str) -> str | None:
    value = None if node is None else "".join(node.itertext())
    return None if value is None or value in nothing else value


def date_parts(value: str) -> tuple[int | None, int | None, int | None]:
    m = DATE.match(value)
    if not m:
        raise ValueError(f"not a date: {value!r}")
    return tuple(int(p) if p else None for p in m.groups())


def keyword_parts(value: str) -> tuple[str, bool]:
    """A keyword without its marks of doubt, and whether it had one."""
    doubt = "?" in value
    return " ".join(re.sub(r"\(\s*\?\s*\)|\?", "", value).split()) if doubt else value, doubt


def person(forename: ET.Element | None, surname: ET.Element | None, author: ET.Element | None) -> str | None:
    parts = [p for p in (squeezed(forename), squeezed(surname)) if p]
    return " ".join(parts) if parts else squeezed(author)


def _identifier(root: ET.Element, kind: str) -> str | None:
    return _raw(_first(n for n in under(root, "publicationStmt", "idno") if n.get("type") == kind), *NO_IDENTIFIER)


def _papyrus(root: ET.Element) -> dict:
    kinds = {"dclp_hybrid_id": "dclp-hybrid", "ddb_perseus_style_id": "ddb-perseus-style", "ddb_filename": "ddb-filename", "ddb_hybrid_id": "ddb-hybrid", "hgv_id": "HGV", "ldab_id": "LDAB", "mp3_id": "MP3"}
    dclp = _identifier(root, "dclp")
    places = {id(n) for path in (("idno",), ("placeName", "settlement"), ("collection",), ("institution",)) for n in under(root, "msDesc", "msIdentifier", *path)}
    location = _first(n for n in root.iter() if id(n) in places)
    material = _raw(_first(under(root, "physDesc", "objectDesc", "supportDesc", "support", "material")), "")
    row = {name: _identifier(root, kind) for name, kind in kinds.items()}
    return row | {"dclp_id": int(dclp.strip()) if dclp else None, "title": _raw(_first(under(root, "titleStmt", "title")), *NO_VALUE), "material": material.lower() if material else None, "current_location": _raw(location, *NO_VALUE)}


def _keywords(root: ET.Element) -> list[dict]:
    out = []
    for group in under(root, "profileDesc", "textClass", "keywords"):
        for term in children(group, "term"):
            value = squeezed(term)
            word, doubt = keyword_parts(value) if value else ("", False)
            if word:
                out.append({"scheme": attribute(group, "scheme"), "keyword_type": attribute(term, "type"), "keyword": word, "uncertain": doubt})
    return out


def _dates(root: ET.Element) -> list[dict]:
    out = []
    for node in under(root, "origDate"):
        exact = attribute(node, "when") or attribute(node, "when-custom")
        sides = [exact or attribute(node, name) for name in ("notBefore", "notAfter")]
        if any(sides):
            parts = [p for s in sides for p in (date_parts(s) if s else (None, None, None))]
            row = {"date_text": squeezed(node) or "", "certainty": attribute(node, "cert"), "precision": attribute(node, "precision"), "alternative": (node.get(XML_ID) or "").startswith("dateAlternative")}
            for field in ("certainty", "precision"):
                if row[field] not in (None, "low", "medium"):
                    raise ValueError(f"{field} is {row[field]!r}")
            out.append(row | dict(zip((n for n, _ in BOUNDS), parts)))
    return out


def _places(root: ET.Element) -> list[dict]:
    full = squeezed(_first(under(root, "msDesc", "history", "origin", "origPlace"))) or ""
    out = []
    for provenance in under(root, "msDesc", "history", "provenance"):
        kind = attribute(provenance, "type")
        for node in children(provenance, "p", "placeName"):
            name, granularity = squeezed(node), attribute(node, "subtype") or "settlement"
            if node.get("type") != "ancient" or not name or kind not in (None, *PLACE_TYPES) or granularity not in GRANULARITIES:
                continue
            reference = attribute(node, "ref") or ""
            pleiades = REFERENCE_PLEIADES.search(reference)
            for tm in REFERENCE_TM.findall(reference) or [None]:
                out.append({"full_place_name": full, "place_name": name, "tm_place_id": int(tm) if tm else None, "pleiades_place_id": int(pleiades[1]) if pleiades else None, "place_type": kind, "granularity": granularity})
    return out


def _bibliography(root: ET.Element, subtype: str) -> Iterator[ET.Element]:
    for div in under(root, "div"):
        if div.get("type") == "bibliography" and div.get("subtype") == subtype:
            yield from children(div, "listBibl", "bibl")


def _ranked_titles(bibl: ET.Element) -> list[ET.Element]:
    order = {"main": 0, "abbreviated": 1}
    return sorted(children(bibl, "title"), key=lambda n: order.get(n.get("type"), 2))


def _principal(root: ET.Element) -> list[dict]:
    out = []
    for bibl in _bibliography(root, "principalEdition"):
        titles: dict[int, str | None] = {}
        for node in _ranked_titles(bibl):
            titles.setdefault({"main": 0, "abbreviated": 1}.get(node.get("type"), 2), squeezed(node))
        author = _first(children(bibl, "author"))
        scopes = list(children(bibl, "biblScope"))
        scope = lambda *names: squeezed(_first(n for n in scopes if n.get("unit") in names or n.get("type") in names))
        ids = [m[1] for p in children(bibl, "ptr") if (m := BIBLIO.search(p.get("target") or ""))]
        part = lambda name: None if author is None else _first(children(author, name))
        out.append({
            "biblio_id": int(ids[0]) if ids else None, "title": next((t for _, t in sorted(titles.items()) if t), None), "author": person(part("forename"), part("surname"), author),
            "volume": scope("volume"), "number": scope("number", "numbers"), "page": scope("page", "pages", "pp"),
        })
    return out


def _ancient(root: ET.Element) -> list[dict]:
    out = []
    for bibl in _bibliography(root, "ancientEdition"):
        title = _first(iter(_ranked_titles(bibl)))
        author = _first(children(bibl, "author"))
        works = [m[1] for token in (attribute(title, "ref") or "").split() if (m := AUTHORWORK.match(token))]
        urn = PERSEUS.search(attribute(author, "ref") or "")
        row = {
            "title": squeezed(title), "tm_title_id": int(works[0]) if works else None,
            "author": person(_first(children(bibl, "author", "forename")), _first(children(bibl, "author", "surname")), author), "perseus_author_urn": urn[1] if urn else None,
        }
        if any(v is not None for v in row.values()):
            out.append(row)
    return out


Rows = Callable[[ET.Element], list[dict]]
#: What gives the rows of each table from the outermost element of a record.
EXTRACTORS: dict[str, Rows] = {
    "papyri": lambda root: [_papyrus(root)], "principal_editions": _principal, "keywords": _keywords, "orig_dates": _dates, "orig_places": _places, "ancient_editions": _ancient,
}


def register(table: Table, rows: Rows) -> None:
    """A further table, after those there are: it is extracted, listed and stored like them."""
    if table.name in TABLES:
        raise ValueError(f"there is a table {table.name!r} already")
    TABLES[table.name], EXTRACTORS[table.name] = table, rows


def record_rows(xml: str | bytes, extractors: dict[str, Rows] | None = None) -> dict:
    """The record's TM id and its rows for all tables; a value that a table can't hold is an error."""
    root = parse(xml)
    tm = _identifier(root, "TM")
    if tm is None or not tm.strip().isdigit() or int(tm) < 1:
        raise ValueError(f"no usable TM id: {tm!r}")
    return {"tm_id": int(tm)} | {name: rows(root) for name, rows in (EXTRACTORS if extractors is None else extractors).items()}


def extracted(records: DataFrame, path: str = "source_path", xml: str = "xml") -> DataFrame:
    """source_path, tm_id and an array of structs for each table; one parse of every record.

    A record that can't be read fails the query, with its path in the message. Null XML gives no row.
    """
    schema = T.StructType([T.StructField("source_path", S), T.StructField("tm_id", I), *[T.StructField(t.name, T.ArrayType(t.struct)) for t in TABLES.values()]])
    kinds = {"integer": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}
    own = dict(EXTRACTORS)  # tables registered here are known to the workers by this
    arrow = {t.name: pa.list_(pa.struct([(n, kinds[k.typeName()]) for n, k in t.columns])) for t in TABLES.values()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, rows = [], []
            for where, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if value is None:
                    continue
                try:
                    rows.append(record_rows(value, own))
                except (ET.ParseError, ValueError) as error:
                    raise ValueError(f"{where}: {error}") from error
                paths.append(where)
            columns = [pa.array(paths, pa.string()), pa.array([r["tm_id"] for r in rows], pa.int32()), *[pa.array([r[n] for r in rows], t) for n, t in arrow.items()]]
            yield pa.RecordBatch.from_arrays(columns, names=["source_path", "tm_id", *arrow])

    return records.select(F.col(path).alias("source_path"), F.col(xml)).mapInArrow(run, schema)


def numbered(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Rows with ``name`` counting from 1 in the given order, without sorting them in one task.

    Rows are range-partitioned and sorted, each partition is counted, and its rows start after the
    counts of the partitions before; only one row for each partition is summed in a single task.
    """
    from ostraka.session import cut

    # written once, so that both counts see the same partitions
    ranged = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id()))
    counts = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"), F.min("__i").alias("__first"))
    before = counts.select("__p", "__first", (F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))).alias("__before"))
    return ranged.join(F.broadcast(before), "__p").withColumn(name, (F.col("__i") - F.col("__first") + F.coalesce("__before", F.lit(0)) + 1).cast("int")).drop("__p", "__i", "__first", "__before", "__n")


def metadata_table(parsed: DataFrame, name: str, order: tuple[str, ...] = ("source_path",)) -> DataFrame:
    """One table of :func:`extracted`, in its column order; surrogate keys count in record and node order."""
    spec = TABLES[name]
    rows = parsed.select("source_path", "tm_id", *[c for c in order if c not in ("source_path", "tm_id")], F.posexplode(name).alias("__node", "row")).select("*", "row.*").drop("row")
    if spec.key:
        rows = numbered(rows, spec.key, [*order, "__node"])
    return rows.select(*spec.names)
