"""Shredding of nested XML records into an adjacency table and entity tables.

``shred`` stores every node of a record as one row: its owner key, its number, the number
of its parent, its label, its ordinal and its scalar. ``entity_table`` joins the object nodes
of one label with their scalar children and pivots those into columns, so that a deep tree
becomes flat tables that keep the parent link and the record key.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from xml.parsers import expat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("element", "attribute", "text")
FIELDS = ("kind", "node_no", "parent_no", "ordinal", "label", "scalar")
ARROW = (pa.int8(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
#: Records whose nodes leave the parser as one batch.
BATCH_RECORDS = 64


class _LocalNames(dict):
    """Names without their prefixes, found when they are first met."""

    def __missing__(self, name: str) -> str:
        self[name] = found = name.rpartition(":")[2]
        return found


_LOCAL = _LocalNames()


def local_name(name: str) -> str:
    """The name without its prefix."""
    return _LOCAL[name]


def node_columns(xml: str) -> tuple[list, ...] | None:
    """All nodes as columns (kind, node_no, parent_no, ordinal, label, scalar), None when malformed.

    ``kind`` is a place in KINDS. Elements are numbered from 1 in order of their start tags; attribute
    and text nodes have no number of their own and hang on ``parent_no``. ``ordinal`` counts, from 1,
    the elements among the children of one parent, the attributes of one element, or its pieces of
    text. The scalar of an element is its direct text with white space collapsed, null when it has none.
    """
    kinds: list[int] = []
    numbers: list[int | None] = []
    parents: list[int] = []
    ordinals: list[int] = []
    labels: list[str] = []
    scalars: list[str | None] = []
    columns = (kinds, numbers, parents, ordinals, labels, scalars)
    places = [0]  # row of the element with that number; none has number 0
    pieces: dict[int, list[str]] = {}
    children = [0]
    open_nodes = [0]
    buffer: list[str] = []

    def flush():
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text and open_nodes[-1]:
            pieces.setdefault(open_nodes[-1], []).append(text)

    def start(name, attributes):
        if buffer:
            flush()
        number, parent = len(places), open_nodes[-1]
        children[parent] += 1
        children.append(0)
        places.append(len(kinds))
        kinds.append(0)
        numbers.append(number)
        parents.append(parent)
        ordinals.append(children[parent])
        labels.append(_LOCAL[name])
        scalars.append(None)
        open_nodes.append(number)
        if attributes:
            n = len(attributes) // 2
            kinds.extend([1] * n)
            numbers.extend([None] * n)
            parents.extend([number] * n)
            ordinals.extend(range(1, n + 1))
            labels.extend([_LOCAL[a] for a in attributes[::2]])
            scalars.extend(attributes[1::2])

    def end(_name):
        if buffer:
            flush()
        open_nodes.pop()

    parser = expat.ParserCreate("utf-8")
    parser.ordered_attributes = True
    parser.buffer_text = True
    parser.StartElementHandler = start
    parser.EndElementHandler = end
    parser.CharacterDataHandler = buffer.append
    try:
        parser.Parse(xml.encode("utf-8", "surrogatepass"), True)
    except (expat.ExpatError, ValueError):
        return None
    for number, found in pieces.items():
        scalars[places[number]] = " ".join(found)
        n = len(found)
        kinds.extend([2] * n)
        numbers.extend([None] * n)
        parents.extend([number] * n)
        ordinals.extend(range(1, n + 1))
        labels.extend(["text()"] * n)
        scalars.extend(found)
    return columns


def _arrow_keys(batch: pa.RecordBatch, names: Sequence[str], repeats: np.ndarray) -> list[pa.Array]:
    take = pa.array(np.repeat(np.arange(batch.num_rows), repeats))
    return [batch.column(batch.schema.get_field_index(n)).take(take) for n in names]


def _check_keys(df: DataFrame, xml: str, keys: Sequence[str], produced: Iterable[str]) -> None:
    clash = set(keys) & set(produced)
    if clash:
        raise ValueError(f"key columns {sorted(clash)} clash with columns that shredding makes; rename them first")
    missing = [c for c in (xml, *keys) if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")


def shred(df: DataFrame, xml: str, keys: Sequence[str]) -> DataFrame:
    """The adjacency table: keys, kind, node_no, parent_no, ordinal, label, scalar.

    ``kind`` is element, attribute or text. Nulls, empty texts and XML that isn't well-formed give no
    rows; repeated records are shredded each on their own; other columns are dropped. No shuffle:
    every record is parsed where it lies, once. Store the table (``session.stored``) when more than
    one reader needs it.
    """
    _check_keys(df, xml, keys, FIELDS)
    keys = list(keys)
    types = (T.StringType(), T.IntegerType(), T.IntegerType(), T.IntegerType(), T.StringType(), T.StringType())
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(n, t) for n, t in zip(FIELDS, types)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(KINDS)
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_RECORDS):
                part = batch.slice(begin, BATCH_RECORDS)
                counts = np.zeros(part.num_rows, dtype=np.int64)
                whole: tuple[list, ...] = tuple([] for _ in FIELDS)
                for i, value in enumerate(part.column(part.num_columns - 1).to_pylist()):
                    found = node_columns(value) if value else None
                    if found:
                        counts[i] = len(found[0])
                        for column, own in zip(whole, found):
                            column += own
                if whole[0]:
                    columns = [pa.array(c, t) for c, t in zip(whole, ARROW)]
                    columns[0] = names.take(columns[0])
                    yield pa.RecordBatch.from_arrays(_arrow_keys(part, keys, counts) + columns, names=[*keys, *FIELDS])

    return df.select(*keys, F.col(xml).cast("string").alias("__xml")).mapInArrow(run, schema)


def elements(nodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The elements of an adjacency table: keys, node_no, parent_no, tag."""
    if "tag" in keys:
        raise ValueError("the key column 'tag' clashes with a column that is made")
    return nodes.filter(F.col("kind") == "element").select(*keys, "node_no", "parent_no", F.col("label").alias("tag"))


def _wanted(columns: dict[str, str]) -> dict[str, tuple[str, str]]:
    """(kind, label) of every path: ``@attribute``, ``text()`` or the label of a child element."""
    return {name: ("attribute", path[1:]) if path.startswith("@") else ("text", "text()") if path == "text()" else ("element", path) for name, path in columns.items()}


def _scalar_children(nodes: DataFrame, tag: str, wanted: Sequence[tuple[str, str]], keys: Sequence[str]) -> DataFrame:
    """Object nodes ``tag`` joined with those of their children that are wanted; objects without any stay."""
    objects = nodes.filter((F.col("kind") == "element") & (F.col("label") == tag)).select(*keys, "node_no", F.col("parent_no").alias("up"), F.col("ordinal").alias("place"))
    match = F.lit(False)
    for kind, label in sorted(set(wanted)):
        match = match | ((F.col("kind") == kind) & (F.col("label") == label))
    scalars = nodes.filter(match).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("parent_no").alias("__owner"), "kind", "label", F.col("ordinal").alias("__at"), "scalar")
    on = F.col("node_no") == F.col("__owner")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return objects.join(scalars, on, "left")


def entity_table(nodes: DataFrame, tag: str, columns: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """The entities ``tag`` of an adjacency table, one row each, with their scalar children pivoted.

    ``columns`` maps an output name to ``@attribute``, ``text()`` or the label of a child element
    whose own text is wanted (the first one, by ordinal; :func:`repeated_children` has a row for every
    one). Absent children give null. Every row keeps the record keys, ``node_no``, ``parent_no`` and
    ``ordinal``. A null among the keys makes the records with it fall together, as any group does.
    """
    keys, wanted = list(keys), _wanted(columns)
    joined = _scalar_children(nodes, tag, list(wanted.values()), keys)

    def pick(kind: str, label: str) -> Column:
        hit = (F.col("kind") == kind) & (F.col("label") == label)
        if kind == "text":
            pieces = F.array_sort(F.collect_list(F.when(hit, F.struct(F.col("__at").alias("a"), F.col("scalar").alias("s")))))
            return F.nullif(F.array_join(F.transform(pieces, lambda x: x["s"]), " "), F.lit(""))
        return F.min_by(F.when(hit, F.col("scalar")), F.when(hit, F.col("__at")))

    aggregates = [pick(*w).alias(n) for n, w in wanted.items()]
    grouped = joined.groupBy(*keys, "node_no", "up", "place").agg(*aggregates)
    return grouped.select(*keys, "node_no", F.col("up").alias("parent_no"), F.col("place").alias("ordinal"), *wanted)


def repeated_children(nodes: DataFrame, tag: str, labels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Children ``labels`` of the entities ``tag``, one row each however often they repeat.

    Keys, ``node_no`` of the entity, ``label``, ``ordinal`` among its children, ``scalar``. Entities
    without such a child give no row; an element without text of its own has a null scalar.
    """
    joined = _scalar_children(nodes, tag, [("element", label) for label in labels], list(keys))
    return joined.filter(F.col("label").isNotNull()).select(*keys, "node_no", "label", F.col("__at").alias("ordinal"), "scalar")
