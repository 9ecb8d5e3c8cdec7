"""Editorial XML to plain text, and the parts of a document that are stored as texts.

A document is parsed once; one walk writes the text under five switches. The rules differ for
editions and for translations; both walk the tree with the same table of element rules.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

XML_LANG = "{http://www.w3.org/XML/1998/namespace}lang"
#: Elements that are never shown, and rend values that break a line.
HIDDEN = frozenset(("teiHeader", "head", "note", "certainty", "fw"))
BREAKS = frozenset(("break", "horizontal-rule"))
EMPTY_KINDS = frozenset(("div", "ab", "p", "note", "head"))


@dataclass(frozen=True)
class Switches:
    """What is shown: expanded abbreviations, a line break at a gap, lost and unclear text, regular spellings."""

    abbrev: bool = False
    break_on_gap: bool = False
    lost: bool = False
    unclear: bool = False
    regularize: bool = False


FULLEST = Switches(abbrev=True, lost=True, unclear=True, regularize=True)


def local(node: ET.Element) -> str:
    tag = node.tag
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def parse(xml: str | bytes) -> ET.Element:
    """The outermost element; bytes may begin with a byte order mark."""
    return ET.fromstring(xml.encode("utf-8", "surrogatepass") if isinstance(xml, str) else xml)


def language_of(node: ET.Element) -> str | None:
    return (node.get(XML_LANG) or "").strip() or None


def edition_of(root: ET.Element) -> ET.Element | None:
    return next((n for n in root.iter() if local(n) == "div" and n.get("type") == "edition"), None)


def translations_of(root: ET.Element) -> list[ET.Element]:
    """Translation divisions that lie in no other, in document order."""
    found: list[ET.Element] = []

    def walk(node: ET.Element) -> None:
        if local(node) == "div" and node.get("type") == "translation":
            found.append(node)
        else:
            for child in node:
                walk(child)

    walk(root)
    return found


class _Writer:
    """Writes one document; ``broken`` tells of each line mark whether one stands before it."""

    def __init__(self, root: ET.Element, switches: Switches, translation: bool):
        self.switches, self.translation = switches, translation
        self.out: list[str] = []
        self.later_marks = {id(n) for i, n in enumerate(m for m in root.iter() if local(m) == "lb") if i}

    def text(self, value: str | None) -> None:
        if not value:
            return
        if value.strip(" \t\r\n"):
            self.out.append(re.sub(r"[ \t\r\n]+", " ", value))
        elif "\n" not in value and "\r" not in value:
            self.out.append(" ")

    def inside(self, node: ET.Element) -> None:
        self.text(node.text)
        for child in node:
            self.node(child, local(node))
            self.text(child.tail)

    def first(self, node: ET.Element, name: str) -> ET.Element | None:
        return next((c for c in node if local(c) == name), None)

    def choice(self, node: ET.Element) -> None:
        regular = self.switches.regularize and not self.translation
        order = (("reg",) if regular else ()) + ("orig",) + (("corr",) if regular else ()) + ("sic",)
        chosen = next((c for c in (self.first(node, n) for n in order) if c is not None), None)
        self.inside(node if chosen is None else chosen)

    def apparatus(self, node: ET.Element) -> None:
        lemma = self.first(node, "lem")
        if lemma is not None:
            self.inside(lemma)
        elif node.text:
            self.text(node.text)
        elif len(node):
            self.node(node[0], "app")

    def node(self, node: ET.Element, parent: str) -> None:
        name, switches = local(node), self.switches
        if not name or name in HIDDEN or name == "del" and parent == "subst":
            return
        if name == "lb":
            if id(node) in self.later_marks:
                self.out.append("\n")
        elif name == "gap":
            if switches.break_on_gap:
                self.out.append("\n")
        elif name == "space":
            self.out.append(" ")
        elif name == "milestone":
            if self.translation:
                self.out.append("\n" if node.get("rend") in BREAKS else " " if node.get("unit") == "line" else "")
        elif name == "choice":
            self.choice(node)
        elif name == "app":
            self.apparatus(node)
        elif name == "subst":
            added = self.first(node, "add")
            self.inside(node if added is None else added)
        elif self.translation:
            self.inside(node)
            if name == "p":
                self.out.append("\n")
        elif name == "ex" and not switches.abbrev or name == "unclear" and not switches.unclear:
            return
        elif name == "supplied" and not (switches.lost and node.get("reason") == "lost"):
            return
        else:
            self.inside(node)


def _cleaned(raw: str, blanks: str) -> str:
    lines = re.sub("\r\n?", "\n", raw).split("\n")
    joined = "\n".join(re.sub(f"[{blanks}]+", " ", line).strip(" ") for line in lines)
    return joined.strip(" \t\r\n")


def edition_text(xml: str | bytes, switches: Switches = Switches()) -> str:
    """The text of the first edition division, or of the whole document where there is none."""
    root = parse(xml)
    start = edition_of(root)
    writer = _Writer(root, switches, translation=False)
    writer.node(root if start is None else start, "")
    return _cleaned("".join(writer.out), " \t\r\n")


def translation_text(xml: str | bytes, language: str | None = None) -> str:
    """The texts of the translation divisions (of one language, where given), one after the other."""
    root = parse(xml)
    found = translations_of(root)
    writer = _Writer(root, Switches(), translation=True)
    if not found:
        writer.node(root, "")
    for n, node in enumerate(t for t in found if language is None or t.get(XML_LANG) == language):
        if n:
            writer.out.append("\n")
        writer.node(node, "")
    return _cleaned("".join(writer.out), " \t\r\n")


def transcription_language(xml: str | bytes) -> str | None:
    root = parse(xml)
    edition = edition_of(root)
    return (language_of(edition) if edition is not None else None) or language_of(root)


def translation_languages(xml: str | bytes) -> list[str]:
    """Languages of the translation divisions, each once, in order."""
    return list(dict.fromkeys(tag for n in translations_of(parse(xml)) if (tag := language_of(n))))


def without_namespaces(node: ET.Element) -> ET.Element:
    out = ET.Element(local(node), {(k if k == XML_LANG or "}" not in k else k.rpartition("}")[2]): v for k, v in node.attrib.items()})
    out.text, out.tail = node.text, node.tail
    out.extend(without_namespaces(c) for c in node if isinstance(c.tag, str))
    return out


def serialized(node: ET.Element, remove_namespaces: bool = True) -> str:
    shown = without_namespaces(node) if remove_namespaces else node
    tail, shown.tail = shown.tail, None
    out = ET.tostring(shown, encoding="unicode")
    shown.tail = tail
    return out


def transcription_snippet(xml: str | bytes, remove_namespaces: bool = True) -> str | None:
    edition = edition_of(parse(xml))
    return None if edition is None else serialized(edition, remove_namespaces)


def translation_snippets(xml: str | bytes) -> list[tuple[str | None, str]]:
    return [(language_of(n), serialized(n)) for n in translations_of(parse(xml))]


def has_edition(xml: str | bytes) -> bool:
    """Whether an edition division holds text outside notes, or any element of substance."""
    for edition in parse(xml).iter():
        if local(edition) != "div" or edition.get("type") != "edition":
            continue
        if any(local(n) not in EMPTY_KINDS for n in edition.iter() if isinstance(n.tag, str)):
            return True
        stack = [edition]
        while stack:
            node = stack.pop()
            own = [node.text, *(c.tail for c in node)]
            if any(t and t.strip() for t in own):
                return True
            stack += [c for c in node if local(c) != "note"]
    return False


def _guarded(function: Callable, kind: T.DataType, arrow: pa.DataType) -> Callable[[Column], Column]:
    @F.arrow_udf(kind)
    def run(values: pa.Array) -> pa.Array:
        out = []
        for v in values.to_pylist():
            try:
                out.append(None if v is None else function(v))
            except (ET.ParseError, ValueError):
                out.append(None)
        return pa.array(out, arrow)

    return run


def render_edition(xml: Column, switches: Switches = FULLEST) -> Column:
    """:func:`edition_text` as an expression; null for null and for XML that isn't well-formed."""
    return _guarded(lambda v: edition_text(v, switches), T.StringType(), pa.string())(xml)


def render_translation(xml: Column, language: str | None = None) -> Column:
    return _guarded(lambda v: translation_text(v, language), T.StringType(), pa.string())(xml)


@F.arrow_udf(T.StringType())
def _rendered(values: pa.Array, kinds: pa.Array) -> pa.Array:
    out = []
    for v, kind in zip(values.to_pylist(), kinds.to_pylist()):
        try:
            out.append(None if v is None else translation_text(v) if kind == "translation" else edition_text(v, FULLEST))
        except (ET.ParseError, ValueError):
            out.append(None)
    return pa.array(out, pa.string())


def render_document(xml: Column, kind: Column) -> Column:
    """The fullest text of an edition or a translation, whichever ``kind`` says; each document is parsed once."""
    return _rendered(xml, kind)


def document_language(xml: Column) -> Column:
    return _guarded(transcription_language, T.StringType(), pa.string())(xml)


def languages_available(xml: Column) -> Column:
    return _guarded(translation_languages, T.ArrayType(T.StringType()), pa.list_(pa.string()))(xml)


def snippet(xml: Column) -> Column:
    return _guarded(transcription_snippet, T.StringType(), pa.string())(xml)


def snippets(xml: Column) -> Column:
    """array of struct(lang, xml) of the translation divisions."""
    kind = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("xml", T.StringType())]))
    arrow = pa.list_(pa.struct([("lang", pa.string()), ("xml", pa.string())]))
    return _guarded(lambda v: [{"lang": a, "xml": b} for a, b in translation_snippets(v)], kind, arrow)(xml)


def edition_present(xml: Column) -> Column:
    return _guarded(has_edition, T.BooleanType(), pa.bool_())(xml)
