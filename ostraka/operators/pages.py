"""What the pages of image sites say: addresses of images in stored HTML, JSON and METS, by site.

Every rule is a pure function of a page and its address; :func:`image_addresses` is their table.
"""

from __future__ import annotations

import html.parser
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable
from urllib.parse import parse_qs, urljoin, urlsplit, urlunsplit

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.operators import images
from ostraka.operators.render import local

# Endings of image files, and the groups of files in order of preference.
IMAGE_ENDINGS = (".bmp", ".gif", ".jp2", ".jpeg", ".jpg", ".png", ".tif", ".tiff")
FILE_GROUPS = ("MASTER", "IVIEW2")


def _different(found: Iterable[str | None]) -> list[str]:
    return list(dict.fromkeys(u for u in found if u))


def _is_image(url: str) -> bool:
    return urlsplit(url).path.lower().endswith(IMAGE_ENDINGS)


def _links(page: str, base: str, keep: Callable[[str, str], bool]) -> list[str]:
    return _different(u for tag, u, label in images.page_links(page, base) if tag == "a" and keep(u, label))


def mets_images(page: str) -> list[str]:
    """Files of the preferred group of a METS record, in the order of its physical map, the rest after."""
    root = ET.fromstring(page)
    groups: dict[str, dict[str, str]] = {}
    for group in (n for n in root.iter() if local(n) == "fileGrp"):
        for file in (c for c in group if local(c) == "file"):
            place = next((c for c in file if local(c) == "FLocat"), None)
            address = next((v for k, v in place.attrib.items() if k.rpartition("}")[2] == "href" and v), None) if place is not None else None
            kind = (file.get("MIMETYPE") or "").lower()
            if address and (kind.startswith("image/") or not kind and _is_image(address)):
                groups.setdefault((group.get("USE") or "").upper(), {})[file.get("ID") or address] = address
    chosen = next((groups[g] for g in FILE_GROUPS if g in groups), {})
    physical = next((n for n in root.iter() if local(n) == "structMap" and (n.get("TYPE") or "").upper() == "PHYSICAL"), None)
    named = [chosen.get(i) for n in (physical.iter() if physical is not None else ()) if local(n) in ("fptr", "area") for i in (n.get("FILEID") or "").split()]
    return _different([*named, *chosen.values()])


def _after_heading(page: str, base: str, heading: str) -> list[str]:
    """Links that follow a heading."""
    at = re.search(heading, page)
    return [] if at is None else _links(page[at.end() :], base, lambda u, _: True)


class _Tables(html.parser.HTMLParser):
    """The links and the bold labels of every table, those of tables within it included in its links."""

    def __init__(self):
        super().__init__()
        self.open: list[tuple[list[str], list[str]]] = []
        self.found: list[tuple[list[str], list[str]]] = []
        self.bold: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append(([], []))
        elif tag == "a" and (href := dict(attrs).get("href")):
            for _, links in self.open:
                links.append(href)
        elif tag == "b":
            self.bold = []

    def handle_data(self, data):
        if self.bold is not None:
            self.bold.append(data)

    def handle_endtag(self, tag):
        if tag == "b" and self.bold is not None:
            if self.open:
                self.open[-1][0].append("".join(self.bold).strip().removesuffix(":"))
            self.bold = None
        elif tag == "table" and self.open:
            self.found.append(self.open.pop())


def _table_links(page: str, base: str, heading: str) -> list[str]:
    """Different links of the first table that a bold heading stands in directly."""
    tables = _Tables()
    tables.feed(page)
    tables.close()
    return _different(urljoin(base, u) for u in next((links for labels, links in tables.found if heading in labels), ()))


# Where these sites keep their images, and the headings and labels of their pages.
BERLIN, MET_IMAGES, CAIRO, EGNET = "berlpap.smb.museum", "images.metmuseum.org", "ipap.csad.ox.ac.uk", "www.ifao.egnet.net"
CAIRO_LABELS = ("300 dpi image (b/w)", "300 dpi image (colour)")
VIGNETTES = "docs/vignettes/"
OXFORD_FILES = "https://ndownloader.figshare.com/files/"


def _berlin(page: str, base: str) -> list[str]:
    """The digital images, else the first published one."""
    own = [u for u in _table_links(page, base, "Digitalisate") if (p := urlsplit(u)).scheme == "https" and p.netloc == BERLIN and p.path.startswith("/Original/")]
    return own or [u for u in _table_links(page, base, "Publizierte Abbildungen") if urlsplit(u).scheme in ("http", "https") and urlsplit(u).hostname][:1]


def _egnet(page: str, base: str) -> list[str]:
    """By the address alone where it names the record, else the first vignette of the page."""
    parts = urlsplit(base)
    named = parse_qs(parts.query).get("id", [])
    if len(named) == 1 and re.fullmatch(r"[A-Za-z0-9_-]+", named[0]):
        return [urlunsplit((parts.scheme, parts.netloc, f"{parts.path.rstrip('/')}/{VIGNETTES}{named[0]}.jpg", "", ""))]
    form = re.compile(rf"/bases/publications/fifao67/{VIGNETTES}[A-Za-z0-9_-]+\.jpg", re.IGNORECASE)
    shown = [u.partition("#")[0] for tag, u, _ in images.page_links(page, base) if tag == "img" and urlsplit(u).hostname == EGNET and form.fullmatch(urlsplit(u).path)]
    return shown[:1]


def _oxford(page: str, base: str) -> list[str]:
    """The file that the address names, else the images of the record's list of files."""
    named = parse_qs(urlsplit(base).query).get("file", [])
    return [OXFORD_FILES + named[0]] if len(named) == 1 and named[0].isdigit() else _different(images.file_list_images(page))


def _psi(page: str, base: str) -> list[str]:
    return _links(page, base, lambda u, _: urlsplit(u).path == "/documents/download" and any(parse_qs(urlsplit(u).query).get("filen", ())))


def _manifest_links(page: str, base: str) -> list[str]:
    found = _links(page, base, lambda u, _: "manifest" in u)
    return sorted(found, key=lambda u: "iiif3" not in u)[:1]


def _by_address(url: str) -> list[str]:
    parts = urlsplit(url)
    return [urlunsplit(("https", parts.netloc, re.sub(r"\.htm\Z", ".jpg", parts.path), "", ""))]


def _scripted(page: str, _base: str) -> list[str]:
    found = re.findall(r"\\?\"originalImageUrl\\?\"\s*:\s*\\?\"(https?:[^\"\\]+(?:\\/[^\"\\]+)*)", page)
    return _different(u for u in (f.replace("\\/", "/") for f in found) if urlsplit(u).scheme == "https" and urlsplit(u).hostname == MET_IMAGES)


def _portal(page: str, base: str) -> list[str]:
    if page.lstrip().startswith("<") and "fileGrp" in page:
        return mets_images(page)
    return _different(urljoin(base, c["metsURL"]) for c in images.embedded_json(page) if isinstance(c, dict) and c.get("metsURL"))


#: The rule of every site whose images follow from a page; those of IIIF sites follow from their manifest.
RULES: dict[str, Callable[[str, str], list[str]]] = {
    "Aphrodito": lambda page, base: images.labelled_links(page, base, "grande image"),
    "BritishMuseum": lambda page, base: images.labelled_links(page, base, "download this image") or _links(page, base, lambda u, _: re.fullmatch(r"/collection/image/\d+/?", urlsplit(u).path) is not None),
    "CairoMuseum": lambda page, base: _links(page, base, lambda u, label: label.casefold() in CAIRO_LABELS and urlsplit(u).hostname == CAIRO and _is_image(u)),
    "Egnet": _egnet,
    "Louvre": lambda page, _: images.record_images(page),
    "MetMuseum": _scripted,
    "Nakala": lambda _, base: [base],
    "ONB": lambda page, _: images.manifest_images(page),
    "Bodleian": lambda page, _: images.manifest_images(page),
    "UniHamburg": lambda page, _: images.manifest_images(page),
    "UMichigan": lambda page, _: images.manifest_images(page),
    "Yale": lambda page, _: images.manifest_images(page),
    "Oxford": _oxford,
    "BerlPap": _berlin,
    "PapyrusPortal": _portal,
    "PSIOnline": _psi,
    "UBHeidelberg": _manifest_links,
    "UniKoeln": lambda page, base: _different(u for u in _after_heading(page, base, "Abbildung:") if _is_image(u)),
    "UCL": lambda page, base: _links(page, base, lambda u, _: _is_image(u)),
    "UCBerkeley": lambda page, _: images.content_urls(page),
    "Warsaw": lambda _, base: _by_address(base),
}


#: Sites whose rule gives further pages before images: what such an address looks like.
LEADS_ON = {"BritishMuseum": re.compile(r"https?://[^/]+/collection/image/\d+/?"), "PapyrusPortal": re.compile(r".*(?i:mets|\.xml)(?:[?#].*)?"), "UBHeidelberg": re.compile(r".*manifest.*")}


def walk(handler: str, address: str, fetch: Callable[[str], str]) -> list[str]:
    """Image addresses of a record: ``fetch`` gives pages and manifests as far as the site's rule leads on, each once."""
    todo, seen, out = [address], {address}, []
    while todo:
        at = todo.pop(0)
        page = fetch(at)
        found = images.manifest_images(page) if handler == "UBHeidelberg" and at != address else RULES[handler](page, at)
        for url in found:
            if (further := LEADS_ON.get(handler)) and further.fullmatch(url) and url not in seen:
                seen.add(url)
                todo.append(url)
            elif url not in seen:
                out.append(url)
    return _different(out)


def image_addresses(handler: Column, page: Column, address: Column) -> Column:
    """Image addresses that a page gives under its site's rule; empty for what can't be read, null for no rule."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(names: pa.Array, pages: pa.Array, bases: pa.Array) -> pa.Array:
        out = []
        for name, text, base in zip(names.to_pylist(), pages.to_pylist(), bases.to_pylist()):
            rule = RULES.get(name)
            try:
                out.append(None if rule is None else rule(text or "", base or ""))
            except (ValueError, KeyError, TypeError, AttributeError, ET.ParseError):
                out.append([])
        return pa.array(out, pa.list_(pa.string()))

    return run(handler, page, address)
