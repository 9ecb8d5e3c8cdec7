"""Language tags: one code for the many spellings of a tag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of languages, by code.
SPELLINGS = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "francais", "français"),
    "it": ("it", "ita", "italian", "italiano"),
    "es": ("es", "spa", "spanish", "espanol", "español"),
    "la": ("la", "lat", "latin"),
    "grc": ("grc", "el", "ell", "gre", "greek"),
    "cop": ("cop", "coptic"),
}
CODES = {spelling: code for code, spellings in SPELLINGS.items() for spelling in spellings}


def code_of(tag: str | None) -> str | None:
    """The code that a tag names: the first subtag, whatever its case; None when it names none."""
    if not tag:
        return None
    parts = tag.strip().lower().replace("_", "-").split("-")
    return CODES.get(parts[0])


def language_code(tag: Column) -> Column:
    """:func:`code_of` as an expression."""
    first = F.substring_index(F.replace(F.lower(F.trim(tag)), F.lit("_"), F.lit("-")), "-", 1)
    pairs = [F.lit(x) for item in CODES.items() for x in item]
    return F.create_map(*pairs)[first]


def edition_language(xml: Column) -> Column:
    """``xml:lang`` of the first edition division, else of the outermost element; null when absent.

    Reads the start tags only, so that a value that is cut off further on still has its language.
    """
    attribute = r"""\bxml:lang\s*=\s*["']\s*([^"']*?)\s*["']"""
    bare = F.regexp_replace(xml, r"(?s)\A(?:\s|<\?.*?\?>|<!--.*?-->)+", "")
    division = F.regexp_extract(bare, r"""<(?:[\w.-]+:)?div\b[^>]*?\btype\s*=\s*["']edition["'][^>]*""", 0)
    outermost = F.regexp_extract(bare, r"\A<[^!?>][^>]*", 0)
    return F.coalesce(F.nullif(F.regexp_extract(division, attribute, 1), F.lit("")), F.nullif(F.regexp_extract(outermost, attribute, 1), F.lit("")))
