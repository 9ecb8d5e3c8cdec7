"""Scalar functions on text as column expressions, and their plain Python forms where rows need them."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

XML_BLANKS = "[ \\t\\r\\n]+"
#: What ``str.split`` and ``str.strip`` take for blank.
BLANK = r"\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
BLANKS = f"[{BLANK}]+"
#: Words end at white space; a chunk is so many words and the next begins a tenth earlier.
CHUNK_WORDS = 500
#: A sentence ends after one of these, closing quotes included.
SENTENCE_END = re.compile("[.!?;\u037e\u00b7\u0387][\"'\u2019\u201d\u00bb)\\]]*\\Z")
#: Labels of the ancient languages, by first subtag; other tags are their own label.
LANGUAGE_LABELS = {
    "ar": "arabic", "ara": "arabic", "cop": "coptic", "coptic": "coptic", "dem": "demotic", "demotic": "demotic", "egy": "egyptian", "egyptian": "egyptian", "el": "greek", "grc": "greek",
    "greek": "greek", "he": "hebrew", "heb": "hebrew", "hebrew": "hebrew", "la": "latin", "lat": "latin", "latin": "latin", "syr": "syriac", "syc": "syriac", "syriac": "syriac",
}
#: Languages with a lemmatiser, by first subtag.
LEMMA_LANGUAGES = {"cop": "cop", "coptic": "cop", "el": "grc", "grc": "grc", "greek": "grc", "la": "lat", "lat": "lat", "latin": "lat"}


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for item in table.items() for x in item])[key]


def _first_subtag(tag: Column) -> Column:
    return F.substring_index(F.replace(F.lower(F.trim(tag)), F.lit("_"), F.lit("-")), "-", 1)


def xml_normalized(value: Column) -> Column:
    """White space of XML collapsed and trimmed; other blanks stay."""
    return F.trim(F.regexp_replace(value, XML_BLANKS, " "))


def unicode_normalized(value: Column) -> Column:
    """Unicode white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(value, BLANKS, " "))


def stripped(value: Column) -> Column:
    """Without blanks of any kind at its ends."""
    return F.regexp_replace(value, rf"\A{BLANKS}|{BLANKS}\z", "")


def not_blank(value: Column) -> Column:
    """Whether a text holds anything but blanks; null for null."""
    return value.rlike(f"[^{BLANK}]")


def null_if_blank(value: Column) -> Column:
    return F.nullif(stripped(value), F.lit(""))


def without_placeholder(value: Column, *placeholders: str) -> Column:
    """Null for the empty string and for the placeholder words."""
    return F.when(~value.isin("", *placeholders), value)


def normalize_language(tag: Column) -> Column:
    """The language whose lemmatiser serves a tag (cop, grc, lat), else null."""
    return _lookup(LEMMA_LANGUAGES, _first_subtag(tag))


def language_label(tag: Column) -> Column:
    """A readable label: that of the first subtag, else the whole tag in lower case, ``unknown`` when blank."""
    whole = F.replace(F.lower(F.trim(tag)), F.lit("_"), F.lit("-"))
    return F.coalesce(_lookup(LANGUAGE_LABELS, _first_subtag(tag)), F.nullif(whole, F.lit("")), F.lit("unknown"))


def partition_name(identifier: Column) -> Column:
    """The folder of a record: its id without the last three characters, or "0"."""
    return F.coalesce(F.nullif(F.substring(identifier, F.lit(1), F.greatest(F.length(identifier) - 3, F.lit(0))), F.lit("")), F.lit("0"))


@F.arrow_udf(T.StringType())
def _lookup_form(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else " ".join(unicodedata.normalize("NFKC", v).casefold().split()) for v in values.to_pylist()], pa.string())


def normalize_lookup(value: Column) -> Column:
    """Compatible forms made equal, case folded, white space collapsed."""
    return _lookup_form(value)


def split_variants(value: Column) -> Column:
    """The value and its parts at " - " and at ";", trimmed, each once, in order of appearance."""
    parts = F.concat(F.array(value), F.split(value, " - "), F.split(value, ";"))
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""))


def words(text: Column) -> Column:
    """The words of a text: what white space leaves."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def word_chunks(text: Column, size: int = CHUNK_WORDS) -> Column:
    """Windows of ``size`` words that overlap by a tenth; a text within the size stays as it is.

    The last window is the first that reaches the end, so that none holds overlap only.
    """
    if size < 1:
        raise ValueError("the chunk size must be at least 1")
    step = size - size // 10
    every = words(text)
    last = F.ceil((F.size(every) - size) / F.lit(step)).cast("int")
    windows = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(every, i * step + 1, size), " "))
    return F.when(F.size(every) <= size, F.array(text)).otherwise(windows)


def sentence_chunks_of(text: str, max_words: int = 50) -> list[str]:
    """Sentences and lines of a text, none of more than ``max_words`` words."""
    if max_words < 1:
        raise ValueError("max_words must be at least 1")
    out, begin, count, end = [], None, 0, 0
    for m in re.finditer(r"\S+", text):
        if begin is not None and (count == max_words or "\n" in text[end : m.start()] or SENTENCE_END.search(text[begin:end])):
            out.append(text[begin:end])
            begin, count = None, 0
        if begin is None:
            begin = m.start()
        count, end = count + 1, m.end()
    if begin is not None:
        out.append(text[begin:end])
    return out


def sentence_chunks(text: Column, max_words: int = 50) -> Column:
    """:func:`sentence_chunks_of` as an expression; null stays null."""
    if max_words < 1:
        raise ValueError("max_words must be at least 1")

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else sentence_chunks_of(v, max_words) for v in values.to_pylist()], pa.list_(pa.string()))

    return run(text)


#: What parts words: all that is neither letter nor accent nor figure.
NO_WORD = r"[^\p{L}\p{M}\p{N}]+"


def lexemes(text: Column) -> Column:
    """Lower-cased runs of letters, their accents, and figures, in order; composed and decomposed words stay two."""
    return F.filter(F.split(F.lower(text), NO_WORD), lambda w: w != "")


def text_length_bucket(text: Column) -> Column:
    n = F.length(text)
    return F.when(text.isNull() | (n == 0), "empty").when(n <= 100, "1-100").when(n <= 250, "101-250").when(n <= 500, "251-500").otherwise(">500")


def estimated_tokens(text: Column) -> Column:
    """A third of the bytes, rounded up."""
    return F.ceil(F.octet_length(text) / F.lit(3)).cast("bigint")


def target_kind(url: Column) -> Column:
    """What a pointer leads to: papyri.info/biblio, doi, the host of a web address without www., local_fragment or other."""
    host = F.regexp_extract(url, r"^https?://(?:www\.)?([^/]*)", 1)
    return (
        F.when(url.rlike(BIBLIO), "papyri.info/biblio").when(url.contains("doi.org/") | F.lower(url).startswith("doi:"), "doi").when(url.rlike("^https?://"), host)
        .when(url.startswith("#"), "local_fragment").otherwise(F.when(url.isNotNull(), "other"))
    )


def first_match(value: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without one."""
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


#: References in the ``ref`` attributes of names and titles; work ids stand at the start of a reference.
TM_PLACE = r"trismegistos\.org/place/([0-9]+)\b"
PLEIADES = r"pleiades\.stoa\.org/places/([0-9]+)\b"
TM_AUTHORWORK = r"(?:https?://)?(?:www\.)?trismegistos\.org/authorwork/([0-9]+)\b"
PERSEUS_AUTHOR = r"(urn:cts:[^\s]+)"
BIBLIO = r"papyri\.info/biblio/([0-9]+)"


def tm_place_ids(reference: Column) -> Column:
    """All place ids of a reference, in order."""
    return F.transform(F.regexp_extract_all(reference, F.lit(TM_PLACE), F.lit(1)), lambda x: x.cast("int"))


def edition_rank(kind: Column) -> Column:
    """Titles are taken in the order main, abbreviated, any other."""
    return F.when(kind == "main", 0).when(kind == "abbreviated", 1).otherwise(2)
