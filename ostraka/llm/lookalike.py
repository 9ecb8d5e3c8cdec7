"""Problem 1: text that looks the same brought to one form.

Every letter has a shape class; a class knows in which scripts its shape exists. The scripts of
all letters of a token are intersected. One or more scripts left: the token is spelled in one of
them (a token of one foreign script whose shapes all exist in the script of the text is such a
whole-script case). None left: a truly mixed token is spelled in the script that has most of its
shapes. Since only classes decide, two strings that look the same get the same form. What isn't a
letter is settled by rules: characters without ink go, blanks become the space, widths and
ligatures are folded, accents are composed.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LATIN, GREEK, CYRILLIC, COPTIC, ARMENIAN = "Latin", "Greek", "Cyrillic", "Coptic", "Armenian"
SCRIPTS = (LATIN, GREEK, CYRILLIC, COPTIC, ARMENIAN)

# Letters of one shape, in the order Latin, Greek, Cyrillic, Coptic, Armenian ("-": no such letter).
SAME_SHAPE = """
A Α А - - | B Β В - - | C Ϲ С Ⲥ - | E Ε Е - - | F Ϝ - - - | H Η Н - - | I Ι І - - | J Ϳ Ј - - | K Κ К - - | L - - - Լ | M Μ М - - | N Ν - - -
O Ο О Ⲟ Օ | P Ρ Р - - | Q - Ԛ - - | S - Ѕ - Տ | T Τ Т - - | U - - - Ս | W - Ԝ - - | X Χ Х - - | Y Υ Ү - - | Z Ζ - - - | - Γ Г - - | - Π П - - | - Φ Ф - -
a - а - - | c ϲ с ⲥ - | d - ԁ - - | e - е - - | g - - - ց | h - һ - հ | i - і - - | j ϳ ј - - | l - ӏ - - | n - - - ո | o ο о ⲟ օ | p - р - - | q - ԛ - զ
s - ѕ - - | u - - - ս | v ν ѵ - - | w - ԝ - - | x - х - - | y - у - - | ɑ α - - - | ı ι - - - | - κ к - - | - ω ѡ - -
"""
# Marks and signs of one shape; the first stands for all.
SAME_SIGN = ("\u2019\u02bc\u1fbd", "\u02b9\u0374\u2032", "\u00b7\u0387\u22c5", "-\u2010\u2011")

CLASSES: dict[str, dict[str, str]] = {}
for _row in SAME_SHAPE.replace("\n", "|").split("|"):
    if _row.strip():
        _members = {s: c for s, c in zip(SCRIPTS, _row.split()) if c != "-"}
        for _c in _members.values():
            CLASSES[_c] = _members

TILDE = "\u0303"
LETTER_RANGES = {
    LATIN: "A-Za-z\u00aa\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u1e00-\u1eff\u2c60-\u2c7f\ua722-\ua787",
    GREEK: "\u0370-\u0373\u0376\u0377\u037b-\u037d\u037f\u0386\u0388-\u03e1\u03f0-\u03ff\u1f00-\u1fbc\u1fbe\u1fc2-\u1fcc\u1fd0-\u1fdb\u1fe0-\u1fec\u1ff2-\u1ffc",
    CYRILLIC: "\u0400-\u0481\u048a-\u052f\u1c80-\u1c88\ua640-\ua66d\ua680-\ua69b",
    ARMENIAN: "\u0531-\u0556\u0561-\u0587",
    COPTIC: "\u03e2-\u03ef\u2c80-\u2ce4\u2ceb-\u2cee\u2cf2\u2cf3",
}
IN_SCRIPT = {s: re.compile(f"[{r}]") for s, r in LETTER_RANGES.items()}
#: Letters whose shape exists in no other script.
IN_ONE = {s: re.compile(f"(?![{''.join(CLASSES)}])[{r}]") for s, r in LETTER_RANGES.items()}
TOKEN = re.compile("(?:[^\\W\\d_][\u0300-\u036f\u0483-\u0487\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]*)+")
VISIBLE_FORMATS = set("\u0600\u0601\u0602\u0603\u0604\u0605\u06dd\u070f\u0890\u0891\u08e2\U000110bd\U000110cd")
LINE_ENDS = "\r\x0b\x0c\x85\u2028\u2029"


def _fold(c: str) -> str | None:
    """What a single character that isn't plain stands for: '' for one without ink, None for itself."""
    category = unicodedata.category(c)
    point = ord(c)
    if c in "\n ":
        return None
    if c in LINE_ENDS:
        return "\n"
    if category == "Zs" or c == "\t":
        return " "
    if category == "Cf" and c not in VISIBLE_FORMATS or category == "Cc" or c in "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0" or 0xFE00 <= point <= 0xFE0F or 0x180B <= point <= 0x180F or 0xE0100 <= point <= 0xE01EF:
        return ""
    tag = unicodedata.decomposition(c).partition(" ")[0]
    if tag in ("<wide>", "<narrow>", "<noBreak>") or 0xFB00 <= point <= 0xFB06:
        return unicodedata.normalize("NFKC", c)
    for signs in SAME_SIGN:
        if c in signs[1:]:
            return signs[0]
    return None


class _Folds(dict):
    """A table for str.translate that finds the fold of a character when it is first met."""

    def __missing__(self, point: int):
        found = _fold(chr(point))
        self[point] = point if found is None else found
        return self[point]


_FOLDS = _Folds()


@lru_cache(maxsize=1 << 18)
def _script(c: str) -> str | None:
    for script, pattern in IN_SCRIPT.items():
        if pattern.match(c):
            return script
    return None


@lru_cache(maxsize=1 << 18)
def scripts_of(c: str) -> frozenset[str]:
    """The scripts in which the shape of a base letter exists; empty for what belongs to none of the four."""
    if c in CLASSES:
        return frozenset(CLASSES[c])
    script = _script(c)
    return frozenset((script,)) if script else frozenset()


@lru_cache(maxsize=1 << 17)
def spell(token: str, dominant: str) -> str:
    """A decomposed token in its consistent script; ``dominant`` is the script of the whole text."""
    sets = [scripts_of(c) for c in token]
    kinds = [s for s in sets if s]
    if not kinds:
        return token
    order = (dominant, *(s for s in SCRIPTS if s != dominant))
    common = frozenset.intersection(*kinds)
    if common:
        script = next(s for s in order if s in common)
    else:
        weight = Counter(s for kind in kinds for s in kind)
        script = max(order, key=lambda s: (weight[s], -order.index(s)))
    out = []
    for c in token:
        members = CLASSES.get(c)
        out.append(c if members is None else members.get(script) or members[next(s for s in order if s in members)])
    if script == GREEK:  # on Greek letters the tilde is the circumflex
        return "".join(out).replace(TILDE, "\u0342")
    return "".join(out)


def dominant_script(decomposed: str) -> str:
    """The script of most letters whose shape exists in one script only; Latin where there is none."""
    weight: Counter[str] = Counter()
    for c, n in Counter(decomposed).items():
        kinds = scripts_of(c)
        if len(kinds) == 1:
            weight[next(iter(kinds))] += n
    return max(SCRIPTS, key=lambda s: (weight[s], -SCRIPTS.index(s)))


def canonical(text: str) -> str:
    """The form of a text that is the same for all texts that look like it.

    Case, accents, breathings, strokes, punctuation, the number of blanks and line breaks stay.
    """
    text = unicodedata.normalize("NFC", text.replace("\r\n", "\n").translate(_FOLDS))
    if text.isascii():
        return text
    present = [s for s in SCRIPTS if IN_SCRIPT[s].search(text)]
    if present in ([], [LATIN]) or len(present) == 1 and IN_ONE[present[0]].search(text) and TILDE not in text:
        return text
    decomposed = unicodedata.normalize("NFD", text)
    dominant = dominant_script(decomposed)
    return unicodedata.normalize("NFC", TOKEN.sub(lambda m: spell(m[0], dominant), decomposed))


@F.arrow_udf(T.StringType())
def _canonical(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else canonical(v) for v in values.to_pylist()], pa.string())


def canonical_text(text: Column) -> Column:
    """:func:`canonical` as an expression: null stays null, the empty text stays empty."""
    return _canonical(text)


def lookalike_forms(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row per value that isn't null: field_name, the key, the form's hash and the value's hash.

    A null key is kept; repeated rows give repeated rows; other columns aren't read.
    """
    stacked = df.select(F.col(key).alias("id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields])).alias("v"))
    values = stacked.select("id", "v.field_name", "v.value").filter(F.col("value").isNotNull())
    return values.select("field_name", "id", F.unhex(F.sha2(canonical_text(F.col("value")), 256)).alias("form"), F.unhex(F.sha2(F.col("value"), 256)).alias("raw"))


def lookalike_pairs(forms: DataFrame) -> DataFrame:
    """Pairs of rows of one field whose values look the same but aren't the same string.

    ``forms`` is read several times and should be written or checkpointed. Different strings of one
    form are paired first, then each pair of strings is expanded to the rows that hold them, so that
    a large group of equal copies costs no more than the pairs that must come out.
    """
    strings = forms.groupBy("field_name", "form", "raw").agg(F.lit(1).alias("one")).drop("one")
    left = strings.select("field_name", "form", F.col("raw").alias("raw_a"))
    right = strings.select("field_name", "form", F.col("raw").alias("raw_b"))
    pairs = left.join(right, ["field_name", "form"]).filter(F.col("raw_a") < F.col("raw_b"))
    rows = forms.select("field_name", "id", "form", "raw")
    first = rows.select("field_name", "form", F.col("raw").alias("raw_a"), F.col("id").alias("a"))
    second = rows.select("field_name", "form", F.col("raw").alias("raw_b"), F.col("id").alias("b"))
    both = pairs.join(first, ["field_name", "form", "raw_a"]).join(second, ["field_name", "form", "raw_b"])
    return both.filter(F.col("a") != F.col("b")).select("field_name", F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))


def lookalike_classes(forms: DataFrame) -> DataFrame:
    """One row for each row of ``forms``: field_name, id, class_id, links.

    A class is the rows of one field whose values look the same; ``class_id`` is its least id (that of
    the row itself where no other looks like it). ``links`` counts the rows of the class that hold
    another string. Classes are counted by string before rows are, so that no group is expanded.
    """
    strings = forms.groupBy("field_name", "form", "raw").agg(F.count(F.lit(1)).alias("own"), F.min("id").alias("least"))
    classes = strings.groupBy("field_name", "form").agg(F.sum("own").alias("every"), F.min("least").alias("class_id"), F.count(F.lit(1)).alias("strings"))
    sized = strings.select("field_name", "form", "raw", "own").join(classes, ["field_name", "form"])
    return forms.join(sized, ["field_name", "form", "raw"]).select("field_name", "id", "class_id", (F.col("every") - F.col("own")).alias("links"))
