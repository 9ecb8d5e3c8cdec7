"""Problem 6: free-text place names mapped to the entries of a reference list.

All names of the entries, in every script and with their aliases, are the paths of one trie. A name
is looked up by walking the trie with its Levenshtein automaton (insertion, deletion, substitution,
transposition), so that only paths within a distance that depends on the name's length are entered.
Words of doubt and nearness are taken off before; a damaged or abbreviated name is looked up by
what is left of it. The district named beside a place settles between entries of one name.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most edits by the number of letters of a name: below the first number none, and so on.
EDIT_LENGTHS = (5, 8)
NO_ENTRY = -1
#: Names of a reference list that goes to every task; a longer one is refused, not broadcast.
LIST_NAMES = 1_000_000

# Words that say nothing of which place is meant.
VAGUE = frozenset(
    "near bei in at the same village kome dorf metropolis nome nomos gau de le la du des of mod modern el al city town prope ville stadt "
    "written found egypt aegypt agypten egypte unknown unbekannt inconnu ignoto uncertain na nn sn probably perhaps presumably vielleicht wohl area region".split()
)
SEGMENT = re.compile(r"[,:;()]|\bin the\b")
WORD = re.compile(r"[^\W\d_]+(?:\.{3}[^\W\d_]+)?\.?")


# Coptic letters and the Greek ones that spell the same names.
COPTIC_TO_GREEK = str.maketrans("ⲁⲃⲅⲇⲉⲍⲏⲑⲓⲕⲗⲙⲛⲝⲟⲡⲣⲥⲧⲩⲫⲭⲯⲱϩϥϣς", "αβγδεζηθικλμνξοπρστυφχψωχφσσ")


def folded(text: str) -> str:
    """Letters for comparison: no case, no accents, compatible forms made equal, Coptic in Greek letters."""
    text = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", text).casefold())
    return "".join(c for c in text if not unicodedata.combining(c)).translate(COPTIC_TO_GREEK)


@dataclass(frozen=True)
class Clue:
    """What is left of a name: its letters, and whether it is broken off at ``cut`` or only a beginning."""

    letters: str
    cut: int | None = None
    open: bool = False


def clue(text: str) -> Clue | None:
    """The clue in a piece of text, None when it names nothing."""
    text = folded(text).replace("…", "...")
    text = re.sub(r"\(\s*\?\s*\)|[?\"'“”„‘’«»\[\]<>{}]", " " if "(" in text else "", text)
    text = re.sub(r"\bel-", " ", text)
    words = WORD.findall(text)
    kept = [w for w in words if w.rstrip(".") not in VAGUE]
    if not kept:
        return None
    if len(kept) == 1 and kept[0].strip(".").count("...") == 1:
        head, tail = kept[0].strip(".").split("...")
        return Clue(head + tail, cut=len(head))
    letters = "".join(w.replace(".", "") for w in kept)
    return Clue(letters, open=kept[-1].endswith(".")) if letters else None


class Automaton:
    """The Levenshtein automaton of a word; states are sets of (letters read, edits, waiting for a swap)."""

    def __init__(self, word: str, edits: int):
        self.word, self.edits = word, edits
        self.memo: dict[tuple[frozenset, str], frozenset] = {}
        self.start = self._closed({(0, 0, False)})

    def _closed(self, states: set[tuple[int, int, bool]]) -> frozenset:
        """With deletions; of the states at one letter only the one of fewest edits."""
        best: dict[tuple[int, bool], int] = {}
        for i, e, swap in states:
            for skip in range(0 if swap else self.edits - e, -1, -1):
                if i + skip <= len(self.word) and e + skip <= best.get((i + skip, swap), self.edits):
                    best[i + skip, swap] = e + skip
        return frozenset((i, e, swap) for (i, swap), e in best.items())

    def step(self, state: frozenset, letter: str) -> frozenset:
        found = self.memo.get((state, letter))
        if found is None:
            word, after = self.word, set()
            for i, e, swap in state:
                if swap:
                    if word[i] == letter:
                        after.add((i + 2, e, False))
                    continue
                if i < len(word) and word[i] == letter:
                    after.add((i + 1, e, False))
                if e < self.edits:
                    after.add((i, e + 1, False))
                    if i < len(word):
                        after.add((i + 1, e + 1, False))
                    if i + 1 < len(word) and word[i + 1] == letter:
                        after.add((i, e + 1, True))
            found = self.memo[state, letter] = self._closed(after)
        return found

    def distance(self, state: frozenset) -> int | None:
        return min((e for i, e, swap in state if i == len(self.word) and not swap), default=None)


def most_edits(letters: str) -> int:
    return sum(len(letters) >= n for n in EDIT_LENGTHS)


class Trie:
    """Names as paths; a node is a dict of letters, with the entries that end there under ''."""

    def __init__(self):
        self.root: dict = {}

    def add(self, name: str, entry) -> None:
        node = self.root
        for letter in name:
            node = node.setdefault(letter, {})
        node.setdefault("", set()).add(entry)

    def near(self, word: str, edits: int) -> dict:
        """Entries with a name within so many edits, and their least distance."""
        automaton, out = Automaton(word, edits), {}
        stack = [(self.root, automaton.start)]
        while stack:
            node, state = stack.pop()
            for letter, child in node.items():
                if letter == "":
                    d = automaton.distance(state)
                    if d is not None:
                        for entry in child:
                            out[entry] = min(d, out.get(entry, d))
                else:
                    after = automaton.step(state, letter)
                    if after:
                        stack.append((child, after))
        return out

    def under(self, head: str, tail: str = "", least: int = 0) -> dict:
        """Entries with a name that begins with ``head``, ends with ``tail`` and has more than ``least`` letters."""
        node = self.root
        for letter in head:
            node = node.get(letter)
            if node is None:
                return {}
        out, stack = {}, [(node, head)]
        while stack:
            at, path = stack.pop()
            for letter, child in at.items():
                if letter:
                    stack.append((child, path + letter))
                elif path.endswith(tail) and len(path) > least:
                    out |= dict.fromkeys(child, 0)
        return out


@dataclass(frozen=True)
class Entry:
    id: int
    kind: str
    district: str | None
    names: tuple[str, ...]


def nearest(found: dict) -> dict:
    least = min(found.values(), default=0)
    return {k: d for k, d in found.items() if d == least}


class Gazetteer:
    """The reference list as two tries: of the places and of the districts alone."""

    def __init__(self, entries: Sequence[Entry]):
        self.entries = {e.id: e for e in entries}
        self.all, self.districts = Trie(), Trie()
        for e in entries:
            for name in e.names:
                for variant in (name, *re.split(r" - |;", name)):
                    found = clue(variant)
                    if found:
                        self.all.add(found.letters, e.id)
                        if e.kind == "nome":
                            self.districts.add(found.letters, e.district)
        self._look = lru_cache(maxsize=1 << 16)(self._look_up)
        self.resolve = lru_cache(maxsize=1 << 17)(self._resolve)

    @staticmethod
    def _search(trie: Trie, c: Clue) -> dict:
        if c.cut is not None:
            return trie.under(c.letters[: c.cut], c.letters[c.cut :], len(c.letters))
        if c.open:
            return trie.under(c.letters, "", len(c.letters)) or trie.near(c.letters, most_edits(c.letters))
        return trie.near(c.letters, most_edits(c.letters))

    def _look_up(self, c: Clue, districts: bool) -> dict:
        """All entries (or districts) within the distance that the length allows, with their edits."""
        return self._search(self.districts if districts else self.all, c)

    def within(self, text: str | None) -> dict[int, int]:
        """All entries within the distance that a name's length allows: entry to edits."""
        c = clue(text) if text else None
        return dict(self._look(c, False)) if c else {}

    def _resolve(self, place: str | None, full: str | None) -> tuple[int, int]:
        """(entry, edits) that the two names mean together, (NO_ENTRY, 0) when none or not one only."""
        own = clue(place) if place else None
        places: list[Clue] = []
        districts: set[str] = set()
        pieces = SEGMENT.split(re.sub(r"\A\s*written at\b|\(\s*\?\s*\)|\((?:village|town|city)\)", " ", full or ""))
        clues = [c for c in map(clue, pieces) if c]
        for c in clues:
            here = nearest(self._look(c, True))
            if here and len(clues) > 1 and (own is None or c != own):
                districts |= set(here)
            else:
                places.append(c)
        wanted = ([own] if own else []) + places
        best: dict[int, int] = {}
        for c in wanted:
            found = nearest(self._look(c, False))
            if not found:
                continue
            both = {k: min(d, best[k]) for k, d in found.items() if k in best}
            best = both or best or found
        if districts and best:
            fitting = {k: d for k, d in best.items() if self.entries[k].district in districts}
            if not fitting:
                # a name that is only near, or shared, isn't one of another district
                far = {k for k, d in best.items() if d > 0}
                best = {} if far or len(best) > 1 else best
            else:
                best = fitting
        if len(best) != 1:
            return NO_ENTRY, 0
        return next(iter(best.items()))


def entries_of(geo: DataFrame) -> list[Entry]:
    """The reference list, read whole: a fixed list of places, not a table that grows."""
    out = []
    for r in geo.select("id", "status", "nomos_code", "name_latin", "name_standard", "unicode_greek", "unicode_egyptian", "unicode_coptic", "location").orderBy("id").collect():
        names = tuple(n for n in (r["name_latin"], r["name_standard"], r["unicode_greek"], r["unicode_egyptian"], r["unicode_coptic"], r["location"]) if n and n.strip())
        out.append(Entry(r["id"], r["status"] or "", r["nomos_code"], names))
    return out


def unlinked(df: DataFrame, reference: str, geo: DataFrame) -> DataFrame:
    """Rows whose reference is null or isn't an id of the list."""
    return df.join(geo.select(F.col("id").alias(reference)).distinct(), reference, "left_anti")


def _resolved(names: DataFrame, entries: Sequence[Entry], schema: T.StructType, rows_of) -> DataFrame:
    """``rows_of(gazetteer, *values)`` gives the rows of each row of ``names``, without its own values."""
    own = tuple(entries)
    if sum(len(e.names) for e in own) > LIST_NAMES:
        raise ValueError(f"a list of more than {LIST_NAMES} names doesn't go to every task")
    given = len(names.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = _gazetteer(own)
        for batch in batches:
            values = list(zip(*(c.to_pylist() for c in batch.columns)))
            made = [rows_of(book, *v) for v in values]
            take = pa.array([i for i, rows in enumerate(made) for _ in rows], pa.int64())
            columns = list(zip(*(r for rows in made for r in rows))) or [()] * (len(schema.fields) - given)
            yield pa.RecordBatch.from_arrays([batch.column(i).take(take) for i in range(given)] + [pa.array(c, pa.int32()) for c in columns], names=schema.fieldNames())

    # spread over all cores: names are few and small, and the planner would put them into one task
    return names.repartition(max(1, names.sparkSession.sparkContext.defaultParallelism)).mapInArrow(run, schema)


def map_places(df: DataFrame, key: str, place: str, full: str, entries: Sequence[Entry]) -> DataFrame:
    """The entry that the names of every row mean: key, geo_id (NO_ENTRY for none), edits.

    Null, empty and vague names mean none; so do names that fit several entries. Every different pair
    of names is looked up once. Repeated rows give repeated rows; other columns aren't read.
    """
    if key in ("geo_id", "edits"):
        raise ValueError(f"the key column {key!r} clashes with a column that is made")
    rows = df.select(F.col(key), F.col(place).alias("__place"), F.col(full).alias("__full"))
    fields = [T.StructField("__p", T.StringType()), T.StructField("__f", T.StringType()), T.StructField("geo_id", T.IntegerType()), T.StructField("edits", T.IntegerType())]
    pairs = rows.select(F.col("__place").alias("__p"), F.col("__full").alias("__f")).distinct()
    found = _resolved(pairs, entries, T.StructType(fields), lambda book, p, f: [book.resolve(p, f)])
    return rows.join(found, F.col("__place").eqNullSafe(F.col("__p")) & F.col("__full").eqNullSafe(F.col("__f"))).select(key, "geo_id", "edits")


def entries_within(df: DataFrame, name: str, entries: Sequence[Entry]) -> DataFrame:
    """All entries within the distance of every different name: name, geo_id, edits; names that nothing is near give no row."""
    fields = [T.StructField(name, T.StringType()), T.StructField("geo_id", T.IntegerType()), T.StructField("edits", T.IntegerType())]
    if name in ("geo_id", "edits"):
        raise ValueError(f"the name column {name!r} clashes with a column that is made")
    return _resolved(df.select(name).distinct(), entries, T.StructType(fields), lambda book, n: sorted(book.within(n).items()))


@lru_cache(maxsize=4)
def _gazetteer(entries: tuple[Entry, ...]) -> Gazetteer:
    return Gazetteer(entries)
