"""Problem 7: spellings of the names of persons, institutions and ancient writers linked.

A string is taken apart into its core (surname, place of an institution, ancient name), what is given
before or after it, and its kind. Cores are blocked by their suffixes, and by those of their mirror
images, that are at least half as long as they are: one slip leaves one of the two whole. A suffix that
too many cores have is refined by kind and by the letter at the other end before anything is given up,
and what is still common then is compared through one-letter deletions, so that no pair is lost. The
ratio of the longest common subsequence decides. Forenames are compared in the same way; short forms
are told by the evidence of the data. Full names are joined to persons first; a name with only an
initial, or none, joins the one person that it can mean.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.session import cut

#: No suffix is shorter, whatever the length of the token.
SUFFIX = 2
#: Tokens of more letters aren't names; all their suffixes would be as many letters as the square of their length.
LONG = 64
#: Cores of one suffix that are compared pair by pair; more are refined first.
COMMON = 200
#: The ratio that two spellings need: LEAST_RATIO, or more the longer they are, so that about SLIP letters may differ.
#: Of labelled pairs (README), those of one person differ by at most 1.0, those of different ones by 3.0 and more.
SLIP = 1.25
LEAST_RATIO = 0.78
#: A short form of a forename is one that stands beside the full form at that share of its surnames, and at so many.
EVIDENCE_SHARE = 0.75
EVIDENCE_NAMES = 2
#: Of surnames with so many forenames at most the evidence is taken as it is; with others chance is reckoned with.
SELECTIVE = 6
PERSON, INSTITUTION, ANCIENT = "person", "institution", "ancient"
FULL, INITIAL, BARE = 0, 1, 2

# Strings and words that name nobody, titles and notes, words of institutions.
NOBODY = frozenset("various anon anonymous anonymus unknown unbekannt redaktion sammlung redaction editor editors herausgeber diverse varii auctores nn sn na n.n s.n none ignotus incertus team".split())
TITLES = frozenset("prof dr sir mr mrs ms ed eds pr hrsg hg poeta philosophus historicus grammaticus medicus rhetor von und and et the of der die das für fur for de des".split())
INSTITUTES = frozenset("papyrus papyri papyrology papyrologie papyrological institute institut inst institution university universität universitat museum library bibliothek academy akademie seminar department society".split())
# Greek letters in Latin ones.
GREEK = {"α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "y", "φ": "ph", "χ": "ch", "ψ": "ps", "ω": "o"}
TO_LATIN = str.maketrans(GREEK)
PLACE = re.compile(r"(?:ensis|ense|eus)\Z")
TOKEN = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*\.?|,")


def folded(text: str) -> str:
    """Latin letters in lower case without accents; Greek letters become Latin ones, c becomes k."""
    text = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", text).casefold())
    return "".join(c for c in text if not unicodedata.combining(c)).translate(TO_LATIN).replace("c", "k")


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence; the rows of the usual table are bits of one number."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for c in b:
        hits = row & places.get(c, 0)
        row = (row + hits | row - hits) & full
    return len(a) - row.bit_count()


def subsequence_ratio(a: str, b: str) -> float:
    """Twice the length of the longest common subsequence by the sum of the lengths; 1 for two empty strings."""
    return 2 * common_letters(a, b) / (len(a) + len(b)) if a or b else 1.0


def alike(a: str, b: str) -> bool:
    """Whether the ratio of two spellings is that of one name."""
    return subsequence_ratio(a, b) >= max(LEAST_RATIO, 1 - SLIP / max(len(a), len(b), 1))


_VAGUE_WORDS = {folded(w) for w in NOBODY}
_TITLES = {folded(w) for w in TITLES}
_INSTITUTES = {folded(w) for w in INSTITUTES}


def _of_institute(word: str) -> bool:
    return word in _INSTITUTES or len(word) > 6 and any(alike(word, w) for w in _INSTITUTES if len(w) > 6)


@dataclass(frozen=True)
class Name:
    kind: str
    core: str
    given: str = ""
    #: First letters of the given words of a person where all are initials, or of an institution's own words.
    letters: str = ""

    @property
    def level(self) -> int:
        return FULL if self.kind != PERSON or len(self.given) > 1 else INITIAL if self.given else BARE


def parse(text: str | None, ancient: bool = False) -> Name | None:
    """A name taken apart, None when it names nobody."""
    if not text:
        return None
    bare = re.sub(r"\([^)]*\)", " ", text)
    words: list[tuple[str, bool]] = []  # (letters, abbreviated)
    spelled: list[str] = []  # the same with the little words
    comma = None
    for token in TOKEN.findall(re.sub(r"\b([^\W\d_])\.(?=[^\W\d_])", r"\1. ", bare)):
        if token == ",":
            comma = len(words) if comma is None else comma
            continue
        letters = folded(re.sub(r"[-'’.]", "", token))
        if letters:
            spelled.append(letters)
        if letters and letters not in _TITLES:
            words.append((letters, token.endswith(".") or len(letters) == 1))
    if not words or all(w in _VAGUE_WORDS or len(w) == 1 for w, _ in words):
        return None
    if ancient:
        long = [(w, short) for w, short in words if len(w) > 1]
        named = [(w, short) for w, short in long[: comma or None] if not PLACE.search(w)] or long
        core, short = named[0] if comma else max(named, key=lambda x: len(x[0])) if len(named) > 1 and " of " not in bare else named[0]
        core = (core + "os" if short else core).replace("u", "o")  # -us and -os are one ending, also with a slip in it
        return Name(ANCIENT, core)
    if any(_of_institute(w) for w, _ in words):
        rest = [w for w, _ in words if not _of_institute(w)]
        own = "".join(w[0] for w, _ in words if _of_institute(w))
        return Name(INSTITUTION, "".join(rest) or "".join(w for w, _ in words), "", f"{own} {''.join(w[0] for w in spelled if w not in rest)}")
    if comma and 0 < comma < len(words):
        surname, given = "".join(w for w, _ in words[:comma]), words[comma:]
    elif len(words) == 1:
        surname, given = words[0][0], []
    elif len(words[-1][0]) == 1:
        cutoff = next(i for i, (w, _) in enumerate(words) if i and len(w) == 1)
        surname, given = words[cutoff - 1][0], words[cutoff:] if cutoff == 1 else words[: cutoff - 1]
    else:
        surname, given = words[-1][0], words[:-1]
    if len(surname) == 1:
        return None
    initials = "".join(w for w, _ in given) if len(given) > 1 and all(len(w) == 1 for w, _ in given) else ""
    return Name(PERSON, surname, given[0][0] if given else "", initials)


def same_given(a: str, b: str) -> bool:
    """Whether two forenames can be one: equal, one the beginning of the other, or alike."""
    if a == b or min(len(a), len(b)) > 2 and (a.startswith(b) or b.startswith(a)):
        return True
    return min(len(a), len(b)) > 3 and alike(a, b)


def parsed(authors: DataFrame) -> DataFrame:
    """author, kind, core, given, level of every different string that names somebody.

    ``authors`` has author and ancient (boolean). Nulls and strings that name nobody give no rows.
    Initials before the core of an institution are an institution's where the words of some
    institution have these initials and no person of that core has a forename with the first of them.
    """
    different = authors.filter(F.col("author").isNotNull()).groupBy("author").agg(F.min("ancient").alias("ancient"))
    fields = (("author", T.StringType()), ("kind", T.StringType()), ("core", T.StringType()), ("given", T.StringType()), ("letters", T.StringType()), ("level", T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ancient in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = parse(text, ancient)
                if name:
                    rows.append((text, name.kind, name.core, name.given, name.letters, name.level))
            columns = list(zip(*rows)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "level" else pa.string()) for c, (n, _) in zip(columns, fields)], names=[n for n, _ in fields])

    # spread over all cores: the strings are small, and without this the planner would put them into one task
    spread = different.repartition(max(1, authors.sparkSession.sparkContext.defaultParallelism))
    names = cut(spread.mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in fields])))
    institutions = names.filter(F.col("kind") == INSTITUTION)
    acronyms = institutions.select(F.explode(F.split("letters", " ")).alias("letters")).distinct()
    houses = institutions.select("core", F.lit(True).alias("house")).distinct()
    people = names.filter((F.col("kind") == PERSON) & (F.col("level") == FULL)).select("core", F.substring("given", 1, 1).alias("letter"), F.lit(True).alias("someone")).distinct()
    initialed = names.filter((F.col("kind") == PERSON) & (F.col("letters") != "")).join(acronyms, "letters", "left_semi").select("author", "core", F.substring("given", 1, 1).alias("letter"))
    known = initialed.join(houses, "core").join(people, ["core", "letter"], "left").filter("someone is null").select("author", "house")
    house = F.col("house").isNotNull()
    joined = names.join(known, "author", "left")
    return joined.select("author", F.when(house, INSTITUTION).otherwise(F.col("kind")).alias("kind"), "core", F.when(house, "").otherwise(F.col("given")).alias("given"), F.when(house, FULL).otherwise(F.col("level")).alias("level"))


def _pair_filter(test):
    @F.arrow_udf(T.BooleanType())
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([test(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())

    return run


def _deletions(word: str) -> Column:
    """Hashes of a word and of what it is with each one of its letters left out."""
    c, n = F.col(word), F.length(word)
    return F.array_distinct(F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(F.concat(F.substring(c, F.lit(1), i - 1), F.when(i > 0, F.substring(c, i + 1, n)).otherwise(c)))))


def suffixes(word: str) -> Column:
    """The suffixes of a token and of its mirror image, as an array of structs.

    ``end`` is the suffix, marked by the side it is of; ``next`` the letter before it, empty where it is
    the whole token; ``far`` the letter at the other end; ``rest`` how many letters it leaves. A suffix
    has SUFFIX letters at least, and half the token: one letter left out, put in, changed or swapped with
    its neighbour leaves the part before or the part after it whole, and the longer has that length.
    Of tokens over LONG letters only the two suffixes are taken whose lengths are the greatest powers of
    two within that half; ``next`` is the token then, so that all of a block meet.
    """
    c, n = F.col(word), F.length(word)
    half = F.ceil((n - 2) / 2).cast("int")
    power = F.pow(F.lit(2), F.floor(F.log2(half))).cast("int")
    lengths = F.when(n > LONG, F.array(power, (power / 2).cast("int"))).when(n > 0, F.sequence(F.least(n, F.greatest(F.lit(SUFFIX), half)), n)).otherwise(F.array().cast("array<int>"))
    first, last = F.substring(c, 1, 1), F.substring(c, -1, 1)

    def of(i, mark, end, before, far):
        return F.struct(F.concat(F.lit(mark), end).alias("end"), F.when(n > LONG, c).when(i < n, before).otherwise("").alias("next"), far.alias("far"), (n - i).alias("rest"))

    own = F.transform(lengths, lambda i: of(i, ">", F.substring(c, n - i + 1, i), F.substring(c, n - i, F.lit(1)), first))
    mirrored = F.transform(lengths, lambda i: of(i, "<", F.substring(c, F.lit(1), i), F.substring(c, i + 1, F.lit(1)), last))
    return F.concat(own, mirrored)


def _refined(ends: DataFrame, size) -> DataFrame:
    """The members of common suffixes in finer blocks, and in those of their deletions where these are still common."""
    refining = F.explode(F.when(F.col("rest") <= 2, F.array(F.col("far"), F.lit(""))).otherwise(F.array("far")))
    refined = cut(ends.select("kind", "core", "block", "next", refining.alias("by")).select("kind", "core", F.concat("block", F.lit("|"), "by").alias("block"), "next"))
    still = size(refined)
    exact = refined.join(still, ["kind", "block"], "left_semi").select("kind", "core").distinct()
    # every core has another "next" here: all that share a deletion are compared
    spread = exact.select("kind", "core", F.explode(_deletions("core")).alias("block")).select("kind", "core", F.concat(F.lit("="), F.col("block").cast("string")).alias("block"), F.col("core").alias("next"))
    return refined.join(still, ["kind", "block"], "left_anti").unionByName(spread)


def near_cores(names: DataFrame, common: int = COMMON) -> DataFrame:
    """Pairs (kind, core, other, slips) of cores that are the same or alike, both ways.

    Cores meet in the block of the longest suffix that they share, so that a pair comes up once on each
    side. A suffix with more than ``common`` cores is refined by the letter at the other end; those that
    it leaves two letters or fewer, in which the slip may be at that end, also keep a block of their own.
    Cores of a refined block that is still common are compared where they share a one-letter deletion,
    which finds their slips exactly. No block grows beyond its bound, and none is dropped.
    """
    cores = cut(names.select("kind", "core").distinct())
    ends = cores.select("kind", "core", F.explode(suffixes("core")).alias("s")).select("kind", "core", F.col("s.end").alias("block"), "s.next", "s.far", "s.rest")
    size = lambda blocks: blocks.groupBy("kind", "block").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > common).select("kind", "block")
    often = cut(size(ends))
    blocks = ends.select("kind", "core", "block", "next")
    if not often.isEmpty():
        blocks = blocks.join(often, ["kind", "block"], "left_anti").unionByName(_refined(ends.join(often, ["kind", "block"]), size))
    met = blocks.alias("a").join(blocks.alias("b"), ["kind", "block"]).filter("a.core < b.core and a.next <> b.next and abs(length(a.core) - length(b.core)) <= 2")
    pairs = met.select("kind", F.col("a.core").alias("core"), F.col("b.core").alias("other")).distinct()
    found = cut(pairs.filter(_pair_filter(alike)("core", "other")).withColumn("slips", F.lit(1)))
    both = found.unionByName(found.select("kind", F.col("other").alias("core"), F.col("core").alias("other"), "slips"))
    # exploded, not aliased: a checkpoint of a union with one column under two names fails in the planner
    same = cores.select("kind", "core", F.explode(F.array("core")).alias("other")).withColumn("slips", F.lit(0))
    return both.unionByName(same)


def short_forms(people: DataFrame) -> DataFrame:
    """(kind, given, whole): forenames that the data show to be short forms of others.

    ``people`` has kind, core and given, each once. A forename that stands beside the same more frequent
    one under EVIDENCE_SHARE of its cores, and under EVIDENCE_NAMES of them, means it where cores of at
    most SELECTIVE forenames alone show it. Else all cores count, whatever their forenames: they show it
    where less than one such pair is to be expected by chance among all forenames. By chance a forename
    stands beside the n - 1 others of a core as often as its share of all forenames says; that is multiplied
    over the cores, by the ways to choose these among all cores, and by the numbers of more frequent
    forenames and of forenames looked at. Of equally good ones the one less to be expected is taken, then
    the first by letters.
    """
    many = people.groupBy("kind", "core").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    times = people.groupBy("kind", "given").agg(F.count(F.lit(1)).alias("cores"))
    # counted by frequency first: the window is over different frequencies, not over all forenames
    frequencies = times.groupBy("kind", "cores").agg(F.count(F.lit(1)).alias("forenames"))
    kind = Window.partitionBy("kind")
    ranked = frequencies.withColumn("more", F.sum("forenames").over(kind.orderBy(F.desc("cores"))) - F.col("forenames"))
    looked_at = F.sum(F.when((F.col("cores") >= EVIDENCE_NAMES) & (F.col("more") > 0), F.col("forenames")).otherwise(0)).over(kind)
    ranked = ranked.select("kind", "cores", (F.col("more") * looked_at).alias("tried"), F.sum(F.col("cores") * F.col("forenames")).over(kind).alias("people"))
    beside = cut(people.join(many, ["kind", "core"]).join(times.join(ranked, ["kind", "cores"]), ["kind", "given"]))
    whole = beside.select("kind", "core", F.col("given").alias("whole"), F.col("cores").alias("cores_whole"))
    k = F.col("cores")
    least = F.greatest(F.lit(EVIDENCE_NAMES), F.ceil(EVIDENCE_SHARE * k))
    # a whole form is missing at k - least cores at most, so it is met in the half of them that has the fewest forenames;
    # only what is met there often enough is counted in all. 0.45 leaves room for the median, which is approximate
    shorter = beside.filter(k >= EVIDENCE_NAMES)
    halves = shorter.join(shorter.groupBy("kind", "given").agg(F.percentile_approx("n", 0.5).alias("median")), ["kind", "given"]).filter("n <= median")
    met = halves.join(whole, ["kind", "core"]).filter(F.col("cores_whole") > k).groupBy("kind", "given", "whole").agg(F.count(F.lit(1)).alias("met"), F.max("cores").alias("cores"))
    candidates = met.filter(F.col("met") >= 0.45 * k - (k - least)).select("kind", "given", "whole")
    chance = 1 - F.pow(1 - F.col("cores_whole") / F.col("people"), F.col("n") - 1)
    pairs = candidates.join(shorter, ["kind", "given"]).join(whole, ["kind", "core", "whole"])
    together = pairs.groupBy("kind", "given", "whole", "cores", "tried").agg(F.count(F.lit(1)).alias("together"), F.count_if(F.col("n") <= SELECTIVE).alias("plain"), F.sum(F.log(chance)).alias("chances"))
    # logarithm of a factorial by Gosper's formula, without the term that cancels out
    factorial = lambda x: F.when(x > 0, x * F.log(x)).otherwise(0.0) + F.log(math.pi * (2 * x + 1 / 3)) / 2
    ways = factorial(k) - factorial(F.col("together")) - factorial(k - F.col("together"))
    rated = together.filter(F.col("together") >= least).withColumn("expected", F.round(F.col("chances") + ways + F.log("tried"), 6))
    good = rated.filter((F.col("plain") >= least) | (F.col("expected") < 0))
    return good.groupBy("kind", "given").agg(F.min(F.struct((-F.col("together")).alias("o"), "expected", "whole")).alias("w")).select("kind", "given", F.col("w.whole").alias("whole"))


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label): the least node of every connected component; ``edges`` has a and b.

    Labels travel along edges and to the labels of labels, and every round is written to the
    checkpoint folder; a component of diameter d takes about log d rounds.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = cut(nodes.select("node", F.col("node").alias("label")))
    for _ in range(most_rounds):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "node", "left").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jumped = moved.join(labels.select(F.col("node").alias("label"), F.col("label").alias("further")), "label", "left")
        after = cut(jumped.select("node", "old", F.least("label", "further").alias("label")))
        labels = after.select("node", "label")
        if after.filter("old <> label").isEmpty():
            return labels
    raise RuntimeError("components didn't settle")


def link_names(authors: DataFrame, nicknames: DataFrame | None = None) -> DataFrame:
    """(author, entity) of every different string that names somebody; an entity is one of its strings.

    A surname alone or with an initial joins the one entity of its core, or of the nearest core,
    that it can mean; where several can be meant it stays by itself, with equal ones of its initial.
    Short forms of forenames are taken from the data, which must be large enough to show them;
    ``nicknames`` (kind, given, whole, in folded letters) adds some that are known beforehand.
    """
    names = cut(parsed(authors))
    near = cut(near_cores(names))
    full = names.filter(F.col("level") == FULL).withColumn("node", F.concat_ws("\0", "kind", "core", "given"))
    people = cut(full.select("node", "kind", "core", "given").distinct())
    short = short_forms(people.filter("given <> ''"))
    if nicknames is not None:
        short = short.unionByName(nicknames.select("kind", "given", "whole"))
    # forenames meet where they share a suffix, their first three letters, or a whole form; not all with all
    ends = F.transform(suffixes("given"), lambda x: x["end"])
    whole = F.array_compact(F.array(F.concat(F.lit("~"), F.col("given")), F.concat(F.lit("~"), F.col("whole"))))
    keyed = people.join(short, ["kind", "given"], "left").withColumn("key", F.explode(F.array_distinct(F.concat(whole, F.array(F.concat(F.lit("^"), F.left("given", F.lit(3)))), ends)))).drop("whole")
    other = keyed.select("kind", F.col("core").alias("other"), F.col("given").alias("given_b"), F.col("node").alias("b"), "key")
    met = keyed.join(near, ["kind", "core"]).join(other, ["kind", "other", "key"]).filter("node < b")
    once = met.groupBy(F.col("node").alias("a"), "b").agg(F.first("given").alias("given"), F.first("given_b").alias("given_b"), F.bool_or(F.col("key").startswith("~")).alias("sure"))
    edges = once.filter(F.col("sure")).select("a", "b").unionByName(once.filter(~F.col("sure")).filter(_pair_filter(same_given)("given", "given_b")).select("a", "b"))
    labels = components(people.select("node"), edges)
    labelled = cut(full.join(labels, "node"))
    first = labelled.groupBy("label").agg(F.min("author").alias("entity"))
    known = labelled.join(first, "label").select("kind", "core", "given", "author", "entity")
    for level in (INITIAL, BARE):
        known = cut(known)
        partial = names.filter(F.col("level") == level).select("kind", "core", "given", "author")
        # entities of a core (and initial) are put together before names meet them: none, one, or several
        letter = F.substring("given", 1, 1) if level == INITIAL else F.lit("")
        meant = known.withColumn("letter", letter).groupBy("kind", F.col("core").alias("other"), "letter").agg(F.min("entity").alias("low"), F.max("entity").alias("high"))
        wanted = partial.select("kind", "core", "author", (F.col("given") if level == INITIAL else F.lit("")).alias("letter"))
        candidates = wanted.join(near, ["kind", "core"]).join(meant, ["kind", "other", "letter"])
        choice = candidates.groupBy("author").agg(F.min(F.struct("slips", "low")).alias("best"), F.max(F.struct(-F.col("slips"), "high")).alias("last"))
        own = F.concat_ws("\0", "kind", "core", "given")
        several = F.col("best.low") != F.col("last.high")
        settled = partial.join(choice, "author", "left").withColumn("group", F.when(F.col("best").isNull(), own).when(several, F.col("author")))
        first = settled.filter("group is not null").groupBy("group").agg(F.min("author").alias("first"))
        known = known.unionByName(settled.join(first, "group", "left").select("kind", "core", "given", "author", F.coalesce("first", "best.low").alias("entity")))
    return known.select("author", "entity")


def name_pairs(links: DataFrame) -> DataFrame:
    """All pairs of different strings of one entity, the smaller by code points first."""
    links = cut(links)
    return links.select(F.col("author").alias("author_a"), "entity").join(links.select(F.col("author").alias("author_b"), "entity"), "entity").filter("author_a < author_b").select("author_a", "author_b")
