"""Problem 10: languages of documents and of the stretches within them, by compression.

For every language a raw-content zstandard dictionary is made from a bounded sample of labelled
rows, whose own wrong labels are weeded out by classifying each half with the other half's
dictionaries. A sentence belongs to the language whose dictionary compresses it to the fewest
bytes; where the margin to the next is narrow it is undecided and goes with its neighbours.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.functions.languages import language_code

#: Bound of the fit: labelled rows of each language that are sampled, and the most characters of one.
SAMPLE_ROWS = 250
SAMPLE_CHARS = 6_000
#: Bytes of one dictionary.
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
#: A sentence has at least so many words and letters; less goes with the stretch beside it.
LEAST_WORDS = 5
LEAST_LETTERS = 20
#: The relative margin between the best and the next size below which a sentence is undecided.
MARGIN = 0.02
UNDECIDED = "und"

# The scripts of the languages told apart.
SCRIPT_LANGUAGES = {"latin": ("en", "de", "fr", "it", "es", "la"), "greek": ("grc",), "coptic": ("cop",)}
LANGUAGES = tuple(c for codes in SCRIPT_LANGUAGES.values() for c in codes)
LETTERS = {
    "latin": re.compile("[A-Za-z\u00aa\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u1e00-\u1eff\ufb00-\ufb06\uff21-\uff3a\uff41-\uff5a]+"),
    "greek": re.compile("[\u0370-\u0373\u0376-\u037d\u037f\u0386\u0388-\u03e1\u03f0-\u03ff\u1f00-\u1fff]+"),
    "coptic": re.compile("[\u03e2-\u03ef\u2c80-\u2cff]+"),
}
BOUNDARY = re.compile("[.!?;\u037e\u00b7\u0387\u2026][\"\u00bb\u201d\u2019)\\]]*\\s+|\\n[^\\S\\n]*\\n\\s*")


class _Plain(dict):
    """What a character is in a plain text, found when it is first met: base letters in lower case, or a blank."""

    def __missing__(self, point: int) -> str:
        kept = []
        for c in unicodedata.normalize("NFKD", chr(point).lower()):
            if unicodedata.category(c)[0] != "M":
                kept.append(c.replace("\u03c2", "\u03c3") if c.isalpha() else " ")
        self[point] = found = "".join(kept)
        return found


_PLAIN = _Plain()
_PLAIN[ord("\n")] = "\n"


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans between sentence ends and between paragraphs; together they cover the text but for blanks."""
    out, begin = [], 0
    for m in BOUNDARY.finditer(text):
        end = m.end()
        if text[begin:end].strip():
            out.append((begin, end))
            begin = end
    if text[begin:].strip():
        out.append((begin, len(text)))
    return out


def plain_all(texts: Sequence[str]) -> list[str]:
    """Texts in lower case without accents, figures and signs, words parted by blanks; all in one go."""
    if not texts:
        return []
    return "\n".join([t.replace("\n", " ") for t in texts]).translate(_PLAIN).split("\n")


def plain(text: str) -> str:
    return plain_all([text])[0]


def script_words(text: str) -> tuple[str | None, list[str]]:
    """The script of most letters of a plain text, and the runs of that script."""
    if text.isascii():
        words = text.split()
        return ("latin" if words else None), words
    letters = len(text) - text.count(" ")
    best: tuple[int, str | None, list[str]] = (0, None, [])
    first = text.lstrip()[:1]
    for script in sorted(LETTERS, key=lambda s: not LETTERS[s].match(first)):
        words = LETTERS[script].findall(text)
        n = sum(map(len, words))
        if n > best[0]:
            best = (n, script, words)
            if 2 * n > letters:
                break
    return best[1], best[2]


def script_of(text: str) -> str | None:
    """The script of most letters, None without letters."""
    if text.isascii():
        return "latin" if LETTERS["latin"].search(text) else None
    counts = {s: sum(map(len, p.findall(text))) for s, p in LETTERS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else None


@dataclass(frozen=True)
class LanguageModel:
    """The dictionaries, by language code; a plain value that is sent to the workers."""

    contents: tuple[tuple[str, bytes], ...]

    def sizes(self, texts: Sequence[bytes], code: str) -> list[int]:
        """Compressed bytes of every text under the dictionary of a language."""
        compressor = _compressor(dict(self.contents)[code])
        if len(texts) < 2:
            return [len(compressor.compress(t)) for t in texts]
        found = compressor.multi_compress_to_buffer(list(texts), threads=0)
        return [len(found[i]) for i in range(len(found))]

    def classify(self, texts: Sequence[str], least_words: int = LEAST_WORDS, least_letters: int = LEAST_LETTERS) -> list[tuple[str, float] | None]:
        """(code, margin) of every text, None for one that is too short for a sentence.

        All languages of the text's script compete; a script of one language has the languages of
        the nearest other script as its rivals, so that every margin is one between two sizes.
        """
        out: list[tuple[str, float] | None] = [None] * len(texts)
        by_script: dict[str, list[tuple[int, bytes]]] = {s: [] for s in SCRIPT_LANGUAGES}
        for i, text in enumerate(plain_all(texts)):
            script, words = script_words(text)
            joined = " ".join(words)
            if script and len(words) >= least_words and len(joined) >= least_letters:
                by_script[script].append((i, joined.encode()))
        have = dict(self.contents)
        for script, found in by_script.items():
            codes = [c for c in SCRIPT_LANGUAGES[script] if c in have]
            if not found or not codes:
                continue
            if len(codes) == 1:
                codes += [c for c in ("grc", "cop") if c in have and c not in codes] or [c for c in have if c not in codes][:1]
            items = [t for _, t in found]
            sizes = [self.sizes(items, c) for c in codes]
            for (i, _), row in zip(found, zip(*sizes)):
                order = sorted(range(len(codes)), key=row.__getitem__)
                margin = (row[order[1]] - row[order[0]]) / row[order[1]] if len(order) > 1 else 1.0
                out[i] = (codes[order[0]], margin)
        return out


@lru_cache(maxsize=64)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)


def _filled(items: Sequence[str], room: int) -> list[str]:
    out = []
    for text in items:
        room -= len(text.encode()) + 1
        if room < 0:
            break
        out.append(text)
    return out


def _content(items: Sequence[str], novel: bool = False) -> bytes:
    """Different sentences joined: half the room in the order given, with ``novel`` the other by novelty.

    The novelty of a sentence is its compressed size per byte under the first half.
    """
    items = list(dict.fromkeys(items))
    first = _filled(items, DICTIONARY_BYTES // 2)
    rest = items[len(first) :]
    if rest and novel:
        base = LanguageModel((("", " ".join(first).encode()),))
        raw = [t.encode() for t in rest]
        novelty = [n / (12 + len(t)) for n, t in zip(base.sizes(raw, ""), raw)]
        order = sorted(range(len(rest)), key=lambda i: -novelty[i])
        first = _filled([rest[i] for i in order], DICTIONARY_BYTES // 2) + first
    return " ".join(first).encode()


def _model(samples: dict[str, list[str]], novel: bool = False) -> LanguageModel:
    return LanguageModel(tuple((c, _content(s, novel)) for c, s in samples.items() if s))


def _speaks_for(found: Sequence[tuple[str, float] | None], own: Sequence[str], code: str, pure: bool) -> bool:
    """Whether the sentences of a text belong to its label: by weight, or, ``pure``, none to another."""
    weight: Counter[str] = Counter()
    for t, f in zip(own, found):
        if f:
            weight[f[0]] += f[1] * len(t)
            if pure and f[0] != code and f[1] >= MARGIN:
                return False
    return weight[code] > 0 and max(weight, key=weight.get) == code


def fit_texts(labelled: Sequence[tuple[str, str]]) -> LanguageModel:
    """A model from (code, text) pairs, some of which may be labelled wrongly or mixed.

    Each half is told apart by the other half's dictionaries. Twice the texts are kept that these
    give, as a whole, to their label; then, as the dictionaries grow cleaner, three times those in
    which no other language claims a sentence.
    """
    halves: list[dict[str, list[list[str]]]] = [{}, {}]
    for n, (code, text) in enumerate(sorted(set(labelled))):
        script = next(s for s, codes in SCRIPT_LANGUAGES.items() if code in codes)
        own = []
        for a, b in sentences(text):
            if script_of(text[a:b]) == script:
                joined = " ".join(LETTERS[script].findall(plain(text[a:b])))
                if joined.count(" ") + 1 >= LEAST_WORDS and len(joined) >= LEAST_LETTERS:
                    own.append(joined)
        if own:
            halves[n % 2].setdefault(code, []).append(own)
    kept = halves
    for pure in (False, False, True, True, True):
        models = [_model({code: [t for own in texts for t in own] for code, texts in h.items()}) for h in kept]
        kept = [{}, {}]
        for here, other in ((0, 1), (1, 0)):
            for code, texts in halves[here].items():
                good = [own for own in texts if _speaks_for(models[other].classify(own), own, code, pure)]
                kept[here][code] = good if good and code in dict(models[other].contents) else texts
    samples = [{code: [t for own in texts for t in own] for code, texts in h.items()} for h in kept]
    # one sentence in the samples of several languages is kept where it occurs most
    times = {code: Counter(t for s in samples for t in s.get(code, ())) for code in LANGUAGES}
    samples = [{code: [t for t in s.get(code, ()) if all(times[code][t] > n[t] for c, n in times.items() if c != code)] for code in LANGUAGES} for s in samples]
    merged: dict[str, list[str]] = {}
    for code in LANGUAGES:
        a, b = samples[0].get(code, []), samples[1].get(code, [])
        pairs = [x for p in zip(a, b) for x in p] + a[len(b) :] + b[len(a) :]
        if pairs:
            merged[code] = pairs
    return _model(merged, novel=True)


def fit(df: DataFrame, key: str, text: str, label: str, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """A model from at most ``sample_rows`` labelled rows of each language, chosen by hash of the key.

    The keys are chosen first, without the texts; only the chosen rows' texts reach the driver, those
    over SAMPLE_CHARS left out.
    """
    labelled = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), language_code(F.col(label)).alias("code")).filter(F.col("code").isNotNull())
    place = F.row_number().over(Window.partitionBy("code").orderBy(F.xxhash64("key"), "key"))
    chosen = labelled.select("key", "code").withColumn("place", place).filter(F.col("place") <= sample_rows).select("key").distinct()
    usable = labelled.filter(F.length("text").between(LEAST_LETTERS, SAMPLE_CHARS))
    rows = usable.join(F.broadcast(chosen), "key").orderBy(F.xxhash64("key"), "key").limit(2 * sample_rows * len(LANGUAGES)).collect()
    return fit_texts([(r["code"], r["text"]) for r in rows])


def segments_of(text: str, spans: Sequence[tuple[int, int]], found: Sequence[tuple[str, float] | None]) -> list[tuple[int, int, str, float, int]]:
    """Stretches (start, end, code, confidence, whole sentences) of one language each.

    Sentences that are too short or undecided go with the stretch before them, the first ones with
    the stretch after. A text without a decided sentence is one stretch of its best guess, or
    undecided. The confidence is 1 - exp(-margin / 0.05), averaged over the letters decided.
    """
    out: list[list] = []
    lead = spans[0][0] if spans else 0
    for (a, b), f in zip(spans, found):
        if f is None or f[1] < MARGIN:
            if out:
                out[-1][1] = b
            continue
        if out and out[-1][2] == f[0]:
            last = out[-1]
            last[1], last[4] = b, last[4] + 1
        else:
            out.append([lead if not out else a, b, f[0], 0.0, 1, 0.0])
        out[-1][3] += f[1] * (b - a)
        out[-1][5] += b - a
    if not out and spans:
        guess = max((f for f in found if f), key=lambda f: f[1], default=(UNDECIDED, 0.0))
        out = [[spans[0][0], spans[-1][1], guess[0], guess[1], 0, 1.0]]
    return [(a, b, code, 1 - 2.718281828 ** (-(mass / weight) / 0.05), n) for a, b, code, mass, n, weight in out]


def language_segments(df: DataFrame, keys: Sequence[str], text: str, model: LanguageModel) -> DataFrame:
    """One row per stretch: the keys, segment_no from 1, start, end, lang_code, confidence, sentences.

    A null or blank text has one stretch (0, 0, und, 0.0) without sentences. A text all of whose
    sentences are short is told as a whole, however short. Repeated rows are told apart each on their
    own; other columns aren't read; nothing is shuffled.
    """
    made = (("segment_no", T.IntegerType(), pa.int32()), ("start", T.IntegerType(), pa.int32()), ("end", T.IntegerType(), pa.int32()), ("lang_code", T.StringType(), pa.string()), ("confidence", T.DoubleType(), pa.float64()), ("sentences", T.IntegerType(), pa.int32()))
    keys = list(keys)
    if set(keys) & {m[0] for m in made}:
        raise ValueError(f"key columns clash with {[m[0] for m in made]}")
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(n, t) for n, t, _ in made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = part.column(len(keys)).to_pylist()
                spans = [sentences(t) if t else [] for t in texts]
                found = iter(model.classify([t[a:b] for t, s in zip(texts, spans) for a, b in s]))
                each = [[next(found) for _ in s] for s in spans]
                short = [i for i, f in enumerate(each) if f and not any(f)]
                for i, whole in zip(short, model.classify([texts[i] for i in short], 1, 1)):
                    each[i][0] = whole and (whole[0], min(whole[1], MARGIN / 2))
                at, rows = [], []
                for i, (t, s) in enumerate(zip(texts, spans)):
                    stretches = segments_of(t, s, each[i]) or [(0, 0, UNDECIDED, 0.0, 0)]
                    at += [i] * len(stretches)
                    rows += [(n, *x) for n, x in enumerate(stretches, 1)]
                if rows:
                    take = pa.array(at, pa.int64())
                    columns = [part.column(k).take(take) for k in range(len(keys))] + [pa.array(c, t) for c, (_, _, t) in zip(zip(*rows), made)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keys, *(m[0] for m in made)])

    return df.select(*keys, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def document_languages(segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per document and language: keys, lang_code, letters, sentences, confidence, main.

    ``main`` marks the language of most characters; of equal ones the first by code.
    """
    length = F.col("end") - F.col("start")
    each = segments.groupBy(*keys, "lang_code").agg(
        F.sum(length).alias("letters"), F.sum("sentences").cast("int").alias("sentences"),
        F.coalesce(F.try_divide(F.sum(F.col("confidence") * length), F.sum(length)), F.lit(0.0)).alias("confidence"),
    )
    parts = F.array_sort(F.collect_list(F.struct((-F.col("letters")).alias("order"), "lang_code", "letters", "sentences", "confidence")))
    whole = each.groupBy(*keys).agg(parts.alias("parts"))
    out = whole.select(*keys, F.posexplode("parts").alias("place", "part"))
    return out.select(*keys, "part.lang_code", "part.letters", "part.sentences", "part.confidence", (F.col("place") == 0).alias("main"))


def doubtful_labels(languages: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """(keys, lang_code) of documents without a usable label, with a wrong one, or in several languages.

    One row for each language with at least one whole sentence.
    """
    said = languages.filter(F.col("sentences") > 0)
    parts = said.groupBy(*keys).agg(F.collect_list("lang_code").alias("codes"), F.max(F.when(F.col("main"), F.col("lang_code"))).alias("top"))
    named = language_code(F.col(label))
    wrong = named.isNull() | (F.size("codes") > 1) | ~named.eqNullSafe(F.coalesce("top", F.element_at("codes", 1)))
    return parts.filter(wrong).select(*keys, F.explode("codes").alias("lang_code"))
