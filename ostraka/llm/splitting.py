"""Problem 5: items over a size limit cut at natural boundaries, with a given overlap.

Sizes are in words; a word is a longest run of characters that aren't Unicode white space. A cut
may stand before any word; its penalty is lowest after a sentence that ends a line, then after a
sentence, after a line, after a clause, and highest between other words. Dynamic programming over
the positions takes the cuts with the least sum of penalties and of squared deviations from equal
sizes, with no piece over the limit; every piece but the first begins ``overlap`` words before the
end of the one before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The characters of Unicode White_Space.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same as a pattern of Java's.
SPLIT = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
#: Control characters that aren't white space, though str.split cuts there.
SEPARATORS = re.compile("[\x1c-\x1f]")
WORD = re.compile(f"[^{BLANKS}]+")
SENTENCE_END = re.compile("[.!?;\u037e\u00b7\u0387\u2026]+[\"'\u00bb\u201d\u2019)\\]]*\\Z")
CLAUSE_END = re.compile("[,:\u2014\u2013)]\\Z")
LINE_END = re.compile("[\n\r\x85\u2028\u2029]")
#: Penalties of a cut after: a sentence that ends a line, a sentence, a line, a clause, any other word.
PENALTIES = (0.0, 0.25, 1.0, 4.0, 16.0)
#: Weight of the squared relative deviation of a piece from the equal size.
BALANCE = 1.0


def word_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in WORD.finditer(text)]


def over(text: str | None, limit: int) -> bool:
    """Whether a text has more words than the limit.

    str.split knows the same blanks, but for four control characters that it takes for blanks too.
    """
    if not text or len(text) <= 2 * limit:
        return False
    if SEPARATORS.search(text):
        return sum(1 for _ in WORD.finditer(text)) > limit
    return len(text.split()) > limit


def cut_penalties(text: str, spans: Sequence[tuple[int, int]]) -> np.ndarray:
    """The penalty of a cut before each word; entry 0 and the entry past the last word cost nothing."""
    out = np.zeros(len(spans) + 1)
    for i in range(1, len(spans)):
        begin, end = spans[i - 1]
        line = LINE_END.search(text, end, spans[i][0]) is not None
        tail = text[max(begin, end - 8) : end]
        if SENTENCE_END.search(tail):
            out[i] = PENALTIES[0] if line else PENALTIES[1]
        elif line:
            out[i] = PENALTIES[2]
        else:
            out[i] = PENALTIES[3] if CLAUSE_END.search(tail) else PENALTIES[4]
    return out


def best_cuts(penalties: np.ndarray, limit: int, overlap: int) -> list[int]:
    """Positions of the cuts, from 0 to the number of words, by dynamic programming.

    The first piece holds the words from 0 to its cut; a piece from cut i to cut j holds those from
    i - overlap to j, where i is more than the overlap, so that every piece brings new words.
    Among equal sums the earlier cut is taken. Each position looks back over ``limit`` positions at
    most, so the work is words times limit, whatever the length of the item.
    """
    n = len(penalties) - 1
    if n <= limit:
        return [0, n]
    room = limit - overlap
    pieces = 1 + -(-(n - limit) // room)
    ideal = (n + overlap * (pieces - 1)) / pieces
    # shape[s] is the cost of a piece with s new words; reversed, it lies beside the cuts before j
    sizes = np.arange(room, 0, -1) + overlap
    shape = BALANCE * ((sizes - ideal) / ideal) ** 2
    cost = np.full(n + 1, np.inf)
    back = np.zeros(n + 1, dtype=np.int64)
    for j in range(1, n + 1):
        best, at = (BALANCE * ((j - ideal) / ideal) ** 2, 0) if j <= limit else (np.inf, 0)
        low = max(overlap + 1, j - room)
        if low < j:
            sums = cost[low:j] + shape[room - (j - low) :]
            k = int(sums.argmin())
            if sums[k] < best:
                best, at = sums[k], low + k
        cost[j] = best + penalties[j]
        back[j] = at
    cuts = [n]
    while cuts[-1]:
        cuts.append(int(back[cuts[-1]]))
    return cuts[::-1]


def split_text(text: str, limit: int, overlap: int) -> list[tuple[int, int, str]]:
    """Pieces as (first word, number of words, text); a text within the limit is one untouched piece."""
    spans = word_spans(text)
    if len(spans) <= limit:
        return [(0, len(spans), text)]
    cuts = best_cuts(cut_penalties(text, spans), limit, overlap)
    out = []
    for i, j in zip(cuts, cuts[1:]):
        begin = i - overlap if i else 0
        out.append((begin, j - begin, text[spans[begin][0] : spans[j - 1][1]]))
    return out


def oversized(df: DataFrame, text: str, limit: int = 500) -> DataFrame:
    """The rows whose text has more words than the limit; null and empty texts never have."""
    if limit < 1:
        raise ValueError("the limit must be at least 1")

    @F.arrow_udf(T.BooleanType())
    def run(values: pa.Array) -> pa.Array:
        return pa.array([over(v, limit) for v in values.to_pylist()], pa.bool_())

    return df.filter(F.coalesce(run(F.col(text).cast("string")), F.lit(False)))


def split_oversized(df: DataFrame, text: str, keys: Sequence[str], limit: int = 500, overlap: int = 50) -> DataFrame:
    """Pieces of the rows over the limit: keys, piece_index from 0, first_word, words, piece.

    Rows within the limit give nothing. Repeated rows are split each on their own; drop repeated
    keys before. Columns other than the keys aren't read. The overlap counts towards the limit.
    """
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError("the limit must be at least 1 and the overlap from 0 to below the limit")
    made = ("piece_index", "first_word", "words", "piece")
    if set(made) & set(keys):
        raise ValueError(f"key columns clash with {made}")
    keys = list(keys)
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(n, t) for n, t in zip(made, (T.IntegerType(), T.IntegerType(), T.IntegerType(), T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                at, rows = [], []
                for i, value in enumerate(part.column(part.num_columns - 1).to_pylist()):
                    if over(value, limit):
                        for k, piece in enumerate(split_text(value, limit, overlap)):
                            at.append(i)
                            rows.append((k, *piece))
                if rows:
                    take = pa.array(at, pa.int64())
                    columns = [part.column(k).take(take) for k in range(len(keys))]
                    columns += [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keys, *made])

    return df.select(*keys, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)
