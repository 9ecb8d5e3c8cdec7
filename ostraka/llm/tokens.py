"""Problem 2: token counts under a given tokenizer, kept in a ledger and summed in cubes.

The ledger is a stored table with one row per content hash and tokenizer. Only contents that it lacks
are encoded, each different one once, and appended. Cubes are kept up to date by signed deltas: minus
what a document gave before, plus what it gives now, so that added, changed and removed documents need
no recount of the rest.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.session import scratch

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Setting that names the folder of a ledger that outlives a job; without it each job has its own in the shared folder.
LEDGER_SETTING = "spark.ostraka.ledger.dir"
#: Figures of the hash by which a ledger is parted: 16 parts to begin with; a corpus of billions takes two or three.
PREFIX_FIGURES = 1
#: Words whose counts one worker remembers at most; then it starts afresh.
MEMO_WORDS = 500_000
#: Texts with such blanks aren't cut at blanks: their blanks don't open a new piece of the pattern.
IRREGULAR = re.compile(r"  | \n|\n |[^\S \n]|\n\n\n|\A\s|\s\Z")


class TokenCounter:
    """Counts tokens of whole texts under a vocabulary of byte-pair ranks.

    A single blank before a word, and a line end, open a new piece of the pattern in any text that
    isn't irregular, so the count of the text is the sum of the counts of its words; those are
    remembered. Irregular texts are encoded as they are.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.line_end = self.exact("\n")
        self._first, self._later = {"": 0}, {"": 0}

    def exact(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def count(self, text: str) -> int:
        if IRREGULAR.search(text):
            return self.exact(text)
        lines = text.split("\n")
        total = self.line_end * (len(lines) - 1)
        first, later = self._first, self._later
        for line in lines:
            words = line.split(" ")
            for memo, part, blank in ((first, words[:1], ""), (later, words[1:], " ")):
                try:
                    total += sum(map(memo.__getitem__, part))
                except KeyError:
                    for word in part:
                        n = memo.get(word)
                        if n is None:
                            n = memo[word] = self.exact(blank + word)
                        total += n
        if len(first) + len(later) > MEMO_WORDS:
            self._first, self._later = {"": 0}, {"": 0}
        return total


@lru_cache(maxsize=4)
def counter(vocabulary: str) -> TokenCounter:
    return TokenCounter(vocabulary)


def tokenizer_hash(vocabulary: str = VOCABULARY) -> str:
    """SHA-256 of the vocabulary file and the pattern."""
    with open(vocabulary, "rb") as f:
        return hashlib.sha256(f.read() + PATTERN.encode()).hexdigest()


def token_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text: null for null, 0 for the empty text."""

    @F.arrow_udf(T.LongType())
    def run(values: pa.Array) -> pa.Array:
        count, seen = counter(vocabulary).count, {}
        out = []
        for v in values.to_pylist():
            if v is not None and v not in seen:
                seen[v] = count(v)
            out.append(None if v is None else seen[v])
        return pa.array(out, pa.int64())

    return run(text)


def content_hash(text: Column) -> Column:
    """SHA-256 of a text as bytes; null for null."""
    return F.unhex(F.sha2(text, 256))


_READS = itertools.count()


class Ledger:
    """The stored count table: content_hash and tokens, parted by tokenizer and by the hash's first figures.

    ``path`` is that of a table that outlives the job; without it, the folder that LEDGER_SETTING names
    is taken, else a new one in the shared folder. Parts of other tokenizers aren't read. Rows are only
    appended: a job that is broken off and run again may append a content twice, with the same count,
    and readers take each content once.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, vocabulary: str = VOCABULARY, prefix_figures: int = PREFIX_FIGURES):
        self.spark, self.vocabulary, self.figures = spark, vocabulary, prefix_figures
        self.path = path or spark.conf.get(LEDGER_SETTING, None) or scratch(spark, "ledger")
        self.tokenizer = tokenizer_hash(vocabulary)

    def exists(self) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/tokenizer_hash={self.tokenizer}")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def counts(self) -> DataFrame:
        """(content_hash, tokens) of every content known under this tokenizer."""
        if not self.exists():
            return self.spark.createDataFrame([], "content_hash binary, tokens bigint")
        # two reads of one folder count as the same plan, also when rows were appended between them; the option tells them apart
        rows = self.spark.read.option("read", next(_READS)).schema("content_hash binary, tokens bigint, tokenizer_hash string, prefix string").parquet(self.path)
        return rows.filter(F.col("tokenizer_hash") == self.tokenizer).groupBy("content_hash").agg(F.max("tokens").alias("tokens"))

    def add(self, texts: DataFrame, text: str) -> None:
        """Encodes the contents of a column that the table lacks, each once, and appends their counts.

        Where the table exists, hashes alone are compared first, and only the texts of unknown ones
        move. Copies of one text are put together before they are shuffled, however many they are.
        """
        given = texts.select(F.col(text).cast("string").alias("text")).filter(F.col("text").isNotNull()).withColumn("content_hash", content_hash(F.col("text")))
        if self.exists():
            unknown = given.select("content_hash").distinct().join(self.counts(), "content_hash", "left_anti")
            given = given.join(unknown, "content_hash", "left_semi")
        different = given.groupBy("content_hash").agg(F.first("text").alias("text"))
        counted = different.select("content_hash", token_count(F.col("text"), self.vocabulary).alias("tokens"), F.lit(self.tokenizer).alias("tokenizer_hash"), F.lower(F.substring(F.hex("content_hash"), 1, self.figures)).alias("prefix"))
        counted.repartition("prefix").write.mode("append").partitionBy("tokenizer_hash", "prefix").parquet(self.path)


def measured(df: DataFrame, key: str, text: str, slices: dict[str, Column], ledger: Ledger) -> DataFrame:
    """A snapshot: key, content_hash, the slice columns, tokens; contents that the ledger lacks are added to it.

    A null text has null hash and 0 tokens. Repeated keys stay. Slice values may be null.
    """
    clash = {"key", "content_hash", "tokens"} & set(slices)
    if clash:
        raise ValueError(f"slices can't be called {sorted(clash)}")
    ledger.add(df, text)
    base = df.select(F.col(key).alias("key"), content_hash(F.col(text).cast("string")).alias("content_hash"), *[c.alias(n) for n, c in slices.items()])
    return base.join(ledger.counts(), "content_hash", "left").select("key", "content_hash", *slices, F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"))


def finest_cells(snapshot: DataFrame, slices: Sequence[str]) -> DataFrame:
    """Documents and tokens of every combination of slices that occurs."""
    return snapshot.groupBy(*slices).agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))


def token_cube(cells: DataFrame, slices: Sequence[str]) -> DataFrame:
    """Documents and tokens of the finest cells and of all coarser ones.

    ``level`` is the grouping id: a bit is set where a slice is summed over (its column is null then).
    """
    return cells.cube(*slices).agg(F.grouping_id().cast("int").alias("level"), F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


def signed_changes(before: DataFrame, after: DataFrame, slices: Sequence[str]) -> DataFrame:
    """What two snapshots differ in: key, change (added, changed, removed), the slices, documents, tokens.

    A document with equal content and slices in both cancels out. An added one gives plus, a removed one
    minus, a changed one both. Repeated keys are counted: of two before and one after, one is removed.
    """
    both = before.select("key", "content_hash", *slices, "tokens", F.lit(-1).alias("sign")).unionByName(after.select("key", "content_hash", *slices, "tokens", F.lit(1).alias("sign")))
    left = both.groupBy("key", "content_hash", *slices).agg(F.sum("sign").alias("documents"), F.max("tokens").alias("each")).filter("documents <> 0")
    own = Window.partitionBy("key")
    plus, minus = F.max(F.col("documents") > 0).over(own), F.max(F.col("documents") < 0).over(own)
    change = F.when(plus & minus, "changed").when(plus, "added").otherwise("removed")
    return left.select("key", change.alias("change"), *slices, "documents", (F.col("documents") * F.col("each")).alias("tokens"))


def cube_delta(changes: DataFrame, slices: Sequence[str]) -> DataFrame:
    """Signed changes summed by finest cell; cells without change are left out."""
    sums = changes.groupBy(*slices).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    return sums.filter((F.col("documents") != 0) | (F.col("tokens") != 0))


def apply_delta(cells: DataFrame, delta: DataFrame, slices: Sequence[str]) -> DataFrame:
    """The finest cells after a delta; cells that end without documents go."""
    columns = [*slices, "documents", "tokens"]
    both = cells.select(columns).unionByName(delta.select(columns))
    return both.groupBy(*slices).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).filter(F.col("documents") != 0)
