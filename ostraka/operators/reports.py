"""Reports of profiles: families of aggregates that are small, collected and written as JSON or Markdown."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ostraka.functions import dates
from ostraka.operators import profile


def markdown_code(value: object, most: int = 90) -> str:
    """A value as code in a table cell: one line, bars escaped, cut at a length."""
    text = " ".join(str(value).split()).replace("|", "\\|")
    text = text if len(text) <= most else text[: most - 1] + "…"
    mark = "``" if "`" in text else "`"
    return f"{mark}{text}{mark}"


def _rows(df: DataFrame, shown: int | None) -> list:
    """All rows of a family, which is an aggregate that is read whole, or the first ones where a number is given."""
    return (df if shown is None else df.limit(shown)).collect()


def to_markdown(families: Mapping[str, DataFrame], shown: int | None = None) -> str:
    parts = []
    for title, df in families.items():
        rows = _rows(df, shown)
        parts += [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        parts += ["| " + " | ".join("" if v is None else str(v) if isinstance(v, int | float) else markdown_code(v) for v in r) + " |" for r in rows] + [""]
    return "\n".join(parts)


def to_json(families: Mapping[str, DataFrame], shown: int | None = None) -> str:
    return json.dumps({t: [r.asDict(recursive=True) for r in _rows(df, shown)] for t, df in families.items()}, ensure_ascii=False, indent=2, default=str)


def date_families(orig_dates: DataFrame, records: DataFrame) -> dict[str, DataFrame]:
    """Dates of records: how many a record has, bounds, widths, eras, certainty, and the usual windows."""
    s, e = F.col("not_before_year"), F.col("not_after_year")
    era = F.when(e < 0, "before").when(s > 0, "after").otherwise("across")
    month = F.when(F.col("not_before_day").isNotNull(), "day").when(F.col("not_before_month").isNotNull(), "month").when(s.isNotNull(), "year").otherwise("open")
    by = lambda c, n: orig_dates.groupBy(c.alias(n)).agg(F.count(F.lit(1)).alias("dates"), F.count_distinct("tm_id").alias("records")).orderBy(F.desc("dates"), n)
    return {
        "Dates of a record": profile.cardinality_histogram(records.select("tm_id").distinct(), orig_dates, "tm_id").orderBy("items"),
        "Widths": by(dates.width_bucket(s, e), "width"), "Granularity": by(month, "granularity"), "Era": by(era, "era"), "Certainty": by(F.coalesce("certainty", F.lit("none")), "certainty"),
        "Precision": by(F.coalesce("precision", F.lit("none")), "precision"), "Alternatives": by(F.col("alternative"), "alternative"),
        "Years": orig_dates.agg(F.min(s).alias("first"), F.max(e).alias("last"), F.count_if(s > e).alias("reversed")),
        "101 to 200": profile.date_windows(orig_dates, "tm_id", "not_before_year", "not_after_year", 101, 200),
        "-200 to -101": profile.date_windows(orig_dates, "tm_id", "not_before_year", "not_after_year", -200, -101),
    }


def place_families(orig_places: DataFrame, gazetteer: DataFrame) -> dict[str, DataFrame]:
    """Places of records against the list: coverage by kind, shapes of a record's references, labels, the list itself."""
    scoped = orig_places.withColumn("scope", F.coalesce("place_type", F.lit("none")))
    names = profile.gazetteer_names(gazetteer, ["name_latin", "name_standard", "unicode_greek", "unicode_coptic"])
    labels = profile.label_matches(orig_places.filter("tm_place_id is null"), "place_name", names)
    each = orig_places.groupBy("tm_id").agg(F.count(F.lit(1)).alias("n"), F.count("tm_place_id").alias("with_id"))
    shape = F.when(F.col("with_id") == 0, "none").when(F.col("with_id") == F.col("n"), "all").otherwise("some")
    return {
        "Coverage": profile.place_coverage(scoped, gazetteer, "scope", "tm_place_id").orderBy("scope"),
        "References of a record": each.groupBy(shape.alias("references")).agg(F.count(F.lit(1)).alias("records")).orderBy("references"),
        "Labels without a reference": labels.groupBy("status").agg(F.count(F.lit(1)).alias("labels")).orderBy("status"),
        "Granularity": scoped.groupBy("granularity").agg(F.count(F.lit(1)).alias("places")).orderBy("granularity"),
        "List": gazetteer.groupBy("status").agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.coalesce("coordinates", F.lit("")) != "").alias("with_coordinates"), F.count("begin_date").alias("with_begin")).orderBy("status"),
    }


def inventory_families(records: DataFrame, key: str, xml: str) -> dict[str, DataFrame]:
    """Elements by path, attributes by path, sets of attributes, and what couldn't be read."""
    items = profile.element_inventory(records, key, xml)
    part = lambda kind, *keys: profile.frequency(items.filter(F.col("kind") == kind), key, list(keys), F.col("times")).orderBy(F.desc("documents"), *keys)
    return {"Elements": part("element", "path"), "Attributes": part("attribute", "path", "name"), "Attribute sets": part("attribute_set", "path", "name"), "Errors": part("error", "name")}


def compatibility(found: DataFrame) -> dict[str, int]:
    """Counts of records, transcriptions and translations; a corpus that lacks one of them isn't compatible."""
    row = found.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("source_rank") == 0).alias("hgv_records"), F.count_if(F.col("source_rank") == 1).alias("dclp_records"),
        F.count("transcription_path").alias("transcriptions"), F.coalesce(F.sum(F.size("translation_paths")), F.lit(0)).alias("translations"),
    ).first()
    counts = row.asDict()
    missing = [n for n, v in counts.items() if not v]
    if missing:
        raise ValueError(f"the corpus has no {', '.join(missing)}")
    return counts
