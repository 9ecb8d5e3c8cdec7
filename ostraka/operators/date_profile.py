"""Profiles of the dates in records, taken from the adjacency table of their XML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ostraka.functions import dates
from ostraka.operators.xml_shred import entity_table

#: The attributes that date, and the names of their columns.
ATTRIBUTES = {"when": "when", "not_before": "notBefore", "not_after": "notAfter", "when_custom": "when-custom"}
EXAMPLES = 20


def date_entities(nodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each date: keys, node_no, its attributes, xml_id, label and shape."""
    columns = {n: f"@{a}" for n, a in ATTRIBUTES.items()} | {"cert": "@cert", "precision": "@precision", "xml_id": "@id", "label": "text()"}
    found = entity_table(nodes, "origDate", columns, keys)
    return found.withColumn("shape", dates.date_shape(*[F.col(c) for c in ("when", "when_custom", "not_before", "not_after")]))


def date_values(entities: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each dating attribute that is there: keys, node_no, attribute, value, year, granularity, status, era."""
    def of(name: str, attribute: str) -> Column:
        parsed = dates.parse_date(F.col(name), gregorian=name != "when_custom")
        return F.struct(F.lit(attribute).alias("attribute"), F.col(name).alias("value"), parsed["year"].alias("year"), parsed["granularity"].alias("granularity"), parsed["status"].alias("status"))

    each = entities.select(*keys, "node_no", F.explode(F.array(*[of(n, a) for n, a in ATTRIBUTES.items()])).alias("v")).select(*keys, "node_no", "v.*").filter("value is not null")
    era = F.when(F.col("year") < 0, "BCE").when(F.col("year") > 0, "CE").when(F.col("year") == 0, "year zero")
    return each.withColumn("era", era)


def shape_profile(entities: DataFrame, record: str) -> DataFrame:
    """Dates and records of every shape, with how many are marked uncertain or imprecise."""
    return entities.groupBy("shape").agg(F.count(F.lit(1)).alias("dates"), F.count_distinct(record).alias("records"), F.count("cert").alias("with_cert"), F.count("precision").alias("with_precision"), F.count_distinct("label").alias("labels"))


def status_profile(values: DataFrame) -> DataFrame:
    """How the values of every attribute parse: status, granularity, era, first and last year."""
    return values.groupBy("attribute", "status", "granularity", "era").agg(F.count(F.lit(1)).alias("dates"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def anomalies(values: DataFrame, record: str, most: int = EXAMPLES) -> DataFrame:
    """The first examples of every status but valid, by record, date and attribute."""
    order = Window.partitionBy("status").orderBy(record, "node_no", "attribute")
    return values.filter("status <> 'valid'").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).select("status", "place", record, "attribute", "value")


def intervals(entities: DataFrame) -> DataFrame:
    """Entities with start and end year: the exact date's, the custom one's, or the two bounds'."""
    year = lambda c: dates.parse_date(F.col(c))["year"]
    exact = F.when(F.col("when").isNotNull(), year("when")).otherwise(year("when_custom"))
    one = F.col("when").isNotNull() | F.col("when_custom").isNotNull()
    return entities.withColumn("start", F.when(one, exact).otherwise(year("not_before"))).withColumn("end", F.when(one, exact).otherwise(year("not_after")))


def alternatives(spans: DataFrame, record: str) -> DataFrame:
    """Records of several dates: whether all, some or none are identified, repeat their attributes or their years."""
    raw, years = F.struct(*ATTRIBUTES), F.struct("start", "end")
    each = spans.groupBy(record).agg(F.count(F.lit(1)).alias("n"), F.count("xml_id").alias("named"), F.size(F.collect_set(F.to_json(raw))).alias("raw"), F.size(F.collect_set(F.to_json(years))).alias("ranges")).filter("n > 1")
    identified = F.when(F.col("named") == F.col("n"), "all").when(F.col("named") > 0, "some").otherwise("none")
    return each.groupBy(identified.alias("identified")).agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("raw") < F.col("n")).alias("same_attributes"), F.count_if(F.col("ranges") < F.col("n")).alias("same_years"), F.max("n").alias("most_dates"))


def child_annotations(nodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Elements directly in dates, by label and attribute value: how often and in how many records."""
    own = nodes.filter("kind = 'element' and label = 'origDate'").select(*keys, F.col("node_no").alias("__date"))
    children = nodes.filter("kind = 'element'").select(*keys, F.col("parent_no").alias("__date"), "node_no", F.col("label").alias("child"))
    marks = nodes.filter("kind = 'attribute'").select(*keys, F.col("parent_no").alias("node_no"), F.col("label").alias("attribute"), F.col("scalar").alias("value"))
    joined = children.join(own, [*keys, "__date"]).join(marks, [*keys, "node_no"], "left")
    return joined.groupBy("child", "attribute", "value").agg(F.count(F.lit(1)).alias("times"), F.count_distinct(*keys).alias("records"))
