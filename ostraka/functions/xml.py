"""Paths into XML as expressions of the JVM's own XPath; names are met whatever their prefix."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_path(path: str) -> str:
    """A path whose steps ``tei:name`` mean elements of that local name."""
    return re.sub(r"tei:([\w.-]+)", r"*[local-name()='\1']", path)


def select_values(xml: Column, path: str) -> Column:
    """Values of the attributes or texts that a path selects, in order; null for null. Broken XML fails the query."""
    return F.xpath(xml, F.lit(local_path(path)))


def select_truth(xml: Column, path: str) -> Column:
    """Whether a path selects anything, or its expression holds."""
    return F.xpath_boolean(xml, F.lit(local_path(path)))


def select_text(xml: Column, path: str) -> Column:
    """The text of the first node that a path selects, empty where there is none."""
    return F.xpath_string(xml, F.lit(local_path(path)))
