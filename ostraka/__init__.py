"""A PySpark engine for a corpus of XML records and the tables derived from them."""

from ostraka.operators.metadata import catalog, register, table_summary
from ostraka.operators.render import edition_text, render_document, render_edition, render_translation, translation_text
from ostraka.operators.search import MetadataFilter, bm25_search
from ostraka.sources.warehouse import Warehouse

__version__ = "0.2.0"
__all__ = ["MetadataFilter", "Warehouse", "__version__", "bm25_search", "catalog", "edition_text", "register", "render_document", "render_edition", "render_translation", "table_summary", "translation_text"]
