"""Document ingestion and ranked retrieval as Spark jobs."""

from foliospark.plans.indexing import IndexSettings, index_standard, index_vector
from foliospark.plans.search import SearchTable, render_results
from foliospark.session import build_session
from foliospark.sinks.catalog import SearchTableCatalog
from foliospark.sinks.store import TableStore

__all__ = [
    "IndexSettings",
    "SearchTable",
    "SearchTableCatalog",
    "TableStore",
    "build_session",
    "index_standard",
    "index_vector",
    "render_results",
]
