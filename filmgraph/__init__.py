"""filmgraph: film catalogue, ratings, tag relevance and film metadata as a property graph in
Spark tables - typed readers, column-expression parsers, per-label vertex/edge tables with
integrity checks, and lookup / search / traversal as DataFrame operations."""

from .session import build_session, configure  # noqa: F401

__version__ = "0.1.0"
