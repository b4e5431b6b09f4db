"""Structured Streaming entry points: incremental loading of newly landed rating files."""

from .ratings import (  # noqa: F401
    process_batch,
    rating_stream,
    release_late_ratings,
    start_ratings_stream,
)
