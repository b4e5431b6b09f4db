"""Column -> Column building blocks: text parsing, API-answer fields, search predicates."""

from . import omdb, search, text  # noqa: F401
