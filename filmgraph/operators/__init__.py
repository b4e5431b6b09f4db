"""DataFrame -> DataFrame operators: vertex/edge builders, integrity checks, API answers,
enrichment and the remote fetch."""
