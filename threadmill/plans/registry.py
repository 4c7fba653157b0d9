"""All queries of the curation operators and their DuckDB oracles."""

from __future__ import annotations

from . import manifests, samples, storage, texts

PARTS = (manifests, texts, samples, storage)

QUERIES = {k: q for p in PARTS for k, q in p.QUERIES.items()}
ORACLES = {k: q for p in PARTS for k, q in p.ORACLES.items()}
