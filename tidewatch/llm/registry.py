"""All queries and check SQL of this subpackage."""

from __future__ import annotations

from tidewatch.llm import alignment, bpe, clusters, exact_dedup, licenses, minhash, mixing, pages, pii, quality, simhash, token_counts, topk

_MODULES = (bpe, quality, mixing, token_counts, exact_dedup, topk, licenses, pii, pages, simhash, minhash, clusters, alignment)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
