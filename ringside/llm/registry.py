"""Queries and checking SQL of the corpus operators, by name."""

from ringside.llm import (
    fingerprints,
    licences,
    merkle,
    mixing,
    near_dedup,
    pieces,
    pii,
    quality,
    repeats,
    signature_join,
    token_counts,
    topk,
    whitening,
)

MODULES = [mixing, fingerprints, repeats, pii, topk, pieces, token_counts, licences, quality, near_dedup, whitening, merkle,
           signature_join]
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in getattr(m, "ORACLES", {}).items()}
