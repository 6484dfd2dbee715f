"""The subpackage's queries and their SQL, gathered from the operator modules."""

from __future__ import annotations

from tessera.llm import bpe, fingerprint, html_text, jaccard, language, license_scan, packing, pii, quality, vectors

_MODULES = (html_text, jaccard, license_scan, quality, language, packing, vectors, bpe, pii, fingerprint)

QUERIES = {}
ORACLES = {}
for _m in _MODULES:
    QUERIES |= _m.QUERIES
    ORACLES |= getattr(_m, "ORACLES", {})
