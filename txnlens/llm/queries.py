"""All registered queries of this subpackage."""

from __future__ import annotations

from txnlens.llm import (  # noqa: F401  (fill the registry)
    corpus_queries,
    dedup_queries,
    model_queries,
    phrase_queries,
    quality_queries,
    secret_queries,
)
from txnlens.llm.registry import ORACLES, QUERIES  # noqa: F401
