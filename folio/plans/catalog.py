"""All registered queries."""

from folio.plans import (  # noqa: F401
    corpus_queries,
    model_queries,
    score_queries,
    source_queries,
    term_queries,
    text_queries,
    vector_queries,
)
from folio.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
