"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib

import corpus_pipeline

MODULES = ["near_duplicate_queries", "toxicity_queries", "decontamination_queries", "secrets_queries", "packing_queries", "token_files_queries", "token_counts_queries", "top_k_queries", "substrings_queries", "language_model_queries", "whitening_queries", "manifest_queries", "suffixes_queries"]


def load() -> tuple[dict, dict]:
    queries, oracles = {"pipeline": corpus_pipeline.run}, {}
    for name in MODULES:
        m = importlib.import_module(f"addrweave.llm.{name}")
        queries |= m.QUERIES
        oracles |= m.ORACLES
    return queries, oracles
