"""The corpus pipeline: stages applied one after another to ``documents``."""

from __future__ import annotations

from shelfline.llm.pipeline import STAGES, run  # noqa: F401

#: Tokenisation, trained models and packing have no SQL form; the pipeline is
#: tested stage by stage against brute force (tests/llm/test_pipeline.py).
ORACLE_SQL = None
