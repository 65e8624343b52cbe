"""Queries op1 to op13 and the pipeline, with their oracle SQL."""

from __future__ import annotations

import corpus_pipeline
from bazaarlens.llm import (q_bpe, q_chat, q_ctph, q_embeddings, q_licenses, q_linededup,
                            q_mixing, q_neardup, q_phrases, q_quality, q_runs, q_secrets,
                            q_toxicity)

_MODULES = (q_secrets, q_mixing, q_bpe, q_linededup, q_embeddings, q_licenses, q_chat, q_quality,
            q_neardup, q_toxicity, q_ctph, q_phrases, q_runs)

QUERIES = {m.NAME: m.query for m in _MODULES} | {"pipeline": corpus_pipeline.run}
ORACLE_SQL = {m.NAME: m.ORACLE for m in _MODULES if m.ORACLE}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
