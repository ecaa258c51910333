"""Training-corpus pipeline over ``documents``."""

from __future__ import annotations

from lakeloom.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
