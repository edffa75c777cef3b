"""The corpus pipeline, from raw documents to token files; see ``sigloom.llm.pipeline``."""

from sigloom.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
