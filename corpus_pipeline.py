"""The corpus pipeline. Its stages are in ``sightline.llm.stages``."""

from sightline.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
