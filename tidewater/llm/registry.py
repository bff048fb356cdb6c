"""What ``__spark_entry__`` adds: the operators' queries and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from tidewater.llm import queries as own


def queries() -> dict:
    return own.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    more = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return own.ORACLE | more
