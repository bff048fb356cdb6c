"""All registered queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.plans import (avro_queries, cdc_oracle, cdc_queries, kafka_oracle,
                             kafka_queries, log_oracle, log_queries, stream_queries, text_oracle, text_queries, timed_queries)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(text_queries.QUERIES)
    out.update(cdc_queries.QUERIES)
    out.update(kafka_queries.QUERIES)
    out.update(log_queries.QUERIES)
    out.update(avro_queries.QUERIES)
    out.update(timed_queries.QUERIES)
    out.update(stream_queries.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(text_oracle.ORACLE)
    out.update(cdc_oracle.ORACLE)
    out.update(kafka_oracle.ORACLE)
    out.update(log_oracle.ORACLE)
    out.update(avro_queries.ORACLE)
    for name, same_as in stream_queries.ORACLE_OF.items():
        out[name] = out[same_as]
    return out
