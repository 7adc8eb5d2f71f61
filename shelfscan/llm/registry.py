"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from shelfscan.llm import op1_query, op2_query, op3_query, op4_query, op5_query, op6_query, op7_query, op8_query, op9_query, op10_query, op11_query, op12_query, op13_query

_MODULES = (op1_query, op2_query, op3_query, op4_query, op5_query, op6_query, op7_query, op8_query, op9_query, op10_query, op11_query, op12_query, op13_query)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
    return own | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in _MODULES for name, text in getattr(module, "ORACLE", {}).items()}
