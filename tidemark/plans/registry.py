"""Registered queries: each has a name, a Spark plan and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import use_utc

Plan = Callable[[SparkSession, str], DataFrame]
PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under ``name``; times are read in UTC."""

    def add(plan: Plan) -> Plan:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plan(use_utc(spark), folder)

        PLANS[name] = run
        if oracle:
            ORACLES[name] = oracle
        return plan

    return add
