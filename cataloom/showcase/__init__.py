"""Every operator run on the given tables, each beside the SQL that must agree with it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    """Register a query under its function name, with its SQL if there is one."""

    def register(run):
        key = name or run.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = run
        if oracle:
            ORACLES[key] = oracle
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> None:
    from cataloom.showcase import (  # noqa: F401
        analytics,
        cleaning,
        indexed,
        states,
        storage_and_streams,
    )
