"""Operators that prepare text, pages and vectors for training.

Their Python code runs in Spark's workers, which must be able to import this package: install
it on all nodes or ship it (``--py-files``). ``reachable`` is for sessions on this machine.
"""

import os
from pathlib import Path

from pyspark.sql import SparkSession


def reachable(spark: SparkSession) -> None:
    """Let the session's Python workers look for this package where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))
