"""Set-up scripts and tables of a database."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def statements(script: str) -> list[str]:
    """A script's statements: cut at semicolons outside of quotes."""
    out, held, quote = [], [], ""
    for c in script:
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        if c == ";" and not quote:
            out.append("".join(held).strip())
            held = []
        else:
            held.append(c)
    return [s for s in [*out, "".join(held).strip()] if s]


def run_scripts(spark: SparkSession, pattern: str, execute: Callable[[str], object] | None = None) -> int:
    """Runs the statements of all scripts that match, in order of their paths; by Spark, or by what is given. How many there were."""
    files = sorted((r["path"], bytes(r["content"]).decode()) for r in spark.read.format("binaryFile").load(pattern).collect())
    every = [s for _, text in files for s in statements(text)]
    for s in every:
        (execute or spark.sql)(s)
    return len(every)


def setup_database(spark: SparkSession, name: str, pattern: str, execute: Callable[[str], object] | None = None) -> int:
    """Makes a schema and runs the scripts that match in it. A schema that is there already is left as it is: 0 statements."""
    if execute is None and spark.catalog.databaseExists(name):
        return 0
    (execute or spark.sql)(f"CREATE SCHEMA {name}")
    (execute or spark.sql)(f"USE {name}")
    return run_scripts(spark, pattern, execute)


def jdbc(spark: SparkSession, table: str, url: str | None = None) -> DataFrame:
    """A table by JDBC. URL, user and password come from JDBC_URL, JDBC_USER and JDBC_PASSWORD."""
    options = {"url": url or os.environ["JDBC_URL"], "dbtable": table, "user": os.environ.get("JDBC_USER", ""), "password": os.environ.get("JDBC_PASSWORD", "")}
    return spark.read.format("jdbc").options(**options).load()
