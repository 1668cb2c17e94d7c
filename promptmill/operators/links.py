"""Table links of SQL statements: do they only read tables that exist?

A necessary check, not a validity check: syntax, columns and types are not looked at.  Scopes are:
see ``functions.sql_tables``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sql_tables import read_tables
from .skew import join_lookup

#: Table names that are sent to every task; a larger catalog is joined.
MAX_SENT_NAMES = 100_000


def _scanned(sql: Column) -> Column:
    """A struct: whether the statement only reads, and its tables."""

    def scan(statements: pd.Series) -> pd.DataFrame:
        found = [read_tables(s or "") for s in statements]
        return pd.DataFrame({"reads": [r for r, _ in found], "tables": [t for _, t in found]})

    return F.pandas_udf(scan, "reads boolean, tables array<string>")(sql)


def table_names(sql: Column) -> Column:
    """Distinct names of the tables a statement reads, names of common table expressions left out."""
    return _scanned(sql)["tables"]


def _catalog_name(name: Column) -> Column:
    """The last part of a catalog's name; unquoted names fold to lower case."""

    def last(names: pd.Series) -> pd.Series:
        read = (read_tables(f"select 1 from {n}")[1] if n else [] for n in names)
        return pd.Series([t[0] if t else None for t in read])

    return F.pandas_udf(last, "string")(name)


def check_links(statements: DataFrame, catalog: DataFrame, sql: str = "sql", max_sent: int = MAX_SENT_NAMES) -> DataFrame:
    """``(sql, links_ok)`` for every distinct statement, given a catalog with ``table_name``.

    A statement passes when it is a SELECT or WITH and no table it reads is missing.  Statements
    are reduced to distinct ones first.  A catalog of up to ``max_sent`` names goes to the tasks, so
    a statement is read and judged in one place and nothing is shuffled by table.  A larger one is
    joined to the names, hot ones salted.
    """
    distinct = statements.select(F.coalesce(sql, F.lit("")).alias("sql")).distinct()
    known = catalog.select(_catalog_name(F.col("table_name")).alias("table_name")).na.drop().distinct()
    names = [r[0] for r in known.limit(max_sent + 1).collect()]
    if len(names) <= max_sent:
        sent = statements.sparkSession.sparkContext.broadcast(frozenset(names))

        def judge(batch: pd.Series) -> pd.Series:
            found = (read_tables(s) for s in batch)
            return pd.Series([reads and sent.value.issuperset(tables) for reads, tables in found])

        return distinct.select("sql", F.pandas_udf(judge, "boolean")("sql").alias("links_ok"))
    scanned = distinct.select("sql", _scanned(F.col("sql")).alias("s"))
    refs = scanned.select("sql", "s.reads", F.explode_outer("s.tables").alias("table_name"))
    refs = join_lookup(refs, known.withColumn("known", F.lit(True)), "table_name")
    exists = F.col("table_name").isNull() | F.coalesce("known", F.lit(False))
    return refs.groupBy("sql").agg(F.bool_and(F.col("reads") & exists).alias("links_ok"))
