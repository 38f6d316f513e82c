"""Sinks and table maintenance: namespaces (A4), audited writes (A3) and row
counts (A11)."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline.sources.tables import TABLE_NAMES, read_table


def ensure_namespace(spark: SparkSession, name: str) -> str:
    """A4: the schema exists afterwards; returns its name."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")
    return name


def publish(spark: SparkSession, namespace: str, table: str, folder: str) -> str:
    """A1/A4: expose a parquet folder under a qualified name of the session's catalog
    (an external table: dropping the name leaves the files).  A name that exists is
    pointed at the folder; it is made anew only where the columns differ."""
    name = f"`{ensure_namespace(spark, namespace)}`.`{table}`"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{_quoted(folder)}'")
    columns = [(f.name, f.dataType) for f in spark.read.parquet(folder).schema]
    if [(f.name, f.dataType) for f in spark.table(name).schema] != columns:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{_quoted(folder)}'")
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(folder)}'")
        spark.catalog.refreshTable(name)
    return name


def publish_source(spark: SparkSession, namespace: str, table: str, folder: str) -> str:
    """``publish`` under a name that carries the folder's digest, so sessions that scan
    different folders never share a name."""
    return publish(spark, namespace, f"{table}_{hashlib.md5(folder.encode()).hexdigest()[:12]}", folder)


def _quoted(folder: str) -> str:
    return folder.replace("\\", "\\\\").replace("'", "\\'")


def write_audit(df: DataFrame, table: str, path: str, dates: tuple[str, ...] = (), namespace: str | None = None) -> DataFrame:
    """A3: write a table (columns ``dates`` as dates), with a namespace also under its
    qualified name, and return its audit row (table_name, n).  The count is observed by
    the write itself; nothing is read again."""
    typed = df.select(*[F.to_date(c).alias(c) if c in dates else F.col(c) for c in df.columns])
    written = Observation()
    typed.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(path, mode="overwrite")
    if namespace:
        publish(df.sparkSession, namespace, table, path)
    return df.sparkSession.createDataFrame([(table, written.get["n"])], "table_name string, n long")


def table_counts(spark: SparkSession, sf: str, names=TABLE_NAMES) -> DataFrame:
    """One ``(table_name, n)`` row per table, as one union plan."""
    counted = [read_table(spark, sf, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n")
               for n in names]
    return reduce(DataFrame.unionByName, counted)
