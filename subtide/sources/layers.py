"""Layered tables: one schema per layer, rebuilt as a whole.

A rebuild writes a new version of a table next to the old one and then points
the name ``layer.table``, a view of the catalog, to it in one step. Until then
readers see the old version, whatever becomes of the rebuild. The version before
the current one stays for readers that are still at work; older ones and the
remains of failed rebuilds are removed.

A table may be laid out in buckets of a join key, so that joins of two such
tables need no exchange, or in folders of a month, so that a filter on the month
reads only its folders. Adaptive execution cannot split a hot key of a bucketed
join; leave the buckets out where one key holds a large part of a table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Layout:
    """How a table is written: buckets of a key, folders by a column, or neither."""

    bucket_by: str | None = None
    buckets: int = 64
    partition_by: str | None = None


PLAIN = Layout()


def layer_name(layer: str) -> str:
    """Schema name of a layer: the given name alone, without any prefix."""
    return layer.strip().upper()


def _folder(root: str, layer: str, table: str) -> str:
    return f"{root}/{layer_name(layer)}/{table}"


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _versions(spark: SparkSession, folder: str) -> dict[int, bool]:
    """Numbers of the versions in a folder, and whether each was written to its end."""
    files, path = _file_system(spark, folder)
    if not files.exists(path):
        return {}
    names = (status.getPath().getName() for status in files.listStatus(path))
    numbers = [int(name[1:]) for name in names if re.fullmatch(r"v\d+", name)]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return {n: files.exists(done(f"{folder}/{_version(n)}/_SUCCESS")) for n in numbers}


def _version(number: int) -> str:
    return f"v{number:08d}"


def _table_name(folder: str, table: str, number: int) -> str:
    """Catalog name of one version; the same layer of another root has other names."""
    return f"{table}__{zlib.crc32(folder.encode()):08x}_{_version(number)}"


def _writer(df: DataFrame, layout: Layout):
    if layout.bucket_by:
        # Rows are dealt out as the buckets are, so each bucket is one file.
        writer = df.repartition(layout.buckets, layout.bucket_by).write
        return writer.bucketBy(layout.buckets, layout.bucket_by).sortBy(layout.bucket_by)
    if layout.partition_by:
        # Small months share a task and a large one is cut into several, by measured size.
        return df.hint("rebalance", layout.partition_by).write.partitionBy(layout.partition_by)
    return df.write


def write_table(
    df: DataFrame, root: str, layer: str, table: str, layout: Layout = PLAIN, check: Callable[[], None] | None = None
) -> DataFrame:
    """Rebuild ``layer.table`` and return the version written, with its lineage cut.

    ``check`` runs between writing and publishing; if it raises, the new
    version is removed and the name keeps its old one. One writer of a table at a time is assumed.
    """
    spark, schema, folder = df.sparkSession, layer_name(layer), _folder(root, layer, table)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{root}/{schema}'")
    versions = _versions(spark, folder)
    number = max(versions, default=0) + 1
    name = f"{schema}.{_table_name(folder, table, number)}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _writer(df, layout).format("parquet").option("path", f"{folder}/{_version(number)}").saveAsTable(name)
    if check is not None:
        try:
            check()
        except Exception:
            _remove(spark, schema, folder, table, number)
            raise
    _point(spark, schema, table, name)
    finished = sorted((n for n, done in versions.items() if done), reverse=True)
    for old in versions:
        if old not in finished[:1]:
            _remove(spark, schema, folder, table, old)
    return spark.table(name)


def _point(spark: SparkSession, schema: str, table: str, name: str) -> None:
    """Let ``schema.table`` stand for a version, in one change of the catalog."""
    if spark.catalog.tableExists(f"{schema}.{table}") and spark.catalog.getTable(f"{schema}.{table}").tableType != "VIEW":
        spark.sql(f"DROP TABLE {schema}.{table}")
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.{table} AS SELECT * FROM {name}")


def _remove(spark: SparkSession, schema: str, folder: str, table: str, number: int) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {schema}.{_table_name(folder, table, number)}")
    files, path = _file_system(spark, f"{folder}/{_version(number)}")
    files.delete(path, True)


def read_table(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """The current version of a table of ``root``.

    It comes from the catalog if that knows it, with its buckets; a session with
    another catalog reads the files of the newest version that is complete.
    """
    folder = _folder(root, layer, table)
    finished = [n for n, done in _versions(spark, folder).items() if done]
    name = f"{layer_name(layer)}.{_table_name(folder, table, max(finished, default=0))}"
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.read.parquet(f"{folder}/{_version(max(finished, default=0))}")


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Run SQL over the layers and views."""
    return spark.sql(sql)
