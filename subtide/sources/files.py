"""Plain file readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv_source(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Headered CSV for profiling; types are inferred unless a schema is given."""
    if schema is not None:
        return spark.read.csv(path, header=True, schema=schema)
    return spark.read.csv(path, header=True, inferSchema=True)


def read_if_exists(spark: SparkSession, path: str, fmt: str, schema: StructType) -> DataFrame | None:
    """Read a folder, or None when it has not been written yet."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
