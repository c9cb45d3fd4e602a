"""Landing of JSON-lines files, each file once.

Layout under the landing folder of a source::

    rows/generation=G/load_id=N/valid=true|false/*.parquet
    progress/generation=G/                     (stream checkpoint)
    generations/*.json                         (finished refreshes)

A full refresh fills the next generation, whose empty checkpoint makes it read
every file again. Readers move on to it only when it is complete; a refresh
that failed is resumed by the next one. The source files are never touched.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.sources.files import read_if_exists
from subtide.sources.schemas import LANDING

STORED = T.StructType(
    [
        *LANDING.fields,
        T.StructField("load_id", T.LongType()),
        T.StructField("valid", T.BooleanType()),
    ]
)
#: Age, against the newest file, beyond which Spark would pass over a new file; longer than any source is kept.
MAX_FILE_AGE = "36500d"

GENERATION = T.StructType([T.StructField("generation", T.IntegerType())])


def parse_lines(lines: DataFrame, loaded_at: datetime) -> DataFrame:
    """Landing rows of text lines (``value``, ``file_name``); blank lines vanish."""
    parsed = F.try_parse_json("value")
    return (
        lines.where(F.trim("value") != "")
        .withColumn("raw_data", parsed)
        .select(
            "raw_data",
            F.when(F.col("raw_data").isNull(), F.col("value")).alias("raw_text"),
            "file_name",
            F.lit(loaded_at).cast("timestamp").alias("loaded_at"),
            F.col("raw_data").isNotNull().alias("valid"),
        )
    )


def read_lines(spark: SparkSession, files: str) -> DataFrame:
    """Batch read of JSON-lines files (gzip by extension) with their file name."""
    return spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file_name"))


def current_generation(spark: SparkSession, landing: str) -> int:
    finished = read_if_exists(spark, f"{landing}/generations", "json", GENERATION)
    newest = None if finished is None else finished.agg(F.max("generation")).first()[0]
    return 0 if newest is None else newest


def land_files(
    spark: SparkSession,
    files: str,
    landing: str,
    *,
    full_refresh: bool = False,
    max_files_per_trigger: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> int:
    """Load the files not loaded before; returns the generation they are in.

    Files count by name, not by time, so a file delivered late with an old
    modification time is loaded too, up to ``max_file_age``.

    Every micro-batch writes its own ``load_id`` folder in overwrite mode, so
    a replayed batch replaces what a failed attempt left. Good and broken
    lines are written in one pass over the source.
    """
    generation = current_generation(spark, landing) + (1 if full_refresh else 0)

    def write_batch(lines: DataFrame, batch_id: int) -> None:
        folder = f"{landing}/rows/generation={generation}/load_id={batch_id}"
        rows = parse_lines(lines, datetime.now(timezone.utc))
        rows.write.mode("overwrite").partitionBy("valid").parquet(folder)

    reader = spark.readStream.format("text").option("maxFileAge", max_file_age)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(files).select("value", F.col("_metadata.file_path").alias("file_name"))
    load = (
        lines.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", f"{landing}/progress/generation={generation}")
        .trigger(availableNow=True)
        .start()
    )
    load.awaitTermination()
    if full_refresh:
        finished = spark.createDataFrame([(generation,)], GENERATION)
        finished.coalesce(1).write.mode("append").json(f"{landing}/generations")
    return generation


def _rows(spark: SparkSession, landing: str, valid: bool, columns: list[str]) -> DataFrame:
    folder = f"{landing}/rows/generation={current_generation(spark, landing)}"
    stored = read_if_exists(spark, folder, "parquet", STORED)
    if stored is None:
        stored = spark.createDataFrame([], STORED)
    return stored.where(F.col("valid") == valid).select(*columns)


def last_load(spark: SparkSession, landing: str) -> int:
    """Number of the last load of the current generation, -1 before the first."""
    folder = f"{landing}/rows/generation={current_generation(spark, landing)}"
    stored = read_if_exists(spark, folder, "parquet", STORED)
    newest = None if stored is None else stored.agg(F.max("load_id")).first()[0]
    return -1 if newest is None else newest


def landed(
    spark: SparkSession, landing: str, after: datetime | None = None, loads: tuple[int, int] | None = None
) -> DataFrame:
    """Parsed rows of the current generation, optionally only later ones.

    ``loads`` gives the last load to leave out and the last to take; only the
    folders of the loads between are read.
    """
    columns = ["raw_data", "file_name", "loaded_at"]
    rows = _rows(spark, landing, True, [*columns, "load_id"])
    if loads is not None:
        rows = rows.where((F.col("load_id") > loads[0]) & (F.col("load_id") <= loads[1]))
    return newer_than(rows.select(*columns), after)


def quarantined(spark: SparkSession, landing: str) -> DataFrame:
    """Lines that are not JSON."""
    return _rows(spark, landing, False, ["raw_text", "file_name", "loaded_at"])


def newer_than(rows: DataFrame, mark: datetime | None, column: str = "loaded_at") -> DataFrame:
    """Rows beyond a high-water mark; all rows when there is no mark yet.

    The mark is a literal, so Parquet statistics skip files that are older.
    """
    return rows if mark is None else rows.where(F.col(column) > F.lit(mark).cast("timestamp"))
