"""Row-wise Arrow steps and other helpers that several operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import subtide

#: Arrow batches stay small, because texts may be long.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

#: Bytes of text that a task works on at once.
CHUNK_BYTES = 1 << 20

Compute = Callable[[pa.RecordBatch], list]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare_workers(spark: SparkSession) -> None:
    """Bound the batches, and send this package to the Python workers once per application."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        package = Path(subtide.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="subtide-code-")) / "subtide_code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SENT.add(context.applicationId)


_SENT: set[str] = set()


def without(df: DataFrame, names: list[str]) -> list[T.StructField]:
    """Fields of ``df`` that do not clash with ``names`` (letter case is ignored)."""
    taken = {name.lower() for name in names}
    return [field for field in df.schema.fields if field.name.lower() not in taken]


def _pieces(batch: pa.RecordBatch, text_column: str, chunk_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has a bounded amount of text (or one text)."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // chunk_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def append_columns(
    df: DataFrame, text_column: str, fields: list[T.StructField], start: Callable[[], Compute], keep: list[str] | None = None
) -> DataFrame:
    """Append columns computed from Arrow batches; no row moves.

    ``start`` runs once per task and returns the function that maps a batch to
    the new arrays. Columns of ``df`` that clash with new names give way.
    """
    prepare_workers(df.sparkSession)
    old = [f for f in without(df, [f.name for f in fields]) if keep is None or f.name in keep]
    names = [f.name for f in old]

    def run(batches):
        compute = start()
        for batch in batches:
            for part in _pieces(batch, text_column):
                arrays = [part.column(name) for name in names] + list(compute(part))
                yield pa.RecordBatch.from_arrays(arrays, [*names, *(f.name for f in fields)])

    columns = names if text_column in names else [*names, text_column]
    return df.select(*(F.col(f"`{c}`") for c in columns)).mapInArrow(run, T.StructType([*old, *fields]))


def filter_rows(df: DataFrame, text_column: str, start: Callable[[], Compute]) -> DataFrame:
    """Keep the rows for which the computed mask is true; no row moves."""
    prepare_workers(df.sparkSession)

    def run(batches):
        compute = start()
        for batch in batches:
            for part in _pieces(batch, text_column):
                yield part.filter(pa.array(compute(part)))

    return df.mapInArrow(run, df.schema)


def map_pieces(
    df: DataFrame, text_column: str, schema: T.StructType, start: Callable[[], Callable], chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Rows computed from batches with a bounded amount of text.

    ``start`` runs once per task and returns a function from a batch to new
    batches; at the end of the task it is called once more with None.
    """
    prepare_workers(df.sparkSession)

    def run(batches):
        step = start()
        for batch in batches:
            for part in _pieces(batch, text_column, chunk_bytes):
                yield from step(part)
        yield from step(None)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts of a batch; null is empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of the texts of a batch; null is empty."""
    return [text or b"" for text in batch.column(column).cast(pa.binary()).to_pylist()]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start .. start + length`` of each entry, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def held_out(id_column: str) -> Column:
    """True for the fifth of the documents whose labels are never learned."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def known_labels(labels: DataFrame, label: str, id_column: str, rows: int | None = None) -> DataFrame:
    """``_id, _label`` of every document outside the held-out part that has an id and a label of 0 or 1; of repeated ids one row counts.

    ``rows`` keeps those with the smallest hash of the id, for trials on less; by default there is no bound.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column)).select(
        F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_label")
    )
    known = known.groupBy("_id").agg(F.max("_label").alias("_label"))
    return known if rows is None else known.orderBy(F.xxhash64("_id"), "_id").limit(rows)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, text_column: str, id_column: str, group_column: str | None = None
) -> tuple[list[bytes], list[int], list[str | None]]:
    """Texts, labels and groups (None without a column) of at most ``rows`` labelled documents outside the held-out part, in order of id.

    The bound is that of the training set alone: the rows with the smallest
    hash of the id. Documents without a label or an id are left out; of repeated
    ids one row counts.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column)).select(
        F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_label")
    )
    known = known.groupBy("_id").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    group = F.lit(None) if group_column is None else F.col(group_column)
    texts = docs.select(
        F.col(id_column).alias("_id"),
        F.struct(F.coalesce(text_column, F.lit("")).cast("binary").alias("text"), group.cast("string").alias("group")).alias("_text"),
    )
    # The broadcast side has at most ``rows`` ids and labels. One text of each id is left before rows go to the driver, and
    # grouping runs the scan as one job over all partitions; only the small result is fetched part by part.
    found = texts.join(F.broadcast(known), "_id").groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_label").alias("_label"))
    chosen = sorted(((row[0], bytes(row[1][0]), row[2], row[1][1]) for row in found.toLocalIterator()), key=lambda r: r[0])
    return [r[1] for r in chosen], [r[2] for r in chosen], [r[3] for r in chosen]
