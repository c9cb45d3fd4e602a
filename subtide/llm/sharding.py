"""Uniform shuffle into shards of exact size.

How many rows go from each partition to each shard is drawn first: a
multivariate hypergeometric matrix with the partition sizes as row sums and the
shard sizes as column sums. Rows are permuted inside their partition and dealt
out by those counts, then permuted again inside their shard. The result has the
law of one uniform permutation of all rows. The matrix is drawn as a tree, for
groups of partitions first and inside each group then, and written as a table
group by group, so that neither the plan nor the driver holds all of it.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from subtide.session import materialized, new_scratch_folder

#: Rows of a shard that are put in order together, on average.
BUCKET_ROWS = 50_000


#: Numbers of the matrix that the driver holds and writes at once.
MATRIX_CELLS = 100_000

#: numpy draws below this many rows; above, the same law is drawn by the ratio of uniforms.
NUMPY_ROWS = 10**9


def draw_good(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """Hypergeometric number of good rows in a sample, for any number of rows."""
    total = good + bad
    if total < NUMPY_ROWS:
        return int(rng.hypergeometric(good, bad, sample))
    low, high = max(0, sample - bad), min(good, sample)
    middle = min(high, max(low, (sample + 1) * (good + 1) // (total + 2)))

    def log_chance(k: int) -> float:
        """Logarithm of the chance of ``k`` over that of the likeliest number, from the ratios of neighbours."""
        j = np.arange(min(k, middle), max(k, middle), dtype=float)
        steps = float(np.log((good - j) * (sample - j) / ((j + 1) * (bad - sample + j + 1))).sum())
        return steps if k > middle else -steps

    mean = sample * good / total
    spread = math.sqrt(mean * bad / total * (total - sample) / (total - 1) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    while True:
        u, v = 1 - rng.random(), rng.random()
        k = math.floor(mean + 0.5 + width * (v - 0.5) / u)
        if low <= k <= high and 2 * math.log(u) <= log_chance(k):
            return k


def _draw_row(rng: np.random.Generator, left: np.ndarray, size: int) -> np.ndarray:
    """Rows of one shard by partition: one partition after the other, given what is left."""
    if left.sum() < NUMPY_ROWS:
        return rng.multivariate_hypergeometric(left, size, method="marginals")
    out, others = np.zeros_like(left), int(left.sum())
    for p, own in enumerate(left.tolist()):
        others -= own
        out[p] = draw_good(rng, own, others, size)
        size -= int(out[p])
    return out


def communication_matrix(partition_rows: list[int], shard_rows: list[int], seed: int | list[int]) -> np.ndarray:
    """Rows that go from each partition (row) to each shard (column)."""
    rng = np.random.default_rng(seed)
    left = np.array(partition_rows, np.int64)
    matrix = np.zeros((len(left), len(shard_rows)), np.int64)
    for shard, size in enumerate(shard_rows):
        matrix[:, shard] = _draw_row(rng, left, size) if len(left) else 0
        left -= matrix[:, shard]
    return matrix


def matrix_blocks(partition_rows: list[int], shard_rows: list[int], seed: int, cells: int = MATRIX_CELLS) -> Iterator[tuple[int, np.ndarray]]:
    """The same law in blocks of at most ``cells`` numbers (one partition at least): first partition and matrix of each.

    Rows of a group of partitions by shard are drawn first. Given these, the
    partitions of the group are independent of all others.
    """
    own = max(1, cells // max(1, len(shard_rows)))
    starts = range(0, len(partition_rows), own)
    groups = communication_matrix([sum(partition_rows[s : s + own]) for s in starts], shard_rows, [seed, 0])
    for n, start in enumerate(starts):
        yield start, communication_matrix(partition_rows[start : start + own], groups[n].tolist(), [seed, 1, n])


def _as_rows(spark, schema: str, rows: list[dict]) -> DataFrame:
    """A table of bounded size that the plan carries as a literal."""
    text = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(text))


def assign(docs: DataFrame, shards: int, seed: int = 1, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``id, size, text_crc32, shard, slot`` of each row.

    Shard counts differ by one at most and slots are gapless from 0. Null
    texts have no bytes; null ids, ties and repeated rows are rows like any
    other; an empty table gives no rows. Only these narrow rows are moved; they
    are written once, so that a lost executor cannot draw anew. Other columns
    of ``docs`` are joined by id where they are needed.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    draw = lambda n: F.xxhash64(F.col(id_column), "text_crc32", "row", F.lit(seed), F.lit(n))
    rows = docs.select(
        F.col(id_column),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("row"),
    ).select("*", draw(1).alias("first"), draw(2).alias("second"))
    rows = materialized(rows, "shuffle")

    counted = sorted(tuple(row) for row in rows.groupBy("part").count().collect())
    total = sum(n for _, n in counted)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    folder = new_scratch_folder(spark, "matrix")
    none = spark.range(0).select(F.col("id").cast("int").alias("part"), F.array("id").alias("ends"))
    none.write.parquet(folder)
    for start, block in matrix_blocks([n for _, n in counted], sizes, seed):
        ends = np.cumsum(block, axis=1).tolist()
        lines = [{"part": p, "ends": e} for (p, _), e in zip(counted[start:], ends)]
        _as_rows(spark, "part:int,ends:array<bigint>", lines).write.mode("append").parquet(folder)
    plan = spark.read.schema(none.schema).parquet(folder)

    # A window holds the narrow rows of one input partition.
    place = F.row_number().over(Window.partitionBy("part").orderBy("first", "row"))
    placed = rows.withColumn("place", place).join(plan, "part")
    shard = F.size(F.filter("ends", lambda end: end < F.col("place"))).cast("int")
    dealt = placed.withColumn("shard", shard).drop("ends", "place", "part", "first")

    # The second permutation: rows go to ranges of their second draw, and are put in order there.
    buckets = max(1, -(-total // (shards * BUCKET_ROWS)))
    bucket = F.pmod(F.shiftrightunsigned("second", 33), F.lit(buckets)).cast("int")
    dealt = materialized(dealt.withColumn("bucket", bucket), "dealt")
    per_bucket = dealt.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("shard", "bucket").orderBy("second", "row")
    slot = F.row_number().over(own)
    return (
        dealt.withColumn("slot", slot)
        .join(starts, ["shard", "bucket"])
        .select(F.col(id_column), "size", "text_crc32", "shard", (F.col("start") + F.col("slot") - 1).alias("slot"))
    )

