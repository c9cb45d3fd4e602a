"""A Parquet table that is upserted by key.

Rows are hashed by their unique key into buckets, one folder per bucket and
write. An upsert rewrites the buckets that hold a replaced key and adds a new
folder to the others, so an insert-only batch rewrites nothing. Which folders
are live is recorded in a small snapshot file per commit, written last: until
then readers see the old state, and a repeated commit overwrites the remains
of the one that failed. One writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.operators.latest import latest_per_key
from subtide.sources.files import read_if_exists

EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"

SNAPSHOT = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("part", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("generation", T.IntegerType()),
        T.StructField("load_id", T.LongType()),
        T.StructField("version", T.IntegerType()),
    ]
)


@dataclass
class State:
    version: int = 0
    tag: str | None = None
    live: dict[int, list[str]] = field(default_factory=dict)
    buckets: int | None = None
    position: tuple[int, int] | None = None


@dataclass
class KeyedTable:
    """Buckets set how finely a table is rewritten.

    A write deals its rows to ``buckets`` times ``files_per_bucket`` shares by
    hash of the key; Spark cuts large shares to the advisory partition size and
    joins small ones, so a task's memory does not grow with the batch. The number
    of buckets belongs to the written table: upserts keep the one it has, and
    ``overwrite`` or ``rebucket`` bring in another. A bucket that has
    ``max_parts`` folders is rewritten into one by the next upsert.
    """

    spark: SparkSession
    path: str
    key: str
    buckets: int = 64
    files_per_bucket: int = 1
    max_parts: int = 16

    def read(self) -> DataFrame | None:
        """Current rows, or None before the first commit."""
        return self._rows(self._state())

    def high_water_mark(self, column: str = "loaded_at"):
        """Greatest value of ``column``, or None for a missing or empty table."""
        rows = self.read()
        return None if rows is None else rows.agg(F.max(column)).first()[0]

    def position(self) -> tuple[int, int] | None:
        """Generation and load that the last commit reached in the landing of its source."""
        return self._state().position

    def upsert(
        self,
        batch: DataFrame,
        tag: str | None = None,
        newest_by: str | None = None,
        position: tuple[int, int] | None = None,
        check: Callable[[], None] | None = None,
    ) -> None:
        """Insert or replace by key. ``batch`` holds each key at most once.

        The later arrival wins, whatever it contains; with ``newest_by`` the
        row with the greater value of that column wins, on a tie the arrival.
        A repeated ``tag`` (the last commit, replayed) is ignored. ``position``
        is committed with the rows; it is kept when none is given. ``check``
        runs when the batch is written; if it raises, nothing is committed.
        """
        state = self._state()
        if tag is not None and tag == state.tag:
            return
        version = state.version + 1
        incoming_part = f"v{version:08d}_in"
        position = position or state.position
        buckets = state.buckets or self.buckets
        touched = self._write(batch, incoming_part, buckets)
        if check is not None:
            check()
        if not touched and position == state.position:
            return
        incoming = {bucket: [incoming_part] for bucket in touched}
        known = {bucket: state.live[bucket] for bucket in touched if bucket in state.live}
        rewrite = {bucket for bucket, parts in known.items() if len(parts) >= self.max_parts}
        if known:
            hits = (
                self._load(known)
                .select(self.key, "bucket")
                .join(self._load(incoming).select(self.key), self.key, "left_semi")
                .select("bucket")
                .distinct()
            )
            rewrite |= {row.bucket for row in hits.collect()}

        live = {bucket: list(parts) for bucket, parts in state.live.items()}
        for bucket in touched:
            live.setdefault(bucket, []).append(incoming_part)
        if rewrite:
            merged_part = f"v{version:08d}_rw"
            new_rows = self._load({bucket: [incoming_part] for bucket in rewrite})
            old_rows = self._load({bucket: known[bucket] for bucket in rewrite})
            if newest_by is None:
                kept = old_rows.join(new_rows.select(self.key), self.key, "left_anti")
                merged = kept.unionByName(new_rows)
            else:
                both = old_rows.withColumn("_arrival", F.lit(0)).unionByName(
                    new_rows.withColumn("_arrival", F.lit(1))
                )
                merged = latest_per_key(both, [self.key], [newest_by, "_arrival"]).drop("_arrival")
            self._write(merged.drop("bucket", "part"), merged_part, buckets)
            live.update({bucket: [merged_part] for bucket in rewrite})
        self._commit(State(version, tag, live, buckets, position))

    def overwrite(
        self,
        batch: DataFrame,
        tag: str | None = None,
        position: tuple[int, int] | None = None,
        check: Callable[[], None] | None = None,
    ) -> None:
        """Replace the whole content; ``check`` as in ``upsert``."""
        version = self._state().version + 1
        part = f"v{version:08d}_in"
        touched = self._write(batch, part, self.buckets)
        if check is not None:
            check()
        self._commit(State(version, tag, {bucket: [part] for bucket in touched}, self.buckets, position))

    def rebucket(self) -> None:
        """Rewrite the table with this object's number of buckets, one folder each."""
        rows, state = self.read(), self._state()
        if rows is not None:
            self.overwrite(rows, state.tag, state.position)

    def _state(self) -> State:
        snapshots = read_if_exists(self.spark, f"{self.path}/snapshots", "json", SNAPSHOT)
        if snapshots is None:
            return State()
        newest = snapshots.agg(F.max("version").alias("version"))
        rows = snapshots.where(F.col("version") == newest.scalar()).collect()
        if not rows:
            return State()
        first = rows[0]
        position = None if first.generation is None else (first.generation, first.load_id)
        state = State(first.version, first.tag, {}, first.buckets, position)
        for row in rows:
            if row.bucket is not None:
                state.live.setdefault(row.bucket, []).append(row.part)
        return state

    def _commit(self, state: State) -> None:
        common = (state.buckets, *(state.position or (None, None)))
        rows = [(state.tag, bucket, part, *common) for bucket, parts in state.live.items() for part in parts]
        snapshot = self.spark.createDataFrame(
            rows or [(state.tag, None, None, *common)],
            "tag string, bucket int, part string, buckets int, generation int, load_id long",
        )
        folder = f"{self.path}/snapshots/version={state.version}"
        snapshot.coalesce(1).write.mode("overwrite").json(folder)

    def _write(self, batch: DataFrame, part: str, buckets: int) -> list[int]:
        """Write rows by bucket; returns the buckets that got any."""
        folder = f"{self.path}/rows/part={part}"
        bucket = F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")
        share = F.pmod(F.hash(self.key), F.lit(self.files_per_bucket))
        shares = (
            batch.withColumns({"bucket": bucket, "_share": share})
            .hint("rebalance", buckets * self.files_per_bucket, "bucket", "_share")
            .drop("_share")
        )
        # An empty batch must run too: what observes it would else see nothing.
        excluded = self.spark.conf.get(EXCLUDED, None)
        self.spark.conf.set(EXCLUDED, ",".join(filter(None, [excluded, "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"])))
        try:
            shares.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        finally:
            self.spark.conf.unset(EXCLUDED) if excluded is None else self.spark.conf.set(EXCLUDED, excluded)
        written = read_if_exists(self.spark, folder, "parquet", T.StructType([T.StructField("bucket", T.IntegerType())]))
        return [] if written is None else [row.bucket for row in written.distinct().collect()]

    def _load(self, live: dict[int, list[str]]) -> DataFrame:
        base = f"{self.path}/rows"
        paths = [f"{base}/part={part}/bucket={bucket}" for bucket, parts in live.items() for part in parts]
        return self.spark.read.option("basePath", base).parquet(*paths)

    def _rows(self, state: State) -> DataFrame | None:
        return self._load(state.live).drop("bucket", "part") if state.live else None
