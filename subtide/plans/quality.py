"""Data contracts, column profiles and contract inference."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.operators.lookups import orphans
from subtide.sources.schemas import Contract


def not_null_failures(df: DataFrame, contract: Contract) -> DataFrame:
    """Missing values of every required column, counted in one pass."""
    counts = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in contract.not_null))
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("column_name"), F.col(name).alias("n_failures"))
            for name in contract.not_null
        )
    )
    return counts.select(F.lit(contract.table).alias("table_name"), F.inline(rows))


def unique_failures(df: DataFrame, contract: Contract) -> DataFrame:
    """Values of unique columns that occur more than once."""
    checks = [
        df.where(F.col(name).isNotNull())
        .groupBy(F.col(name).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
        .select(
            F.lit(contract.table).alias("table_name"),
            F.lit(name).alias("column_name"),
            "value",
            "n_records",
        )
        for name in contract.unique
    ]
    return reduce(DataFrame.unionByName, checks)


def accepted_value_failures(df: DataFrame, contract: Contract) -> DataFrame:
    """Values outside the accepted lists; all columns share one pass."""
    found = F.array(
        *(
            F.when(
                F.col(name).isNotNull() & ~F.col(name).isin(*values),
                F.struct(F.lit(name).alias("column_name"), F.col(name).alias("value")),
            )
            for name, values in contract.accepted
        )
    )
    return (
        df.select(F.inline(F.array_compact(found)))
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n_records"))
        .select(F.lit(contract.table).alias("table_name"), "column_name", "value", "n_records")
    )


def reference_failures(df: DataFrame, contract: Contract, tables: dict[str, DataFrame]) -> DataFrame:
    """Values of reference columns that their parent table does not have."""
    checks = [
        orphans(df, name, tables[parent], parent_column).select(
            F.lit(contract.table).alias("table_name"),
            F.lit(name).alias("column_name"),
            F.col("value").cast("string").alias("value"),
            "n_records",
        )
        for name, parent, parent_column in contract.references
    ]
    return reduce(DataFrame.unionByName, checks)


def contract_summary(tables: dict[str, DataFrame], contracts: dict[str, Contract]) -> DataFrame:
    """Failing rows per table, kind of check and column; no row means it holds."""
    parts = []
    for table, contract in contracts.items():
        df = tables[table]
        kinds = [("not_null", not_null_failures(df, contract))] if contract.not_null else []
        if contract.unique:
            kinds.append(("unique", unique_failures(df, contract)))
        if contract.accepted:
            kinds.append(("accepted_values", accepted_value_failures(df, contract)))
        if contract.references:
            kinds.append(("relationships", reference_failures(df, contract, tables)))
        for kind, failures in kinds:
            count = "n_failures" if kind == "not_null" else "n_records"
            parts.append(
                failures.groupBy("table_name", "column_name")
                .agg(F.sum(count).alias("n_failures"))
                .where("n_failures > 0")
                .withColumn("check", F.lit(kind))
            )
    return reduce(DataFrame.unionByName, parts)


# --- contracts observed while writing ----------------------------------------


class ContractViolation(Exception):
    """Rows break a contract, and the caller asked to stop on that."""


FAILURES = "table_name string, column_name string, check string, n_failures long"


@dataclass
class ContractReport:
    """Failures of contracts, one entry per table, column and check that fails.

    With ``stop`` the first table that fails raises ``ContractViolation`` before
    it is committed or published; otherwise failures are only reported.
    """

    stop: bool = False
    rows: list[tuple[str, str, str, int]] = field(default_factory=list)

    def add(self, failures: list[tuple[str, str, str, int]]) -> None:
        self.rows += failures
        if self.stop and failures:
            raise ContractViolation("; ".join(f"{t}.{c}: {n} rows fail {check}" for t, c, check, n in failures))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.rows), FAILURES)


@dataclass
class Observed:
    """A table whose required and accepted values are counted by the job that writes it."""

    contract: Contract
    rows: DataFrame
    seen: Observation | None

    def failures(self) -> list[tuple[str, str, str, int]]:
        """Checks that fail. To be called after the job; no job of its own runs."""
        counts = self.seen.get if self.seen is not None else {}
        found = [(self.contract.table, *key.split("|"), int(n or 0)) for key, n in counts.items()]
        return sorted(f for f in found if f[-1])


def observed(df: DataFrame, contract: Contract) -> Observed:
    """``df`` with counters of the contract's required and accepted values, for one write."""
    counters = [F.count_if(F.col(name).isNull()).alias(f"{name}|not_null") for name in contract.not_null]
    counters += [
        F.count_if(F.col(name).isNotNull() & ~F.col(name).isin(*values)).alias(f"{name}|accepted_values")
        for name, values in contract.accepted
    ]
    if not counters:
        return Observed(contract, df, None)
    seen = Observation(f"contract of {contract.table}")
    return Observed(contract, df.observe(seen, *counters), seen)


def key_failures(tables: dict[str, DataFrame], contracts: dict[str, Contract]) -> list[tuple[str, str, str, int]]:
    """Unique and reference checks that fail: they need groups and joins, on the key columns alone."""
    parts = []
    for table, contract in contracts.items():
        kinds = [("unique", unique_failures(tables[table], contract))] if contract.unique else []
        if contract.references:
            kinds.append(("relationships", reference_failures(tables[table], contract, tables)))
        for check, failures in kinds:
            counted = failures.groupBy("table_name", "column_name").agg(F.sum("n_records").alias("n"))
            parts.append(counted.select("table_name", "column_name", F.lit(check).alias("check"), "n"))
    # One row per declared check at most is left.
    return sorted(tuple(row) for row in reduce(DataFrame.unionByName, parts).collect()) if parts else []


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _as_text(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.VariantType | T.StructType | T.ArrayType | T.MapType):
        return F.to_json(column)
    return column.cast("string")


def value_counts(df: DataFrame) -> DataFrame:
    """Rows per column and value, in long form: one shuffle for all columns."""
    cells = F.array(
        *(
            F.struct(
                F.lit(field.name).alias("column_name"),
                _as_text(field).alias("value"),
                (F.col(field.name).cast("double") if _is_number(field.dataType) else F.lit(None).cast("double")).alias("number"),
            )
            for field in df.schema.fields
        )
    )
    return (
        df.select(F.inline(cells))
        .groupBy("column_name", "value", "number")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def profile(df: DataFrame) -> DataFrame:
    """Per column: missing, distinct and unique values, the top value and number statistics."""
    n, value, number = F.col("n"), F.col("value"), F.col("number")
    present = value.isNotNull()
    filled = F.when(present, n)
    # Exact sums of weighted values would need decimals; statistics are DOUBLE.
    mean = F.sum(number * n) / F.sum(F.when(number.isNotNull(), n))
    top = F.max(F.when(present, F.struct(n, value)))
    return value_counts(df).groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~present, n)), F.lit(0)).alias("n_missing"),
        F.count_if(present).alias("n_distinct"),
        F.count_if(present & (n == 1)).alias("n_unique"),
        F.coalesce(F.sum(F.when(F.trim(value) == "", n)), F.lit(0)).alias("n_blank"),
        F.coalesce(F.sum(F.when(number == 0, n)), F.lit(0)).alias("n_zero"),
        F.coalesce(F.sum(F.when(number < 0, n)), F.lit(0)).alias("n_negative"),
        F.min(number).alias("min_number"),
        F.max(number).alias("max_number"),
        mean.alias("mean_number"),
        F.min(value).alias("min_text"),
        F.max(value).alias("max_text"),
        F.coalesce(F.max(filled), F.lit(0)).alias("top_count"),
        top["value"].alias("top_value"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat another row exactly."""
    texts = [_as_text(field).alias(field.name) for field in df.schema.fields]
    copies = df.select(*texts).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.sum("_copies").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct_rows"),
        F.sum(F.col("_copies") - 1).alias("n_duplicate_rows"),
    )


# Contract name of every Spark type; anything else is text.
CONTRACT_TYPES = {
    "bigint": "integer",
    "int": "integer",
    "smallint": "integer",
    "tinyint": "integer",
    "double": "float",
    "float": "float",
    "string": "varchar",
    "boolean": "boolean",
    "timestamp_ntz": "timestamp_ntz",
    "timestamp": "timestamp_tz",
}


def infer_contract(df: DataFrame, source: str) -> DataFrame:
    """Column, type and the checks that the data satisfies."""
    kinds = F.create_map(
        *(
            F.lit(text)
            for field in df.schema.fields
            for text in (field.name, CONTRACT_TYPES.get(field.dataType.simpleString(), "varchar"))
        )
    )
    seen = value_counts(df).groupBy("column_name").agg(
        F.coalesce(F.max(F.col("value").isNull()), F.lit(False)).alias("nullable"),
        (F.coalesce(F.max(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)) == 1).alias("is_unique"),
    )
    tests = F.concat_ws(
        ",",
        F.when(~F.col("nullable"), "not_null"),
        F.when(F.col("is_unique"), "unique"),
    )
    return seen.select(
        F.lit(f"stg_{source}").alias("model"),
        "column_name",
        kinds[F.col("column_name")].alias("data_type"),
        "nullable",
        "is_unique",
        tests.alias("tests"),
    )
