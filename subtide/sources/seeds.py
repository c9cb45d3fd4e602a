"""Reference lists: countries and legal company suffixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COUNTRY_SCHEMA = "country_name string, iso_code string"
SUFFIX_SCHEMA = "suffix string"

# Default country list.
COUNTRIES = (
    ("Australia", "AU"),
    ("Brazil", "BR"),
    ("Canada", "CA"),
    ("Denmark", "DK"),
    ("France", "FR"),
    ("Germany", "DE"),
    ("India", "IN"),
    ("Italy", "IT"),
    ("Japan", "JP"),
    ("Mexico", "MX"),
    ("Netherlands", "NL"),
    ("Norway", "NO"),
    ("Poland", "PL"),
    ("Singapore", "SG"),
    ("South Korea", "KR"),
    ("Spain", "ES"),
    ("Sweden", "SE"),
    ("Switzerland", "CH"),
    ("United Kingdom", "GB"),
    ("United States of America", "US"),
)

# Default legal suffixes.
LEGAL_SUFFIXES = (
    "limited liability company",
    "private limited",
    "incorporated",
    "corporation",
    "public limited company",
    "gesellschaft mit beschraenkter haftung",
    "aktiengesellschaft",
    "besloten vennootschap",
    "societe a responsabilite limitee",
    "societe par actions simplifiee",
    "societe anonyme",
    "proprietary limited",
    "private",
    "limited",
    "llc",
    "inc",
    "corp",
    "gmbh",
    "ag",
    "bv",
    "sarl",
    "sas",
    "sa",
    "pty",
    "pvt",
    "plc",
    "nv",
    "kg",
    "ug",
    "ltd",
    "co",
)

MAX_SEED_ROWS = 10_000


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A headered CSV file as a reference table."""
    return spark.read.csv(path, header=True, schema=schema)


def country_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path is not None:
        return read_seed(spark, path, COUNTRY_SCHEMA)
    return spark.createDataFrame(COUNTRIES, COUNTRY_SCHEMA)


def suffix_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path is not None:
        return read_seed(spark, path, SUFFIX_SCHEMA)
    return spark.createDataFrame([(suffix,) for suffix in LEGAL_SUFFIXES], SUFFIX_SCHEMA)


def suffix_list(seed: DataFrame) -> list[str]:
    """The suffixes as literals for a pattern; refuses an implausibly long list."""
    rows = seed.select("suffix").where("suffix is not null").limit(MAX_SEED_ROWS + 1).collect()
    if len(rows) > MAX_SEED_ROWS:
        raise ValueError(f"more than {MAX_SEED_ROWS} legal suffixes")
    return [row.suffix for row in rows]
