import gzip
import json
import os

import pytest
from pyspark.errors import SparkRuntimeException, StreamingQueryException

from subtide.operators.latest import latest_per_key
from subtide.plans.staging import extract, stage_landed
from subtide.sources import seeds
from subtide.sources.files import read_csv_source
from subtide.sources.keyed_table import KeyedTable
from subtide.sources.layers import layer_name
from subtide.sources.schemas import EVENTS, TRANSACTIONS
from subtide.streaming.landing import current_generation, land_files, landed, last_load, newer_than, quarantined


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def contents(table):
    return sorted((r.k, r.v) for r in table.read().collect())


def test_upsert_replaces_by_key_and_ignores_a_replay(spark, folder):
    table = KeyedTable(spark, folder, "k", buckets=4)
    assert table.read() is None and table.high_water_mark("v") is None
    table.upsert(frame(spark, [(f"k{i}", i) for i in range(20)]), "1")
    table.upsert(frame(spark, [("k3", 300), ("new", 1)]), "2")
    want = sorted([(f"k{i}", 300 if i == 3 else i) for i in range(20)] + [("new", 1)])
    assert contents(table) == want
    # The replay carries the tag of the last commit; arrival decides, not the value.
    table.upsert(frame(spark, [("k3", 1)]), "2")
    assert contents(table) == want
    table.upsert(frame(spark, [("k3", 1)]), "3")
    assert ("k3", 1) in contents(table)
    assert table.high_water_mark("v") == 19


def test_insert_only_batches_rewrite_nothing(spark, folder):
    table = KeyedTable(spark, folder, "k", buckets=2)
    for batch in range(3):
        table.upsert(frame(spark, [(f"b{batch}-{i}", i) for i in range(10)]))
    parts = sorted(os.listdir(f"{folder}/rows"))
    assert [p for p in parts if p.endswith("_rw")] == []
    assert len(contents(table)) == 30


def test_many_folders_are_merged(spark, folder):
    table = KeyedTable(spark, folder, "k", buckets=1, max_parts=2)
    for batch in range(4):
        table.upsert(frame(spark, [(f"b{batch}", batch)]))
    assert contents(table) == [("b0", 0), ("b1", 1), ("b2", 2), ("b3", 3)]
    assert any(p.endswith("_rw") for p in os.listdir(f"{folder}/rows"))


def test_a_failed_commit_leaves_the_old_rows(spark, folder, monkeypatch):
    table = KeyedTable(spark, folder, "k", buckets=2)
    table.upsert(frame(spark, [("a", 1), ("b", 2)]))

    def fail(self, state):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(KeyedTable, "_commit", fail)
        table.upsert(frame(spark, [("a", 9)]))
    assert contents(table) == [("a", 1), ("b", 2)]
    table.upsert(frame(spark, [("a", 9)]))
    assert contents(table) == [("a", 9), ("b", 2)]


def test_empty_batch_and_overwrite(spark, folder):
    table = KeyedTable(spark, folder, "k", buckets=2)
    table.upsert(frame(spark, []))
    assert table.read() is None
    table.upsert(frame(spark, [("a", 1)]))
    table.overwrite(frame(spark, [("z", 26)]))
    assert contents(table) == [("z", 26)]


def test_newest_row_wins_on_request(spark, folder):
    table = KeyedTable(spark, folder, "k", buckets=2, files_per_bucket=2)
    table.upsert(frame(spark, [("a", 5), ("b", 5), ("c", 5)]))
    table.upsert(frame(spark, [("a", 1), ("b", 9), ("d", 1)]), newest_by="v")
    assert contents(table) == [("a", 5), ("b", 9), ("c", 5), ("d", 1)]


def test_a_large_bucket_is_written_by_several_tasks(spark, folder):
    table = KeyedTable(spark, folder, "k", buckets=1)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50000")
    try:
        rows = spark.range(0, 40_000, 1, 8).selectExpr("cast(id as string) AS k", "cast(id as int) AS v")
        table.upsert(rows)
        table.upsert(rows.where("v < 30000"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    for part in os.listdir(f"{folder}/rows"):
        files = [f for f in os.listdir(f"{folder}/rows/{part}/bucket=0") if f.endswith(".parquet")]
        assert len(files) > 2, part
    assert contents(table) == sorted((str(n), n) for n in range(40_000))


def write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("\n".join(lines) + "\n")


def line(event_id, **payload):
    fields = {"event_id": event_id, "event_type": "open", "event_time": "2024-01-02T03:04:05Z", **payload}
    return json.dumps({"metadata": {"extracted_at": "2024-01-03T00:00:00Z"}, "payload": fields})


def ids(df):
    return sorted(r.event_id for r in extract(df, EVENTS).collect())


def test_landing_loads_each_file_once_and_keeps_broken_lines_apart(spark, folder):
    files, landing = f"{folder}/in", f"{folder}/landing"
    write_lines(f"{files}/1.jsonl.gz", [line("a"), "{broken", "", line("b")])
    land_files(spark, files, landing)
    land_files(spark, files, landing)
    assert ids(landed(spark, landing)) == ["a", "b"]
    [bad] = quarantined(spark, landing).collect()
    assert bad.raw_text == "{broken" and bad.file_name.endswith("1.jsonl.gz")

    mark = landed(spark, landing).agg({"loaded_at": "max"}).first()[0]
    write_lines(f"{files}/2.jsonl.gz", [line("c")])
    land_files(spark, files, landing)
    assert ids(landed(spark, landing)) == ["a", "b", "c"]
    assert ids(landed(spark, landing, after=mark)) == ["c"]
    assert ids(newer_than(landed(spark, landing), None)) == ["a", "b", "c"]

    assert land_files(spark, files, landing, full_refresh=True) == 1
    assert current_generation(spark, landing) == 1
    assert ids(landed(spark, landing)) == ["a", "b", "c"]
    write_lines(f"{files}/3.jsonl.gz", [line("d")])
    assert land_files(spark, files, landing) == 1
    assert ids(landed(spark, landing)) == ["a", "b", "c", "d"]
    assert os.path.exists(f"{files}/1.jsonl.gz")


def test_a_refresh_that_fails_is_not_seen_and_is_resumed(spark, folder, monkeypatch):
    files, landing = f"{folder}/in", f"{folder}/landing"
    write_lines(f"{files}/1.jsonl.gz", [line("a")])
    land_files(spark, files, landing)
    write_lines(f"{files}/2.jsonl.gz", [line("b")])

    def fail(lines, loaded_at):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(StreamingQueryException):
        patch.setattr("subtide.streaming.landing.parse_lines", fail)
        land_files(spark, files, landing, full_refresh=True)
    assert current_generation(spark, landing) == 0 and ids(landed(spark, landing)) == ["a"]
    assert land_files(spark, files, landing, full_refresh=True) == 1
    assert ids(landed(spark, landing)) == ["a", "b"]


def test_landing_of_nothing(spark, folder):
    assert landed(spark, f"{folder}/none").count() == 0
    assert current_generation(spark, f"{folder}/none") == 0


def test_extract_is_strict_unless_told_otherwise(spark):
    df = spark.sql(
        """SELECT parse_json('{"metadata":{},"payload":{"transaction_id":"t","purchase_price":"dear"}}') AS raw_data,
                  timestamp'2024-01-01' AS loaded_at"""
    )
    with pytest.raises(SparkRuntimeException):
        extract(df, TRANSACTIONS).collect()
    [row] = extract(df, TRANSACTIONS, strict=False).collect()
    assert row.purchase_price is None and row.transaction_id == "t"


def test_price_flags_keep_unknown_prices_unknown(spark):
    values = ["0", "-1", "5", "null"]
    rows = [
        (f'{{"metadata":{{}},"payload":{{"transaction_id":"{i}","purchase_price":{value},"sale_type":"New"}}}}',)
        for i, value in enumerate(values)
    ]
    df = spark.createDataFrame(rows, "j string").selectExpr("parse_json(j) AS raw_data", "timestamp'2024-01-01' AS loaded_at")
    flags = {r.transaction_id: (r.is_zero_value, r.is_refund, r.loyalty_discount) for r in stage_landed(df, TRANSACTIONS).collect()}
    assert flags == {"0": (True, False, 0.0), "1": (False, True, 0.0), "2": (False, False, 0.0), "3": (None, None, 0.0)}


def test_seeds_and_csv(spark, folder):
    assert seeds.country_table(spark).count() == 20 and seeds.suffix_table(spark).count() == 31
    with open(f"{folder}/suffixes.csv", "w") as out:
        out.write("suffix\noy\nab\n")
    assert sorted(seeds.suffix_list(seeds.suffix_table(spark, f"{folder}/suffixes.csv"))) == ["ab", "oy"]
    assert read_csv_source(spark, f"{folder}/suffixes.csv").columns == ["suffix"]
    assert layer_name(" marts ") == "MARTS"


@pytest.mark.parametrize("before, after", [(4, 8), (8, 4)])
def test_the_number_of_buckets_belongs_to_the_table(spark, folder, before, after):
    KeyedTable(spark, folder, "k", buckets=before).upsert(frame(spark, [(f"k{i}", i) for i in range(1000)]))
    table = KeyedTable(spark, folder, "k", buckets=after)
    table.upsert(frame(spark, [(f"k{i}", -i) for i in range(50)]))
    want = sorted((f"k{i}", -i if i < 50 else i) for i in range(1000))
    assert contents(table) == want
    table.rebucket()
    table.upsert(frame(spark, [("k999", 0)]))
    assert contents(table) == sorted([*[row for row in want if row[0] != "k999"], ("k999", 0)])


def test_the_position_is_committed_with_the_rows(spark, folder):
    table = KeyedTable(spark, folder, "k", buckets=2)
    assert table.position() is None
    table.upsert(frame(spark, [("a", 1)]), position=(0, 3))
    table.upsert(frame(spark, [("b", 1)]))
    assert table.position() == (0, 3)
    table.upsert(frame(spark, []), position=(0, 4))
    assert table.position() == (0, 4) and len(contents(table)) == 2


def test_files_delivered_late_with_an_old_time_are_loaded(spark, folder):
    files, landing = f"{folder}/in", f"{folder}/landing"
    write_lines(f"{files}/1.jsonl.gz", [line("a")])
    land_files(spark, files, landing)
    write_lines(f"{files}/0.jsonl.gz", [line("b")])
    month_ago = os.path.getmtime(f"{files}/1.jsonl.gz") - 30 * 86400
    os.utime(f"{files}/0.jsonl.gz", (month_ago, month_ago))
    land_files(spark, files, landing)
    assert ids(landed(spark, landing)) == ["a", "b"]
    assert last_load(spark, landing) == 1
    assert ids(landed(spark, landing, loads=(0, 1))) == ["b"]


def test_rows_that_differ_in_a_variant_only_have_one_winner(spark):
    rows = spark.sql("SELECT 1 AS k, parse_json(concat('{\"a\":', id, '}')) AS v FROM range(20)")
    orders = [rows.orderBy(rows.v.cast("string")), rows.orderBy(rows.v.cast("string").desc())]
    winners = {latest_per_key(df, ["k"], ["k"]).select(df.v.cast("string")).first()[0] for df in orders}
    assert len(winners) == 1
