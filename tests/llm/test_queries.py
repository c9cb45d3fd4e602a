"""Registered queries: whole tables, contract columns, SQL, and the pipeline against its parts."""

import hashlib
import re
import zlib

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from subtide.llm import queries
from subtide.session import materialized
from tests.llm.test_operators import _classes, _fingerprint, _hits

SMALL = "/root/testdata/sf0.01"
COLUMNS = {
    "op1_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op3_licences": ["doc_id", "licence", "dice", "n_units", "n_windows"],
    "op4_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5_simhash": ["doc_id", "fingerprint", "component_id"],
    "op6_html": ["page_id", "url", "text", "n_chars"],
    "op7_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op8_quality_ranking": ["doc_id", "held_out", "score", "predicted"],
    "op9_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op10_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op11_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op12_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_queries_return_every_row(spark, name):
    out = queries.QUERIES[name](spark, SMALL)
    assert out.columns == COLUMNS[name]
    table = "pages" if name == "op6_html" else "documents"
    assert out.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.QUERIES[name](spark, SMALL).select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_token_digests_equal_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for row in queries.op1_bpe(spark, SMALL).collect():
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_held_out_rows(spark):
    for row in queries.op8_quality_ranking(spark, SMALL).collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert row.predicted == (row.score >= 0.3)


def test_pipeline_stages(spark):
    """Each stage keeps the documents that its rule keeps, judged on its own input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = docs
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialized(stage(spark, docs, SMALL), name)
        assert kept.dtypes == first.dtypes
        before = {r.doc_id: r.text for r in docs.collect()}
        after = {r.doc_id: r.text for r in kept.collect()}
        assert after.items() <= before.items() and len(after) == kept.count()
        if name == "near_duplicates":
            ids = list(before)
            assert set(after) == set(_classes(ids, [_fingerprint(before[i]) for i in ids]))
        elif name == "decontamination":
            windows = _benchmark_windows(benchmark)
            clean = {i for i, text in before.items() if not _contaminated(text, windows)}
            assert set(after) == clean
        else:
            assert 0.5 * len(before) < len(after) < len(before)
        docs = kept
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert all(r.n_tokens == len(r.ids) for r in rows)


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({n: n + 32 for n in range(65, 91)}))


def _benchmark_windows(items):
    windows = {}
    for _, text in items:
        words = _words(text)
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(size, set()).add(tuple(words[i : i + size]))
    return windows


def _contaminated(text, windows):
    words = _words(text)
    hit = {
        p
        for size, known in windows.items()
        for i in range(len(words) - size + 1)
        if tuple(words[i : i + size]) in known
        for p in range(i, i + size)
    }
    return bool(hit) and 20 * len(hit) >= len(words)


def test_both_ways_of_counting_hits_agree():
    items = [("a", " ".join(f"w{n}" for n in range(20))), ("b", "two words")]
    text = "Two words and " + items[0][1]
    n_words, hit, names = _hits(text, items)
    assert (n_words, len(hit), names) == (23, 22, ["a", "b"])
    assert _contaminated(text, _benchmark_windows(items))
