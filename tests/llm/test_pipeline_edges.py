"""The pipeline on awkward, label-free and empty tables."""

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from subtide.llm.queries import TOKENIZER
from tests.llm.samples import awkward, empty

SMALL = "/root/testdata/sf0.001"


def _folder(spark, path, docs, with_rows):
    docs.write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if with_rows:
            # A row of nulls beside the given ones, and every row twice.
            nothing = table.limit(1).selectExpr(*(f"CAST(NULL AS {kind}) AS {column}" for column, kind in table.dtypes))
            table = table.unionByName(table).unionByName(nothing)
        else:
            table = table.limit(0)
        table.write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.mark.parametrize("with_rows", [True, False])
def test_awkward_documents_pass_through(spark, tmp_path, with_rows):
    docs = awkward(spark)
    rows = corpus_pipeline.run(spark, _folder(spark, tmp_path, docs, with_rows)).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    library = Tokenizer.from_file(TOKENIZER)
    assert len(rows) <= docs.count()
    assert {r.doc_id for r in rows} <= set(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    # Equal texts are near-duplicates of each other: one of each stays.
    kept = [texts[r.doc_id] for r in rows]
    assert len(kept) == len(set(kept))


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, _folder(spark, tmp_path, empty(spark), False)).count() == 0
