"""Token ids as Parquet files that can be read selectively.

Files are written by Spark in ascending order of the document id: one row per
document with its id, its number of tokens, its place in the file set and the
list of ids. Row groups have a chosen size and pages a chosen number of rows, so
that the page index lets readers skip documents; ids are dictionary or delta
encoded. The length columns can be read without touching the ids.

Whole texts go through the tokenizers library. Its pre-tokens are made longer
where that cannot change an id: a boundary that no token of the vocabulary spans
is never joined by a merge, so several words may be one piece. That saves most of
the library's work per piece; pieces stay short, because its merges sort the
pairs of a piece.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

from subtide.llm.frames import append_columns, prepare_workers, texts_of
from subtide.session import new_scratch_folder

ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true"},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "v2"},
}

FIELDS = [
    T.StructField("n_tokens", T.LongType(), False),
    T.StructField("part_start", T.LongType(), False),
    T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
]

#: The pattern of byte-level pre-tokens, in which a run of letters goes on over up to 63 more, each after a space or line
#: end with or without one stop before. The plain pattern begins a pre-token at each of these signs (at the letters after a
#: line end too), so every piece is whole pre-tokens in a row. The bound keeps pieces short.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++(?>(?:[,.;:!?]?[ \n]\p{L}++){0,63})| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: Boundaries inside such pieces. Bytes of a token that are no whole sign decode to U+FFFD and may be part of a letter.
INSIDE = r"[\p{L}\x{FFFD},.;:!?][ \n]|[\p{L}\x{FFFD}][,.;:!?]|\n[\p{L}\x{FFFD}]"

PLAIN = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def long_pieces(tokenizer: Tokenizer) -> bool:
    """Let the pre-tokenizer make pieces of several words, if all ids stay the same for certain; tells whether they do.

    They do for the plain byte-level pre-tokens, when no token spans a boundary inside a piece.
    """
    spec = json.loads(tokenizer.to_str())
    own, model = spec["pre_tokenizer"] or {}, spec["model"]
    merges_only = model["type"] == "BPE" and not any(
        model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "fuse_unk")
    )
    if not merges_only or spec["normalizer"] or {key: own.get(key) for key in PLAIN} != PLAIN:
        return False
    # A zero sign is at no such boundary.
    tokens = "\0".join(tokenizer.decoder.decode([token]) for token in tokenizer.get_vocab(with_added_tokens=False))
    if normalizers.Replace(Regex(INSIDE), "").normalize_str(tokens) != tokens:
        return False
    byte_letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(PIECES), "isolated"), byte_letters])
    return True


@lru_cache(maxsize=2)
def library(path: str) -> Tokenizer:
    """One tokenizer per Python worker and file, with one thread: Spark has a task for every core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    long_pieces(tokenizer)
    return tokenizer


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int,
    encoding: str = "dictionary",
    row_group_mb: int = 32,
    page_rows: int = 1000,
    text_column: str = "text",
    id_column: str = "doc_id",
) -> None:
    """Write the ids of all documents to ``folder``, ``end_id`` after each.

    Texts are moved to ranges of ids first and encoded where they are written,
    so each is encoded once and ids are never shuffled. Documents without an id
    come first, repeated ids are ordered by a hash of the text, which also parts
    them among tasks; a null text has only the end id. An empty table gives files
    without rows. The library gets whole texts, one at a time: what it holds of a text is dropped before the next.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    ordered = hashed.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash").drop("hash")

    def start():
        coder, place = library(tokenizer), 0

        def compute(batch):
            nonlocal place
            ids, ends = array("i"), []
            for text in texts_of(batch, "text"):
                # This call leaves out the places of tokens, which encode() would count.
                ids.extend(coder.encode_batch_fast([text], add_special_tokens=False)[0].ids)
                ids.append(end_id)
                ends.append(len(ids))
            ends = np.array([0, *ends], np.int64)
            lengths, starts = np.diff(ends), place + ends[:-1]
            place += len(ids)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))
            return [pa.array(lengths), pa.array(starts), lists]

        return compute

    encoded = append_columns(ordered, "text", FIELDS, start, keep=["doc_id"]).withColumn("part", F.spark_partition_id())
    writer = encoded.write.option("compression", "zstd").option("parquet.block.size", row_group_mb << 20)
    for key, value in {**ENCODINGS[encoding], "parquet.page.row.count.limit": page_rows}.items():
        writer = writer.option(key, value)
    writer.parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, n_tokens, part, part_start, ids``; unused columns and filtered pages are not read."""
    return spark.read.parquet(folder)


def with_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Add to rows of ``files`` the ``start``, the number of ids of all documents before.

    Sums per written part come from the length column of the files alone.
    """
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = F.sum("part_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per part is left for the window.
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(parts, "part").withColumn("start", F.col("before") + F.col("part_start")).drop("before")


def with_checksums(files: DataFrame) -> DataFrame:
    """Add ``ids_crc32`` over the ids as little-endian unsigned 32-bit integers, in place of ``ids``."""
    prepare_workers(files.sparkSession)
    names = [f for f in files.schema.fields if f.name not in ("ids", "ids_crc32")]
    schema = T.StructType([*names, T.StructField("ids_crc32", T.LongType(), False)])

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            data = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))])
            sums = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            arrays = [batch.column(f.name) for f in names] + [pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return files.mapInArrow(run, schema)


def token_file_folder(spark: SparkSession) -> str:
    return new_scratch_folder(spark, "tokens")
