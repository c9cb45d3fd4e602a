"""Alignment of the tokens of two tokenizers.

Both encode the same bytes. The byte offsets where tokens end are the keys of two
dictionaries from end to token index; the intersection of their key sets, sorted,
gives the places where both tokenizers cut. Between two such places lie a few
tokens of either side, a group; its tokens are linked each with each. How
many documents hold a pair of ids linked is counted over the whole corpus.

Documents are worked on in blocks of a bounded amount of text. A block keeps one
sorted list of its id pairs, and each document the places of its pairs in it. So
one row per block and pair is shuffled, to count the pairs and to bring the
counts back, and never a row per document and pair.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from subtide.llm.bpe import PRE_TOKEN, byte_letters
from subtide.llm.frames import map_pieces, prepare_workers, ragged, texts_of, without
from subtide.session import materialized

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20

#: Groups with more links than this are linked by their distinct ids.
LARGE_GROUP = 4096

A_ENDS, B_ENDS = "|", ";"


class BytePieces:
    """Byte-level BPE of a vocabulary file, encoding special tokens as plain text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocabulary = byte_letters(), spec["model"]["vocab"]
        special = {token["content"] for token in spec["added_tokens"]}
        plain = {token: number for token, number in vocabulary.items() if token not in special}
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, number in plain.items():
            self.tokens[number] = bytes(letters[c] for c in token)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        merged = [vocabulary[a + b] for a, b in pairs]
        if merged != sorted(merged):
            raise ValueError(f"{path}: ids do not follow the order of merges")
        self.fast = tiktoken.Encoding(
            "pieces", pat_str=PRE_TOKEN, mergeable_ranks={self.tokens[n]: n for n in plain.values()}, special_tokens={}
        )
        self.path, self.exact = path, True
        self.sizes = np.array(list(map(len, self.tokens)), np.int64)

    @property
    def library(self) -> Tokenizer:
        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = True
        return tokenizer

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self._encode(text), np.int64) for text in texts]

    def _encode(self, text: str) -> list[int]:
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as error:  # the pattern's matcher gives up on endless runs of white space
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return self.library.encode(text, add_special_tokens=False).ids


class SentencePieces:
    """A sentencepiece model; the space mark stands for a space, byte pieces for their byte."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = [self._bytes(n) for n in range(self.model.get_piece_size())]
        self.sizes, self.exact = np.array(list(map(len, self.tokens)), np.int64), False

    def _bytes(self, number: int) -> bytes:
        piece = self.model.id_to_piece(number)
        return bytes([int(piece[1:-1], 16)]) if self.model.is_byte(number) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(own, np.int64) for own in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def byte_pieces(path: str) -> BytePieces:
    return BytePieces(path)


@lru_cache(maxsize=2)
def sentence_pieces(path: str) -> SentencePieces:
    return SentencePieces(path)


# --- one document ------------------------------------------------------------


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of tokens of either side up to each byte offset where tokens of both end, in order.

    ``ends_a`` and ``ends_b`` are the byte offsets where the tokens of either side end.
    """
    number_a, number_b = (dict(zip(ends.tolist(), range(1, len(ends) + 1))) for ends in (ends_a, ends_b))
    # The keys of B come in order already, so those that are keys of A as well do too. Numbers begin with 1: 0 is no key of A.
    of_a = np.fromiter(map(number_a.get, number_b, repeat(0)), np.int64, len(number_b))
    of_b = np.fromiter(number_b.values(), np.int64, len(number_b))
    common = of_a > 0
    return of_a[common], of_b[common]


# --- a block of documents ----------------------------------------------------


def _gives(side, ids: np.ndarray, ends: np.ndarray, data: bytes) -> bool:
    """Whether the tokens joined are ``data``. Byte-level BPE cuts bytes and never changes one, so there the length tells."""
    if not len(ends) or ends[-1] != len(data):
        return False
    return side.exact or b"".join(map(side.tokens.__getitem__, ids.tolist())) == data


class Block:
    """Alignment of all documents of a block.

    ``ids_a`` and ``ids_b`` hold the ids of all documents one after the other;
    group ``g`` has those from ``a[g]`` to ``a[g + 1]`` and from ``b[g]`` to ``b[g + 1]``.
    ``doc`` is the document of each group.
    """

    def __init__(self, side_a, side_b, texts: list[str]):
        self.n_docs, self.size_b = len(texts), len(side_b.tokens)
        chosen = [n for n, text in enumerate(texts) if text]
        spaced = [" " + texts[n] for n in chosen]
        ids_a, ids_b, a, b, doc = [], [], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], []
        n_a = n_b = 0
        for n, text, own_a, own_b in zip(chosen, spaced, side_a.encode(spaced), side_b.encode([texts[n] for n in chosen])):
            data = text.encode()
            ends_a, ends_b = np.cumsum(side_a.sizes[own_a]), np.cumsum(side_b.sizes[own_b])
            if not (_gives(side_b, own_b, ends_b, data) and _gives(side_a, own_a, ends_a, data)):
                continue
            cuts_a, cuts_b = common_cuts(ends_a, ends_b)
            a.append(cuts_a + n_a)
            b.append(cuts_b + n_b)
            ids_a.append(own_a)
            ids_b.append(own_b)
            doc.append(np.full(len(cuts_a), n, np.int64))
            n_a, n_b = n_a + len(own_a), n_b + len(own_b)
        none = [np.empty(0, np.int64)]
        self.ids_a, self.ids_b, self.doc = (np.concatenate(none + parts) for parts in (ids_a, ids_b, doc))
        self.a, self.b = np.concatenate(a), np.concatenate(b)

    def per_doc(self, amounts: np.ndarray) -> np.ndarray:
        """Sums of the groups' amounts by document."""
        sums = np.concatenate([[0], np.cumsum(amounts)])
        return np.diff(sums[np.searchsorted(self.doc, np.arange(self.n_docs + 1))])

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, key of the id pair and number of each link, slice by slice."""
        in_a, in_b = np.diff(self.a), np.diff(self.b)
        total = in_a * in_b
        small = np.flatnonzero(total <= LARGE_GROUP)
        place = ragged(np.zeros(len(small), np.int64), total[small])
        group = np.repeat(small, total[small])
        keys = self.ids_a[self.a[group] + place // in_b[group]] * self.size_b + self.ids_b[self.b[group] + place % in_b[group]]
        docs, times = self.doc[group], np.ones(len(keys), np.int64)
        for g in np.flatnonzero(total > LARGE_GROUP).tolist():
            own_a, times_a = np.unique(self.ids_a[self.a[g] : self.a[g + 1]], return_counts=True)
            own_b, times_b = np.unique(self.ids_b[self.b[g] : self.b[g + 1]], return_counts=True)
            own = (own_a[:, None] * self.size_b + own_b).ravel()
            keys, times = np.concatenate([keys, own]), np.concatenate([times, np.outer(times_a, times_b).ravel()])
            docs = np.concatenate([docs, np.full(len(own), self.doc[g])])
        return docs, keys, times

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The block's sorted id pairs; document, place in that list and number of links of each document's pairs."""
        docs, keys, times = self.links()
        span = (int(keys.max()) if len(keys) else 0) + 1
        codes = docs * span + keys
        if (times == 1).all():
            distinct, number = np.unique(codes, return_counts=True)
        else:
            distinct, first = np.unique(codes, return_inverse=True)
            number = np.zeros(len(distinct), np.int64)
            np.add.at(number, first, times)
        known, place = np.unique(distinct % span, return_inverse=True)
        return known, distinct // span, place, number

    def written(self, names: list[str]) -> list[str]:
        """Groups of each document as text, ids in order: ``a1,a2|b1;a3|b2,b3``; '' without groups."""
        in_a, in_b = np.diff(self.a), np.diff(self.b)
        groups = np.arange(len(self.doc))
        of_a, of_b = np.repeat(groups, in_a), np.repeat(groups, in_b)
        codes = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        last_a, last_b = np.zeros(len(self.ids_a), np.int64), np.zeros(len(self.ids_b), np.int64)
        last_a[self.a[1:] - 1], last_b[self.b[1:] - 1] = 1, 2
        # Tokens of a group stand together, those of A first.
        codes[np.arange(len(self.ids_a)) + self.b[of_a]] = self.ids_a * 3 + last_a
        codes[np.arange(len(self.ids_b)) + self.a[of_b + 1]] = self.ids_b * 3 + last_b
        ends = self.per_doc(in_a + in_b)
        bounds = np.concatenate([[0], np.cumsum(ends)]).tolist()
        return ["".join(map(names.__getitem__, codes[x:y].tolist()))[:-1] for x, y in zip(bounds, bounds[1:])]


def _names(ids: int) -> list[str]:
    return [f"{n}{sign}" for n in range(ids) for sign in (",", A_ENDS, B_ENDS)]


# --- all documents -----------------------------------------------------------

_LONGS, _INTS = T.ArrayType(T.LongType(), False), T.ArrayType(T.IntegerType(), False)
COUNTS = [T.StructField(name, T.LongType(), False) for name in ("n_a", "n_b", "n_groups", "n_links")]
DIGEST = T.StructField("groups_sha256", T.StringType(), False)
PAIRS = [
    T.StructField("block", T.LongType(), False),
    T.StructField("pairs", _INTS, False),
    T.StructField("times", _INTS, False),
    T.StructField("block_pairs", _LONGS, False),
    T.StructField("block_docs", _INTS, False),
]
SPANS = [T.StructField(name, _INTS, False) for name in ("ids_a", "ids_b", "cuts_a", "cuts_b")]


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def align(
    docs: DataFrame, path_a: str, path_b: str, text_column: str = "text", keep: list[str] | None = None, spans: bool = False
) -> DataFrame:
    """Append the alignment of a byte-level BPE (A, of space and text) and a sentencepiece model (B, of the text).

    ``n_a, n_b, n_groups, n_links, groups_sha256`` and the columns of ``PAIRS``: the
    block, the places of the document's id pairs in the block's list and their
    numbers of links; the first row of a block also has that list and how many
    of its documents hold each pair. With ``spans`` also the ids and, per group,
    how many tokens of either side end with it. Null and empty texts, and
    texts that either side does not give back byte by byte, have no tokens: zeros,
    empty lists and an empty digest. Repeated rows stay and count again; input columns
    with these names give way. Write the result once before it is used twice.
    """
    added = [*COUNTS, DIGEST, *PAIRS, *(SPANS if spans else [])]
    old = [f for f in without(docs, [f.name for f in added]) if keep is None or f.name in keep]

    def start():
        side_a, side_b = byte_pieces(path_a), sentence_pieces(path_b)
        names = _names(max(len(side_a.tokens), len(side_b.tokens)))
        number = count(TaskContext.get().partitionId() << 32)

        def step(batch) -> Iterator[pa.RecordBatch]:
            if batch is None:
                return
            block = Block(side_a, side_b, texts_of(batch, text_column))
            n, ones = block.n_docs, np.ones(len(block.doc), np.int64)
            known, doc, place, times = block.pairs()
            held = np.bincount(place, minlength=len(known))
            links = np.zeros(n, np.int64)
            np.add.at(links, doc, times)
            per_doc = np.bincount(doc, minlength=n)
            first = np.zeros(n, np.int64)
            first[0] = len(known)
            digests = [hashlib.sha256(text.encode()).hexdigest() if text else "" for text in block.written(names)]
            n_a, n_b, groups = block.per_doc(np.diff(block.a)), block.per_doc(np.diff(block.b)), block.per_doc(ones)
            arrays = [batch.column(f.name) for f in old]
            arrays += [pa.array(x, pa.int64()) for x in (n_a, n_b, groups, links)] + [pa.array(digests, pa.string())]
            arrays += [pa.array(np.full(n, next(number)), pa.int64()), _lists(place, per_doc, pa.int32()), _lists(times, per_doc, pa.int32())]
            arrays += [_lists(known, first, pa.int64()), _lists(held, first, pa.int32())]
            if spans:
                starts_a, starts_b = (np.concatenate([[0], np.cumsum(x)])[:-1] for x in (n_a, n_b))
                arrays += [_lists(block.ids_a, n_a, pa.int32()), _lists(block.ids_b, n_b, pa.int32())]
                arrays += [_lists(block.a[1:] - starts_a[block.doc], groups, pa.int32())]
                arrays += [_lists(block.b[1:] - starts_b[block.doc], groups, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, [*(f.name for f in old), *(f.name for f in added)])

        return step

    names = [f.name for f in old]
    columns = names if text_column in names else [*names, text_column]
    rows = docs.select(*(F.col(f"`{c}`") for c in columns))
    return map_pieces(rows, text_column, T.StructType([*old, *added]), start, BLOCK_BYTES)


def link_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: how many documents hold each id pair linked, and whether that is the most of its A id.

    A pair is ``id_a * size_b + id_b``. One row per block and pair is grouped, after sums within tasks.
    """
    held = aligned.select(F.explode(F.arrays_zip("block_pairs", "block_docs")).alias("p"))
    counted = held.select(F.col("p.block_pairs").alias("pair"), F.col("p.block_docs").cast("long").alias("n"))
    counted = counted.groupBy("pair").agg(F.sum("n").alias("n"))
    # An A id has at most as many rows as B has ids.
    of_a = Window.partitionBy(F.expr(f"pair div {size_b}"))
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_a))


def with_link_counts(aligned: DataFrame, counts: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``n_best`` (links whose pair is its A id's most frequent, ties included) and ``count_sum`` (over links).

    ``aligned`` must be written, ``counts`` are its ``link_counts``. Counts go to each block once.
    """
    prepare_workers(aligned.sparkSession)
    kept = [f for f in aligned.schema.fields if f.name in keep]
    schema = T.StructType([*kept, *(T.StructField(name, T.LongType(), False) for name in ("n_best", "count_sum"))])

    def summed(own: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("pair").to_numpy())
        n = found.column("n").to_numpy()[order]
        best = found.column("best").to_numpy()[order].astype(np.int64)
        pairs, times = (own.column(c).combine_chunks() for c in ("pairs", "times"))
        place, times = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (pairs, times))
        ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(pairs).to_numpy(zero_copy_only=False))])
        totals = [np.diff(np.concatenate([[0], np.cumsum(times * x[place])])[ends]) for x in (best, n)]
        columns = [own.column(f.name) for f in kept] + [pa.array(x, pa.int64()) for x in totals]
        return pa.Table.from_arrays(columns, schema.names)

    wanted = aligned.select(F.col("block").alias("of_block"), F.explode("block_pairs").alias("pair"))
    found = wanted.join(counts, "pair").groupBy("of_block")
    own = aligned.select(*(f"`{f.name}`" for f in kept), "block", "pairs", "times").groupBy("block")
    return own.cogroup(found).applyInArrow(summed, schema)


def alignments(docs: DataFrame, path_a: str, path_b: str, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``align`` of all documents with the corpus-wide columns ``n_best`` and ``count_sum``, without the columns of ``PAIRS``."""
    aligned = materialized(align(docs, path_a, path_b, text_column, keep), "aligned")
    counts = materialized(link_counts(aligned, len(sentence_pieces(path_b).tokens)), "link-counts")
    inner = {f.name for f in PAIRS}
    return with_link_counts(aligned, counts, [c for c in aligned.columns if c not in inner])
