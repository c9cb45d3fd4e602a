"""Token alignment against a plain loop over documents, links and counts."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import public_tokenizers
from subtide.llm import alignment, queries
from subtide.llm.bpe import byte_letters
from subtide.session import materialized
from tests.llm.samples import TEXTS, awkward, empty, prose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)

    def groups(self, text):
        """Pairs of id lists, or None where the bytes differ."""
        if not text:
            return []
        letters = byte_letters()
        ids_a, ids_b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        raw_a = [bytes(letters[c] for c in self.a.id_to_token(i)) for i in ids_a]
        raw_b = [self.b.id_to_piece(i) for i in ids_b]
        raw_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, raw_b)]
        if b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            return []
        out, i, j, end_a, end_b = [([], [])], 0, 0, 0, 0
        while i < len(ids_a) or j < len(ids_b):
            if end_a <= end_b:
                out[-1][0].append(ids_a[i])
                end_a += len(raw_a[i])
                i += 1
            else:
                out[-1][1].append(ids_b[j])
                end_b += len(raw_b[j])
                j += 1
            if end_a == end_b:
                out.append(([], []))
        return out[:-1]


def expected(rows):
    brute = Brute()
    groups = [(name, brute.groups(text)) for name, text in rows]
    counts = Counter()
    for _, own in groups:
        counts.update({(x, y) for xs, ys in own for x in xs for y in ys})
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for name, own in groups:
        links = [(x, y) for xs, ys in own for x in xs for y in ys]
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in own)
        out.append(
            (
                name,
                sum(len(xs) for xs, _ in own),
                sum(len(ys) for _, ys in own),
                len(own),
                len(links),
                sum(counts[x, y] == most[x] for x, y in links),
                sum(counts[x, y] for x, y in links),
                hashlib.sha256(text.encode()).hexdigest() if own else "",
            )
        )
    return out


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "a" * 3000 + "b" * 777, "▁ mark", "tab\there  two", " leading", "é" * 50, "\U0001f642" * 40, "x" * 40 + "ß" * 90]


def as_rows(df):
    return sorted(map(tuple, df.select(*NAMES).collect()), key=str)


@pytest.mark.parametrize("block_bytes, large", [(2 << 20, 4096), (100, 3)])
def test_alignment_equals_a_plain_loop(spark, monkeypatch, block_bytes, large):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(alignment, "LARGE_GROUP", large)
    docs = awkward(spark, [*TEXTS[:15], *TEXTS[16:], *ODD, prose(11, 900), prose(12, 3)])
    want = sorted(expected([(r.doc_id, r.text) for r in docs.collect()]), key=str)
    rows = alignment.alignments(docs, A, B)
    assert as_rows(rows) == want
    assert any(row[4] > row[1] + 100 for row in want) and sum(row[1] > 0 for row in want) > 8
    assert {r.N_Words for r in rows.collect()} == {"old"}


def test_a_group_of_many_links_counts_each(monkeypatch):
    side_a, side_b = alignment.byte_pieces(A), alignment.sentence_pieces(B)
    texts = ["a" * 3000 + "b" * 777, None, "plain words"]
    results = []
    for large in (1, 1 << 30):
        monkeypatch.setattr(alignment, "LARGE_GROUP", large)
        results.append([x.tolist() for x in alignment.Block(side_a, side_b, texts).pairs()])
    assert results[0] == results[1]


def test_spans_cut_both_id_lists_alike(spark):
    docs = spark.createDataFrame([(1, "One sentence, and another."), (2, None), (3, "Übermut tut selten gut")], "doc_id long, text string")
    brute = Brute()
    for row in alignment.align(docs, A, B, spans=True).collect():
        starts = zip([0, *row.cuts_a], row.cuts_a, [0, *row.cuts_b], row.cuts_b)
        assert [(row.ids_a[a:b], row.ids_b[c:d]) for a, b, c, d in starts] == brute.groups(row.text)


def test_white_space_without_end(spark):
    coder = alignment.byte_pieces(A)
    text = "x" + " " * 2_000_000 + "y"
    assert b"".join(coder.tokens[i] for i in coder.encode([text])[0]) == text.encode()


def test_empty_table(spark):
    assert alignment.alignments(empty(spark), A, B).count() == 0


def test_link_counts_are_a_table(spark):
    docs = spark.createDataFrame([(1, "the cat"), (2, "the dog")], "doc_id long, text string")
    aligned = materialized(alignment.align(docs, A, B), "aligned")
    rows = alignment.link_counts(aligned, 32_000).collect()
    assert max(r.n for r in rows) == 2 and all(r.best for r in rows if r.n == 2)


def test_query_equals_a_plain_loop(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = queries.op12_alignment(spark, SMALL)
    assert rows.columns == NAMES
    assert as_rows(rows) == sorted(expected([(r.doc_id, r.text) for r in docs.collect()]), key=str)


def test_common_cuts_equal_the_sorted_intersection():
    rng = np.random.default_rng(6)
    for size in (0, 1, 5, 200):
        ends_a, ends_b = (np.sort(rng.choice(300, size, replace=False) + 1) for _ in range(2))
        want = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        cuts_a, cuts_b = alignment.common_cuts(ends_a, ends_b)
        assert [ends_a[n - 1] for n in cuts_a] == want and [ends_b[n - 1] for n in cuts_b] == want
