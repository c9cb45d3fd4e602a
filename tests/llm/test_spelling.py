"""Spelling variants against all pairs of words."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from subtide.llm import queries, spelling
from tests.llm.samples import awkward, empty, prose

SMALL = "/root/testdata/sf0.001"


def brute_words(rows, every=31):
    """Word counts of (id, text) rows, by a plain loop."""
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts, times=10):
    words = sorted(counts)
    near = {w: [] for w in words}
    for n, a in enumerate(words):
        for b in words[n + 1 :]:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in words}


def as_set(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


VARIANTS = ["elephant", "elephnt", "elephant", "elephants", "elefhant", "phantele", "Überraschung", "überraschung", "ÜBERRASCHUNG", "colour×es", "ÿÿÿÿÿÿÿ"]


def words_of_variants():
    text = " ".join(["elephant"] * 300 + ["elephnt"] * 20 + ["elephntt"] * 2 + VARIANTS * 3)
    return [text, text, None, "", "a" * 5000 + " " + "a" * 4999 + " " + "a" * 5000 + " " + "a" * 4999, prose(4, 500), prose(4, 500)]


def test_groups_equal_all_pairs(spark):
    docs = awkward(spark, words_of_variants())
    counts = brute_words([(r.doc_id, r.text) for r in docs.collect()])
    got = as_set(spelling.spelling_groups(spelling.vocabulary(docs, misspell_every=31)))
    assert got == brute_groups(counts)
    roots = {w: (f, r) for w, f, r, *_ in got}
    assert roots["elephntt"] == ("elephnt", "elephant")
    assert any(len(w) == 4999 for w in roots)


@pytest.mark.parametrize("least, count", [(1, 1), (3, 2)])
def test_vocabulary_takes_other_bounds(spark, least, count):
    docs = awkward(spark, words_of_variants()[:5])
    want = Counter()
    for row in docs.collect():
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row.text or "")
        want.update(w for w in re.findall("[a-zÀ-ÿ]+", text) if len(w) >= least)
    got = {r.word: r.n for r in spelling.vocabulary(docs, least, count).collect()}
    assert got == {w: n for w, n in want.items() if n >= count}


@pytest.mark.parametrize("block_words, classes", [(2048, 2), (3, 3), (2048, 9)])
def test_blocks_and_classes_change_no_pair(spark, monkeypatch, block_words, classes):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(spelling, "letter_classes", lambda words: classes)
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list("abcé"), rng.integers(1, 7))) for _ in range(400)}
    df = spark.createDataFrame([(w, 1) for w in sorted(words)], "word string, n long")
    got = {(r.word, r.near) for r in spelling.near_words(df).collect()}
    want = {(a, b) for a in words for b in words if a != b and one_edit(a, b)}
    assert got == want and len(got) == spelling.near_words(df).count()


def test_a_product_in_tiles_gives_the_same_pairs(monkeypatch):
    rng = np.random.default_rng(6)
    words = sorted({"".join(rng.choice(list("abcd"), 6)) for _ in range(300)})
    want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])}
    for tile in (1 << 22, 500):
        monkeypatch.setattr(spelling, "TILE", tile)
        i, j = spelling.near_pairs(words, words, True)
        assert set(zip(i.tolist(), j.tolist())) == want


def test_empty_tables(spark):
    assert as_set(spelling.spelling_groups(spelling.vocabulary(empty(spark)))) == set()


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = brute_words([(r.doc_id, r.text) for r in docs.collect()])
    rows = queries.op13_spelling(spark, SMALL)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert as_set(rows) == brute_groups(counts)
    assert rows.count() == len(counts) > 1000


def test_paths_are_followed_to_their_end(spark):
    chain = [("abcdefg" + "x" * n, 10 ** (n + 1)) for n in range(9)]
    rows = spelling.spelling_groups(spark.createDataFrame(chain, "word string, n long")).collect()
    assert {r.root for r in rows} == {chain[-1][0]}
    assert math.isclose(len(rows), 9)
