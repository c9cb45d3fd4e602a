"""Quality ranking: what it learns from, and its parts against plain loops."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from subtide.llm import quality_ranking
from subtide.llm.quality_ranking import BINS, N_FEATURES


def test_every_labelled_document_is_learned(spark):
    """Bad texts of a kind of their own stand last in the order of id hashes, by which the first 8,000 were once taken."""
    ids = spark.range(10_500).where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0)
    ids = [r.id for r in ids.orderBy(F.xxhash64("id")).collect()]
    assert len(ids) > 8300
    rows = []
    for n, doc in enumerate(ids):
        text, label = f"a plain text of number {doc} follows here", 1
        if n < 8000 and n % 40 == 0:
            text, label = text.replace(" ", " #$% "), 0
        elif n >= 8000 and n % 2 == 0:
            text, label = text.replace(" ", "!!! "), 0
        rows.append((doc, text, label))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = quality_ranking.train(docs, labels)
    # Only the last documents shout; before, no bin of that feature knew of them.
    assert model.edges[list(quality_ranking._CLASSES).index("shout")].max() > 0
    late, good = (model.score([r[1].encode() for r in rows[8000:] if r[2] == label]) for label in (0, 1))
    assert late.max() < good.min()


def test_pair_sums_equal_loops():
    rng = np.random.default_rng(3)
    worse, better = (np.arange(3) * BINS + rng.integers(0, BINS, (n, 3)) for n in (4, 6))
    weights = rng.normal(size=3 * BINS)
    number, loss, gradient, curvature = 0, 0.0, np.zeros(3 * BINS), np.zeros((3 * BINS, 3 * BINS))
    for b in better:
        for w in worse:
            apart = np.zeros(3 * BINS)
            apart[b] += 1
            apart[w] -= 1
            chance = 1 / (1 + math.exp(-float(apart @ weights)))
            number += 1
            loss -= math.log(chance)
            gradient -= (1 - chance) * apart
            curvature += chance * (1 - chance) * np.outer(apart, apart)
    found = quality_ranking.pair_sums(worse, better, weights)
    assert np.allclose(found, np.concatenate([[number, loss], gradient, curvature.ravel()]))


def test_reaching_equals_a_sort(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1e3, (300, 2)), rng.integers(-2, 3, (300, 2)), [[0.0, -0.0]]]).astype(np.float32)
    label = rng.integers(0, 2, len(x))
    rows = spark.createDataFrame([(v.tobytes(), int(n)) for v, n in zip(x, label)], "x binary, _label int").repartition(3)
    weigh = (3, 7)
    weight = np.where(label == 1, weigh[1], weigh[0])
    columns, amounts = [0, 0, 1, 1, 1], [1, weight.sum() // 2, weight.sum() // 3, weight.sum() - 1, weight.sum()]
    found = quality_ranking.reaching(rows, columns, [int(a) for a in amounts], weigh)
    for column, amount, value in zip(columns, amounts, found):
        order = np.argsort(x[:, column], kind="stable")
        assert value == x[order[np.searchsorted(np.cumsum(weight[order]), amount)], column]


@pytest.mark.parametrize("low, high", [(3, 4000), (2000, 2100), (1, 1)])
def test_groups_are_bounded_and_hold_every_document(spark, low, high):
    rows = spark.createDataFrame(
        [(n, np.full(N_FEATURES, n, np.float32).tobytes(), int(n >= low)) for n in range(low + high)], "_id long, x binary, _label int"
    )
    groups = quality_ranking.grouped(rows, low, high).collect()
    assert all(r.worse and r.better and len(r.worse) + len(r.better) < 2 * quality_ranking.GROUP for r in groups)
    assert len({x for r in groups for x in [*r.worse, *r.better]}) == low + high


def test_held_out_labels_are_not_learned(spark):
    ids = [n for n in range(200) if zlib.crc32(str(n).encode()) % 5 == 0]
    docs = spark.createDataFrame([(n, "some text") for n in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(n, k % 2) for k, n in enumerate(ids)], "doc_id long, quality int")
    assert not len(quality_ranking.train(docs, labels).weights)
