"""Mixing: shares, draws, permutations and blocks against plain loops."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from subtide.llm import mixing, queries
from tests.llm.samples import TEXTS, awkward, empty, prose

SMALL = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_targets(sizes, weights, most):
    """By bisection of the level at which capped shares add up to all words."""
    low, high = 0.0, float(sum(sizes)) * 10 + 1
    for _ in range(300):
        level = (low + high) / 2
        if sum(min(most * s, level * w) for s, w in zip(sizes, weights)) < sum(sizes):
            low = level
        else:
            high = level
    return [min(most * s, high * w) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1000, 1, 1, 50], [0, 5, 0], [7], [0], [], [1, 1, 1, 1, 10_000, 3, 90]])
def test_targets_fill_up_to_the_bound(sizes):
    weights = mixing.cyclic_weights(len(sizes))
    got = mixing.shared_targets(sizes, weights, 3)
    assert got == pytest.approx(brute_targets(sizes, weights, 3), abs=1e-6)
    assert sum(got) == pytest.approx(sum(sizes))


def test_draws_end_on_the_quotas():
    quotas = [0, 5, 1000, 333]
    counts = mixing.shard_counts(quotas, 7, 1)
    assert counts.sum(axis=0).tolist() == quotas and np.ptp(counts.sum(axis=1)) <= 1
    assert mixing.shard_counts([], 3, 1).shape == (3, 0)


def test_draws_of_a_shard_are_multinomial():
    """Mean and spread over many seeds, of a shard that takes a tenth of all slots."""
    first = np.array([mixing.shard_counts([600, 300, 100], 10, seed)[0] for seed in range(3000)])
    assert first.mean(axis=0) == pytest.approx([60, 30, 10], abs=0.5)
    assert first.var(axis=0) == pytest.approx([100 * p * (1 - p) for p in (0.6, 0.3, 0.1)], rel=0.15)


def test_permutations_are_permutations_and_spread(spark):
    n = F.col("n")
    rows = spark.createDataFrame([(k, n, key) for n in (1, 2, 5, 97) for key in range(60) for k in range(n)], "k long, n long, key long")
    at = defaultdict(list)
    where = Counter()
    for row in rows.withColumn("at", mixing.permuted(F.col("k"), n, F.col("key"))).collect():
        at[row.n, row.key].append(row["at"])
        if row.n == 5 and row.k == 0:
            where[row["at"]] += 1
    assert all(sorted(own) == list(range(n)) for (n, _), own in at.items())
    assert len({tuple(own) for (n, _), own in at.items() if n == 97}) == 60
    assert set(where) == set(range(5)) and max(where.values()) < 30


def many(spark, n=300):
    rng = np.random.default_rng(8)
    rows = [(k, prose(k, int(rng.integers(0, 120))), ["b", "a", None, "c"][int(rng.choice(4, p=[0.6, 0.2, 0.15, 0.05]))]) for k in range(n)]
    rows += [rows[0], rows[0], (None, None, "a"), (1, "", None), (5, prose(77, 4000), "hot")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_blocks_hold_the_streams_in_order(spark):
    docs = many(spark)
    mixture = mixing.mix(docs, shards=4, block_words=16, with_text=True)
    texts = {r.row: r.text for r in mixture.documents.collect()}
    streams = defaultdict(list)
    for block in sorted(mixture.blocks.collect(), key=lambda b: (b.sid, b.block)):
        assert block.block == len(streams[block.sid])
        at = 0
        for piece in block.pieces:
            assert piece["at"] == at
            assert piece.text.split(" ") == words(texts[piece.row])[piece["first"] : piece["first"] + piece.n]
            at += piece.n
        streams[block.sid].append(at)
    sizes = {r.sid: r.source_size for r in mixture.sources.collect()}
    for sid, lengths in streams.items():
        assert set(lengths[:-1]) <= {16} and sum(lengths) == sizes[sid]
    taken = Counter()
    for block in mixture.blocks.collect():
        for piece in block.pieces:
            taken[piece.row] += piece.n
    assert all(taken[row] == len(words(text)) for row, text in texts.items())


def test_the_mix_keeps_its_promises(spark):
    docs = many(spark)
    mixture = mixing.mix(docs, shards=4, block_words=16, with_text=True)
    slots = mixture.mixed.collect()
    places = defaultdict(list)
    uses = Counter()
    taken = Counter()
    for slot in slots:
        places[slot.shard].append(slot.place)
        uses[slot.sid, slot.block] += 1
        assert slot["pass"] < 3
        for piece in slot.pieces:
            taken[piece.row] += piece.n
    assert all(sorted(own) == list(range(len(own))) for own in places.values())
    assert max(map(len, places.values())) - min(map(len, places.values())) <= 1
    for source in mixture.sources.collect():
        own = [uses[source.sid, b] for b in range(source.blocks)]
        assert sum(own) == source.quota and (not own or max(own) - min(own) <= 1)
    rows = mixing.taken_words(mixture).collect()
    assert Counter((r.id, r.size) for r in rows) == Counter((r.doc_id, len(words(r.text))) for r in docs.collect())
    assert sum(r.taken for r in rows) == sum(taken.values())
    assert all(r.taken <= 3 * r.size for r in rows)
    texts = {(r.shard, r.place): r.text for r in mixing.mixed_texts(mixture).collect()}
    assert texts == {(s.shard, s.place): " ".join(p.text for p in s.pieces) for s in slots}


def test_slots_are_never_broadcast(spark):
    text = mixing.mix(many(spark, 50)).mixed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [sid" in text and "Broadcast" not in text


def test_partitions_do_not_change_the_mix(spark):
    docs = many(spark)
    results = [Counter(map(tuple, mixing.taken_words(mixing.mix(d)).collect())) for d in (docs.repartition(7, "text"), docs.coalesce(1))]
    assert results[0] == results[1]


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = mixing.taken_words(mixing.mix(docs, block_words=32)).collect()
    assert Counter((r.id, r.size) for r in rows) == Counter((r.doc_id, len(words(r.text))) for r in docs.collect())
    assert mixing.taken_words(mixing.mix(empty(spark))).count() == 0
    nothing = awkward(spark, [None, "", " \n"])
    assert {(r.size, r.taken, r.target) for r in mixing.taken_words(mixing.mix(nothing)).collect()} == {(0, 0, 0.0)}
    assert len(TEXTS) + 2 == len(rows)


def test_query_comes_near_its_targets(spark):
    rows = queries.op11_mixing(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    source = {r.doc_id: r.source for r in docs}
    sizes = Counter()
    for r in docs:
        sizes[r.source] += len(words(r.text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, brute_targets([sizes[s] for s in order], mixing.cyclic_weights(len(order)), 3)))
    taken = Counter()
    for r in rows:
        own = source[r.doc_id]
        taken[own] += r.taken
        assert r.source_size == sizes[own] and r.target == pytest.approx(targets[own])
        assert r.taken <= 3 * r.size
    assert len(rows) == len(docs)
    for name in order:
        assert abs(taken[name] - targets[name]) <= 128 + 0.005 * targets[name]
