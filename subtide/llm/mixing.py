"""Mixing sources to target weights in blocks of fixed length.

Words of each source, its documents in pseudorandom order, form one long stream
that is cut into blocks of fixed length. How many blocks of each source an output
shard takes is drawn from a multinomial law in the quotas that are left, so the
sources end on their quotas exactly. The slots of a source are numbered over all
shards; a pseudorandom permutation of its block numbers, a new one for each pass
over the source, maps a slot to a block, and blocks are joined by their numbers.
Only numbers of documents, words and blocks move; no stream meets in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from subtide.session import materialized

#: Fixed value: words are runs of anything but white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rounds of a permutation of block numbers.
ROUNDS = 20

#: Documents of a cell at least. Cells grow with the square root of the table, as does their number.
CELL_ROWS = 500

#: Slots that one row of the plan stands for, and slots of a partition, at most.
SLOTS_PER_ROW, SLOTS_PER_PARTITION = 4096, 1 << 16


@dataclass
class Mixture:
    """Tables of a mix, all but ``mixed`` written to the shared folder.

    ``documents``: ``row, id, source, size``, and ``text`` if asked for; ``row`` numbers the rows of the input.
    ``sources``: ``sid, source, source_size, target, blocks, quota``.
    ``blocks``: ``sid, block, pieces``, the pieces in order: ``at`` (first word in the block), ``row``, ``id``,
    ``first`` (first word in the document), ``n`` (words), and ``text``.
    ``mixed``: ``shard, place, sid, pass, block, pieces``: places of a shard are gapless from 0.
    """

    documents: DataFrame
    sources: DataFrame
    blocks: DataFrame
    mixed: DataFrame


# --- weights and draws -------------------------------------------------------


def cyclic_weights(sources: int) -> list[int]:
    return [n % 3 + 1 for n in range(sources)]


def shared_targets(sizes: Sequence[int], weights: Sequence[float], most: float) -> list[float]:
    """Shares of all words by weight; no source gets over ``most`` times its size, the others share what is over."""
    targets, left, open_ = [0.0] * len(sizes), float(sum(sizes)), list(range(len(sizes)))
    while open_:
        scale = left / sum(weights[n] for n in open_)
        above = [n for n in open_ if scale * weights[n] > most * sizes[n]]
        for n in above or open_:
            targets[n] = float(most * sizes[n] if above else scale * weights[n])
        if not above:
            break
        left -= sum(targets[n] for n in above)
        open_ = [n for n in open_ if n not in set(above)]
    return targets


def block_quotas(sizes: Sequence[int], targets: Sequence[float], block_words: int, most: int) -> list[tuple[int, int]]:
    """Blocks of each source, and how many the mix takes; none is taken more than ``most`` times."""
    out = []
    for size, target in zip(sizes, targets):
        blocks = -(-size // block_words)
        out.append((blocks, min(most * blocks, math.floor(target * blocks / size + 0.5)) if size else 0))
    return out


def shard_counts(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Blocks by shard (row) and source (column): multinomial draws from what is left of the quotas.

    Shards differ by one block at most; columns add up to the quotas.
    """
    rng = np.random.default_rng(seed)
    left, total = np.array(quotas, np.int64), int(sum(quotas))
    counts = np.zeros((shards, len(left)), np.int64)
    for shard in range(shards):
        size = total // shards + (shard < total % shards)
        while size:
            drawn = np.minimum(rng.multinomial(size, left / left.sum()), left)
            counts[shard] += drawn
            left -= drawn
            size -= int(drawn.sum())
    return counts


def permuted(place: Column, n: Column, key: Column) -> Column:
    """Place of ``place`` in a pseudorandom permutation of 0 to n - 1 chosen by ``key``.

    Each round pairs the places whose sum is one drawn number modulo n, and a
    drawn bit of each pair says whether it is swapped.
    """

    def one_round(at: Column, number: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, number), n) - at, n)
        return F.when(F.xxhash64(key, number, F.greatest(at, partner)) % 2 == 0, partner).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), place.cast("long"), one_round)


# --- streams and blocks ------------------------------------------------------


def _documents(docs: DataFrame, seed: int, text_column: str, source_column: str, id_column: str, with_text: bool) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("id"),
        F.col(source_column).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_column), text).alias("order"),
        *([text.alias("text")] if with_text else []),
    )
    return materialized(rows, "sized")


def _streams(documents: DataFrame, sources: DataFrame) -> DataFrame:
    """Add ``sid`` and ``start``, the words of the source before the document, in two steps of bounded windows."""
    total = documents.count()
    cells = max(1, math.ceil(total / max(CELL_ROWS, math.isqrt(total))))
    known = sources.select("sid", F.col("source").alias("name"))
    rows = documents.where("size > 0").join(known, F.col("source").eqNullSafe(F.col("name")))
    rows = rows.withColumn("cell", F.pmod("order", F.lit(cells)))
    sums = rows.groupBy("sid", "cell").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("sid", "cell", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    # Equal rows may change places: their order breaks ties by the number of the row.
    own = Window.partitionBy("sid", "cell").orderBy("order", "id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(own), F.lit(0))).join(before, ["sid", "cell"])
    return rows.withColumn("start", F.col("before") + F.col("inside"))


def _blocks(streams: DataFrame, block_words: int, with_text: bool) -> DataFrame:
    """Pieces of documents by block; a block has at most as many pieces as words."""
    length = F.lit(block_words)
    number = F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))
    names = ["sid", "row", "id", "start", "size", *(["words"] if with_text else [])]
    if with_text:
        streams = streams.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    pieces = streams.select(*names, F.explode(number).alias("block"))
    begin = F.col("block") * length
    first = F.greatest(begin - F.col("start"), F.lit(0))
    n = F.least(begin + length - F.col("start"), F.col("size")) - first
    parts = [F.greatest(F.col("start") - begin, F.lit(0)).alias("at"), "row", "id", first.alias("first"), n.alias("n")]
    if with_text:
        parts.append(F.array_join(F.slice("words", (first + 1).cast("int"), n.cast("int")), " ").alias("text"))
    return pieces.groupBy("sid", "block").agg(F.sort_array(F.collect_list(F.struct(*parts))).alias("pieces"))


def _slots(spark, counts: np.ndarray, blocks: list[int], seed: int) -> DataFrame:
    """``shard, place, sid, pass, block`` of every slot. The written plan has a row per shard, source and so many slots."""
    first = np.cumsum(counts, axis=0) - counts
    offset = np.cumsum(counts, axis=1) - counts
    sizes = counts.sum(axis=1)
    rows = [
        (int(s), int(c), int(sizes[s]), int(counts[s, c]), int(first[s, c]), int(offset[s, c]), int(blocks[c]))
        for s, c in zip(*np.nonzero(counts))
    ]
    schema = "shard int, sid int, shard_slots long, n long, first_slot long, offset long, blocks long"
    plan = materialized(spark.createDataFrame(rows, schema), "mix-plan")
    step = F.lit(SLOTS_PER_ROW).cast("long")
    spread = plan.withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)))
    spread = spread.repartition(max(1, math.ceil(int(counts.sum()) / SLOTS_PER_PARTITION)), "shard", "sid", "low")
    slot = spread.withColumn("i", F.explode(F.sequence("low", F.least(F.col("low") + step, F.col("n")) - 1)))
    slot = slot.select(
        "shard",
        (F.col("offset") + F.col("i")).alias("in_shard"),
        "shard_slots",
        "sid",
        F.expr("(first_slot + i) div blocks").alias("pass"),
        ((F.col("first_slot") + F.col("i")) % F.col("blocks")).alias("in_pass"),
        "blocks",
    )
    return slot.select(
        "shard",
        permuted(F.col("in_shard"), F.col("shard_slots"), F.xxhash64(F.lit(seed), F.lit("shard"), "shard")).alias("place"),
        "sid",
        "pass",
        permuted(F.col("in_pass"), F.col("blocks"), F.xxhash64(F.lit(seed), F.lit("source"), "sid", "pass")).alias("block"),
    )


# --- the mix -----------------------------------------------------------------


def mix(
    docs: DataFrame,
    shards: int = 64,
    block_words: int = 128,
    most: int = 3,
    seed: int = 1,
    weights=cyclic_weights,
    text_column: str = "text",
    source_column: str = "source",
    id_column: str = "doc_id",
    with_text: bool = False,
) -> Mixture:
    """Mix all documents so that each source takes its share of all words.

    ``weights`` gives the weights of so many sources, which are in order of
    code points, null last. A target stops at ``most`` times the words of its
    source; no block, and so no document, is taken more than ``most`` times. Null
    and empty texts have no words and no pieces; repeated rows and ids are rows of
    their own. The driver holds one row per source, and one per shard and
    source. The same rows give the same mix, whatever their partitions.
    """
    spark = docs.sparkSession
    documents = _documents(docs, seed, text_column, source_column, id_column, with_text)
    totals = [tuple(r) for r in documents.groupBy("source").agg(F.sum("size")).collect()]
    totals.sort(key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [size for _, size in totals]
    targets = shared_targets(sizes, weights(len(sizes)), most)
    quotas = block_quotas(sizes, targets, block_words, most)
    rows = [(n, name, size, target, *quota) for n, ((name, size), target, quota) in enumerate(zip(totals, targets, quotas))]
    schema = "sid int, source string, source_size long, target double, blocks long, quota long"
    sources = materialized(spark.createDataFrame(rows, schema), "sources")

    blocks = materialized(_blocks(_streams(documents, sources), block_words, with_text), "blocks")
    counts = shard_counts([quota for _, quota in quotas], shards, seed)
    slots = _slots(spark, counts, [own for own, _ in quotas], seed)
    # The plan of the slots is small whatever their number, so Spark must not take its size for theirs.
    return Mixture(documents, sources, blocks, slots.hint("merge").join(blocks, ["sid", "block"]))


def taken_words(mixture: Mixture) -> DataFrame:
    """``id, size, source_size, target, taken`` of each row of the input: words that the mix takes of it, repeats counted."""
    pieces = mixture.mixed.select(F.explode("pieces").alias("p")).select("p.row", "p.n")
    taken = pieces.groupBy("row").agg(F.sum("n").alias("taken"))
    known = mixture.sources.select(F.col("source").alias("name"), "source_size", "target")
    rows = mixture.documents.join(known, F.col("source").eqNullSafe(F.col("name"))).join(taken, "row", "left")
    return rows.select("id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_texts(mixture: Mixture) -> DataFrame:
    """``shard, place, text``: the words of each block, of a mix with texts."""
    return mixture.mixed.select("shard", "place", F.array_join(F.col("pieces.text"), " ").alias("text"))
