"""SimHash near-duplicates, found with BK-trees.

Fingerprints of 64 bits that differ in at most ``radius`` bits are linked.
Equal fingerprints are one node. When 64 bits are cut into ``radius + 2`` blocks,
two linked fingerprints agree in two blocks at least, so each pair of blocks
gives shards that together meet every link. A shard is a BK-tree: children
hang below their parent by the Hamming distance to it, and a search goes down
only edges within the radius of the distance it has. Large shards are cut into
cells of bounded size, each with the tree of one part and the queries of another.
A cell reports links that join its fingerprints, not all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.components import components
from subtide.llm.frames import append_columns, bytes_of, prepare_workers, ragged
from subtide.session import materialized

SEED = 42
#: Fingerprints of a tree at most.
CELL = 1024
#: Rows that a task works on at once, and pairs in flight in one search.
ROWS, PAIRS = 200_000, 2_000_000

FINGERPRINT = T.StructField("fp", T.LongType(), False)
LINKS = T.StructType([T.StructField("u", T.LongType(), False), T.StructField("v", T.LongType(), False)])


def fingerprints_of(texts: list[bytes], shingle_words: int) -> np.ndarray:
    """Signed 64-bit fingerprints: bits that most shingle hashes have; no words give zero."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for n, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle_words:
            hashes.append(digest(joined, SEED))
            counts[n] = 1
            continue
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle_words + 1].tolist()
        hashes += [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle_words - 1 :].tolist())]
        counts[n] = len(starts)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        data = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        begins = np.concatenate([[0], np.cumsum(counts[full])])
        sums = np.empty((len(full), 64), np.int64)
        step = 4096
        for at in range(0, len(full), step):
            some = begins[at : at + step + 1]
            bits = np.unpackbits(data[some[0] : some[-1]], axis=1, bitorder="little")
            sums[at : at + step] = np.add.reduceat(bits, some[:-1] - some[0], axis=0, dtype=np.int64)
        over = 2 * sums > counts[full][:, None]
        out[full] = np.packbits(over, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out.view(np.int64)


def with_fingerprints(docs: DataFrame, shingle_words: int = 4, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``fp``. Null and empty texts have fingerprint zero; an input column ``fp`` gives way."""

    def start():
        def compute(batch):
            texts, out, held, size = bytes_of(batch, text_column), [], [], 0
            for text in texts:  # hashes of about a megabyte of text at a time
                held.append(text)
                size += len(text)
                if size > 1 << 20:
                    out.append(fingerprints_of(held, shingle_words))
                    held, size = [], 0
            out.append(fingerprints_of(held, shingle_words))
            return [pa.array(np.concatenate(out))]

        return compute

    return append_columns(docs, text_column, [FINGERPRINT], start, keep)


# --- trees -------------------------------------------------------------------


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64)


class Forest:
    """BK-trees of many cells, built and searched level by level."""

    def __init__(self, cells: np.ndarray, values: np.ndarray):
        """One tree for each run of equal ``cells``; the first value of a run is the root."""
        self.values = values
        self.first = np.flatnonzero(np.diff(cells, prepend=cells[:1] - 1)) if len(cells) else np.empty(0, np.int64)
        sizes = np.diff(self.first, append=len(cells))
        parent = np.full(len(values), -1, np.int64)
        edge = np.zeros(len(values), np.int64)
        at = np.repeat(self.first, sizes)
        waiting = np.flatnonzero(at != np.arange(len(values)))
        at = at[waiting]
        while len(waiting):
            apart = distance(values[waiting], values[at])
            order = np.argsort(at * 65 + apart, kind="stable")
            waiting, at, apart = waiting[order], at[order], apart[order]
            group = np.flatnonzero(np.diff(at * 65 + apart, prepend=-1))
            child = np.repeat(waiting[group], np.diff(group, append=len(waiting)))
            new = np.zeros(len(waiting), bool)
            new[group] = True
            parent[waiting[new]], edge[waiting[new]] = at[new], apart[new]
            waiting, at = waiting[~new], child[~new]
        self.children = np.argsort(parent, kind="stable")
        self.edge = edge
        ordered = parent[self.children]
        self.child_start = np.searchsorted(ordered, np.arange(len(values)))
        self.child_count = np.searchsorted(ordered, np.arange(len(values)), "right") - self.child_start

    def search(self, roots: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) within the radius, each query below its own root."""
        found = []
        query, node = np.arange(len(queries)), roots
        while len(query):
            apart = distance(queries[query], self.values[node])
            hit = apart <= radius
            found.append((query[hit], node[hit]))
            counts = self.child_count[node]
            child = self.children[ragged(self.child_start[node], counts)]
            query, apart = np.repeat(query, counts), np.repeat(apart, counts)
            inside = np.abs(self.edge[child] - apart) <= radius
            query, node = query[inside], child[inside]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each its own label's label) after linking ``a`` and ``b``."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped


def links_of_cells(cells: np.ndarray, values: np.ndarray, sides: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the fingerprints of each cell. Sides: 0 tree and query, 1 tree, 2 query. Sorted by cell."""
    in_tree, asks = np.flatnonzero(sides != 2), np.flatnonzero(sides != 1)
    label = np.arange(len(values))
    forest = Forest(cells[in_tree], values[in_tree])
    tree_cells = cells[in_tree][forest.first]
    place = np.searchsorted(tree_cells, cells[asks])
    has = place < len(tree_cells)
    has[has] = tree_cells[place[has]] == cells[asks[has]]
    asks, place = asks[has], place[has]
    sizes = np.diff(forest.first, append=len(in_tree))[place]
    chunk = np.cumsum(sizes) // PAIRS
    bounds = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(asks)]
    for start, end in zip(bounds, bounds[1:]):
        some = asks[start:end]
        query, node = forest.search(forest.first[place[start:end]], values[some], radius)
        label = join_labels(label, some[query], in_tree[node])
    moved = np.flatnonzero(label != np.arange(len(label)))
    return values[moved], values[label[moved]]


def _cells(prints: DataFrame, radius: int) -> DataFrame:
    """``shard, a, b, fp, side``: where each distinct fingerprint is stored or asked."""
    blocks = radius + 2
    edges = [64 * n // blocks for n in range(blocks + 1)]
    piece = [F.shiftrightunsigned("fp", lo).bitwiseAND((1 << (hi - lo)) - 1) for lo, hi in zip(edges, edges[1:])]
    shards = F.array(
        *(
            F.struct(F.lit(n).alias("pair"), (piece[x] * (1 << 24) + piece[y]).alias("bits"))
            for n, (x, y) in enumerate(combinations(range(blocks), 2))
        )
    )
    entries = prints.select("fp", F.explode(shards).alias("shard")).select("fp", "shard.pair", "shard.bits")
    large = entries.groupBy("pair", "bits").count().where(F.col("count") > CELL)
    large = large.select("pair", "bits", F.ceil(F.col("count") / CELL).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    dealt = entries.join(large, ["pair", "bits"], "left").select("pair", "bits", "fp", parts.alias("parts"), own.alias("own"))
    other = dealt.select("pair", "bits", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return other.select(
        "pair", "bits", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp", side.alias("side")
    )


def links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """``u, v``: links whose components are those of all links between the distinct fingerprints ``fp``."""
    prepare_workers(prints.sparkSession)
    keys = ["pair", "bits", "a", "b"]
    cells = _cells(prints, radius).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush(last: bool):
            nonlocal held, rows
            data = pa.Table.from_batches(held)
            columns = [data.column(k).to_numpy() for k in keys]
            change = np.zeros(len(data), bool)
            for column in columns:
                change[1:] |= column[1:] != column[:-1]
            cell = np.cumsum(change)
            # The last cell may go on in the next batch.
            end = len(data) if last else int(np.searchsorted(cell, cell[-1]))
            fp, side = data.column("fp").to_numpy()[:end], data.column("side").to_numpy()[:end]
            u, v = links_of_cells(cell[:end], fp, side, radius)
            rest = data.slice(end)
            held, rows = rest.to_batches(), len(rest)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS:
                yield flush(False)
        if rows:
            yield flush(True)

    return cells.mapInArrow(run, LINKS)


def fingerprint_components(prints: DataFrame, radius: int = 4) -> DataFrame:
    """``fp, root`` of each linked fingerprint but the least of its component."""
    distinct = materialized(prints.select("fp").distinct(), "fingerprints")
    return components(links(distinct, radius)).select(F.col("u").alias("fp"), F.col("v").alias("root"))


def _with_component(prints: DataFrame, radius: int, lowest) -> DataFrame:
    """``fp, component``: the lowest of ``lowest`` over all rows of the component."""
    roots = fingerprint_components(prints, radius)
    per_print = prints.groupBy("fp").agg(F.min(lowest).alias("low"), F.count(F.lit(1)).alias("n"))
    rooted = materialized(
        per_print.join(roots, "fp", "left").select("fp", "low", "n", F.coalesce("root", "fp").alias("root")), "rooted"
    )
    per_root = rooted.groupBy("root").agg(F.min("low").alias("component"))
    return rooted.join(per_root, "root").select("fp", "component")


def near_duplicates(
    docs: DataFrame, shingle_words: int = 4, radius: int = 4, text_column: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """``id, fp, component_id`` for each document; the component is named by its smallest id.

    Null texts count as empty; documents without words share fingerprint zero.
    Null ids are never the smallest while another id is there. Repeated rows
    stay. An empty table gives no rows.
    """
    rows = with_fingerprints(docs.select(id_column, text_column), shingle_words, text_column, [id_column])
    prints = materialized(rows, "fingerprints")
    found = _with_component(prints, radius, F.col(id_column))
    return prints.join(found, "fp").select(id_column, "fp", F.col("component").alias("component_id"))


def drop_near_duplicates(
    docs: DataFrame, shingle_words: int = 4, radius: int = 4, text_column: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """One document of each component, with all its columns: that with the smallest id, then hash of the text.

    Rows with the same id and text are one document. Documents without an id
    go behind those with one.
    """
    name = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    marked = with_fingerprints(docs.select(id_column, text_column), shingle_words, text_column, [id_column, text_column])
    order = F.struct(
        F.col(id_column).isNull().alias("no_id"), F.col(id_column).alias("id"), F.xxhash64(text_column).alias("hash")
    )
    prints = materialized(marked.select("fp", order.alias("_order")), "fingerprints")
    found = _with_component(prints, radius, F.col("_order"))
    winners = found.select(
        F.coalesce(F.col("component.id").cast("string"), F.lit("")).alias("_id"), F.col("component.hash").alias("_hash")
    ).distinct()
    keyed = docs.withColumns({"_id": name, "_hash": F.xxhash64(text_column)})
    return keyed.join(winners, ["_id", "_hash"]).dropDuplicates(["_id", "_hash"]).select(docs.columns)
