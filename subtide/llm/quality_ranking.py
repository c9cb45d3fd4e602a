"""Quality scores learned from preference pairs (Bradley-Terry).

A document of label 1 is preferred to one of label 0. The score is a weighted
sum of text features; weights minimise the logistic loss on differences of the
features of a pair. The threshold is the score quantile at the share of label 0.

Every labelled document is learned from. Only its few features move: documents
are dealt to groups of bounded size, each of which pairs all its documents of one
label with all of the other. Tasks add up loss, gradient and curvature over their
groups, and a step on the driver, which sees those sums alone, moves the weights.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.frames import append_columns, bytes_of, filter_rows, held_out, known_labels, prepare_workers
from subtide.session import materialized

#: Documents of a group, about, and how many of the rarer label it gets at least, about; where those are too few, groups share them.
GROUP, RARER = 1024, 32
BINS, STEPS, DECAY, SMALL = 8, 25, 1e-3, 1e-7
#: Score at the threshold.
CUT = 0.3

_BYTE = np.arange(256)
_CLASSES = {
    "lower": (_BYTE >= 97) & (_BYTE <= 122),
    "upper": (_BYTE >= 65) & (_BYTE <= 90),
    "digit": (_BYTE >= 48) & (_BYTE <= 57),
    "high": _BYTE >= 128,
    "space": _BYTE == 32,
    "line": _BYTE == 10,
    "stop": np.isin(_BYTE, list(b".,;:'\"?-()")),
    "shout": _BYTE == ord("!"),
    "symbol": np.isin(_BYTE, list(b"#*$%&<>@^~=+\\/_[]{}`")),
    "bar": _BYTE == ord("|"),
}
_CLASS_TABLE = np.stack(list(_CLASSES.values()), axis=1).astype(np.float64)
N_FEATURES = len(_CLASSES) + 9


def features(text: bytes) -> np.ndarray:
    """Numbers that describe the whole text, none of which depends on its language."""
    out = np.zeros(N_FEATURES, np.float32)
    if not text:
        return out
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASS_TABLE
    out[: len(_CLASSES)] = counts / len(text)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    n, k = len(words), len(lines)
    if n:
        distinct = len(set(words))
        out[-9:] = (
            np.log1p(n),
            sum(map(len, words)) / n,
            distinct / n,
            np.log1p(distinct),
            sum(map(eq, words, words[1:])) / n,
            np.log1p(k),
            1 - len(set(lines)) / k,
            n / k,
            max(map(len, words)),
        )
    return out


@dataclass
class Ranking:
    edges: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Weighted sums in single precision, as the threshold is found on them."""
        return weighted(bins(x, self.edges), self.weights).astype(np.float32) if len(self.weights) else np.zeros(len(x), np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Scores from 0 to 1; the threshold has score ``CUT``."""
        x = np.array([features(text) for text in texts], np.float32).reshape(-1, N_FEATURES)
        above = np.clip(self.raw(x).astype(np.float64) - self.threshold, -30, 30)
        return 1 / (1 + (1 - CUT) / CUT * np.exp(-above))


def bins(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Number of the weight that each feature has, by the quantile bin it falls into."""
    found = [f * BINS + np.searchsorted(edges[f], x[:, f], "right") for f in range(x.shape[1])]
    return np.stack(found, axis=1) if found else np.zeros((len(x), 0), np.int64)


def weighted(places: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return weights[places].sum(axis=1)


# --- order statistics of all rows --------------------------------------------


def _ordered(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of single-precision numbers."""
    bits = (x + np.float32(0)).view(np.uint32)
    return np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))


def _numbers(keys: np.ndarray) -> np.ndarray:
    return np.where(keys >> 31, keys & np.uint32((1 << 31) - 1), ~keys).astype(np.uint32).view(np.float32)


def reaching(rows: DataFrame, columns: list[int], amounts: list[int], weights: tuple[int, int]) -> np.ndarray:
    """For each wanted amount, the smallest number of its column up to which rows weigh as much, exactly.

    ``rows`` have ``x``, single-precision numbers as bytes, and ``_label``, whose
    weight counts. Eight bits of each result are found a round, from counts that
    tasks take and a shuffle adds up.
    """
    prepare_workers(rows.sparkSession)
    found, below = np.zeros(len(columns), np.uint32), [0] * len(columns)
    width = max(columns) + 1
    for shift in (24, 16, 8, 0):
        known = found.copy()

        def run(batches, shift=shift, known=known):
            counts = np.zeros((len(columns), 256, 2), np.int64)
            for batch in batches:
                keys = _ordered(np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(-1, width))
                label = batch.column("_label").to_numpy()
                for n, column in enumerate(columns):
                    same = slice(None) if shift == 24 else keys[:, column] >> np.uint32(shift + 8) == known[n] >> np.uint32(shift + 8)
                    digit = (keys[same, column] >> np.uint32(shift)) & np.uint32(255)
                    counts[n] += np.bincount(digit.astype(np.int64) * 2 + label[same], minlength=512).reshape(256, 2)
            slot = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(counts.ravel()[slot])], ["slot", "n"])

        total = np.zeros((len(columns), 256, 2), np.int64)
        for row in rows.select("x", "_label").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect():
            total.ravel()[row[0]] = row[1]
        for n, amount in enumerate(amounts):
            for digit, (low, high) in enumerate(total[n].tolist()):
                here = below[n] + low * weights[0] + high * weights[1]
                if here >= amount or digit == 255:
                    break
                below[n] = here
            found[n] |= np.uint32(digit << shift)
    return _numbers(found)


def bin_edges(rows: DataFrame, low: int, high: int) -> np.ndarray:
    """Quantiles at which both labels weigh the same, so that rare labels get bins of their own."""
    columns = [f for f in range(N_FEATURES) for _ in range(1, BINS)]
    amounts = [-(-2 * low * high * k // BINS) for _ in range(N_FEATURES) for k in range(1, BINS)]
    return reaching(rows, columns, amounts, (high, low)).reshape(N_FEATURES, BINS - 1)


# --- pairs -------------------------------------------------------------------


def grouped(rows: DataFrame, low: int, high: int) -> DataFrame:
    """``worse, better``: features of the documents of each group, by label, in order of id."""
    rarer, groups = min(low, high), -(-(low + high) // GROUP)
    copies = min(groups, -(-RARER * groups // rarer))
    last = F.when(F.col("_label") == int(high < low), copies - 1).otherwise(0)
    dealt = rows.withColumn("_n", F.explode(F.sequence(F.lit(0), last)))
    dealt = dealt.withColumn("_group", F.pmod(F.xxhash64("_id"), F.lit(groups)) + F.col("_n"))
    own = lambda label: F.array_sort(F.collect_list(F.when(F.col("_label") == label, F.struct("_id", "x"))))["x"]
    return dealt.groupBy((F.col("_group") % groups).alias("_group")).agg(own(0).alias("worse"), own(1).alias("better"))


def pair_sums(worse: np.ndarray, better: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Number of pairs, loss, gradient and curvature of all pairs of a group, whose documents are given by their ``bins``."""
    size = len(weights)
    gap = np.clip(weighted(better, weights)[:, None] - weighted(worse, weights), -500, 500)
    pull = 1 / (1 + np.exp(gap))
    bend = pull * (1 - pull)
    sides = []
    for places in (better, worse):
        hot = np.zeros((len(places), size))
        hot[np.arange(len(places))[:, None], places] = 1
        sides.append(hot)
    b, w = sides
    gradient = pull.sum(axis=0) @ w - pull.sum(axis=1) @ b
    cross = b.T @ (bend @ w)
    curvature = (b * bend.sum(axis=1)[:, None]).T @ b + (w * bend.sum(axis=0)[:, None]).T @ w - cross - cross.T
    return np.concatenate([[gap.size, np.logaddexp(0, -gap).sum()], gradient, curvature.ravel()])


def _loss(groups: DataFrame, edges: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss of all pairs with its gradient and curvature. Each task gives one row of sums, the groups' rows stay where they are."""
    size = len(weights)

    def run(batches):
        sums = np.zeros(2 + size + size * size)
        places = lambda own: bins(np.frombuffer(b"".join(own), np.float32).reshape(-1, N_FEATURES), edges)
        for batch in batches:
            for worse, better in zip(batch.column("worse").to_pylist(), batch.column("better").to_pylist()):
                sums += pair_sums(places(worse), places(better), weights)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    rows = groups.mapInArrow(run, "sums binary").toLocalIterator()
    sums = sum(np.frombuffer(row[0], np.float64) for row in rows)
    mean = sums[1:] / sums[0]
    loss = mean[0] + DECAY / 2 * weights @ weights
    return loss, mean[1 : size + 1] + DECAY * weights, mean[size + 1 :].reshape(size, size) + DECAY * np.eye(size)


def fit_weights(groups: DataFrame, edges: np.ndarray) -> np.ndarray:
    """Newton steps on the pairs' loss, halved while they would raise it."""
    weights = np.zeros(N_FEATURES * BINS)
    loss, gradient, curvature = _loss(groups, edges, weights)
    step = -np.linalg.solve(curvature, gradient)
    for _ in range(STEPS):
        found = _loss(groups, edges, weights + step)
        if found[0] > loss + SMALL:
            step = step / 2
            continue
        weights, (loss, gradient, curvature) = weights + step, found
        if np.abs(gradient).max() < SMALL:
            break
        step = -np.linalg.solve(curvature, gradient)
    return weights


# --- all documents -----------------------------------------------------------


def with_features(docs: DataFrame, text_column: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``x``, the features of the text in single precision, as bytes."""

    def start():
        return lambda batch: [pa.array([features(text).tobytes() for text in bytes_of(batch, text_column)], pa.binary())]

    return append_columns(docs, text_column, [T.StructField("x", T.BinaryType(), False)], start, keep)


def _with_raw(rows: DataFrame, model: Ranking) -> DataFrame:
    """``rows`` with their weighted sum in place of the features."""

    def run(batches):
        for batch in batches:
            raw = model.raw(np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(-1, N_FEATURES))
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in raw], pa.binary()), batch.column("_label")], ["x", "_label"])

    return rows.select("x", "_label").mapInArrow(run, "x binary, _label int")


def train(
    docs: DataFrame, labels: DataFrame, rows: int | None = None, text_column: str = "text", id_column: str = "doc_id"
) -> Ranking:
    """Fit on all labelled documents outside the held-out fifth, or ``rows`` of them, for trials.

    Documents without an id or a label of 0 or 1 are left out; of repeated ids one
    row counts. With one label only, every document stays at the threshold.
    """
    learned = docs.where(F.col(id_column).isNotNull() & ~held_out(id_column))
    described = with_features(learned.select(F.col(id_column).alias("_id"), F.col(text_column).alias("text")), "text", ["_id"])
    found = described.join(known_labels(labels, "quality", id_column, rows), "_id")
    found = materialized(found.groupBy("_id").agg(F.min("x").alias("x"), F.max("_label").alias("_label")), "labelled-features")
    number = {row[0]: row[1] for row in found.groupBy("_label").count().collect()}
    low, high = number.get(0, 0), number.get(1, 0)
    if not low or not high:
        return Ranking(np.zeros((N_FEATURES, BINS - 1), np.float32), np.zeros(0), 0.0)
    edges = bin_edges(found, low, high)
    groups = materialized(grouped(found, low, high).select("worse", "better"), "pair-groups")
    model = Ranking(edges, fit_weights(groups, edges), 0.0)
    place = (low + high - 1) * low
    ranks = [place // (low + high) + 1, -(-place // (low + high)) + 1]
    model.threshold = float(reaching(_with_raw(found, model), [0, 0], ranks, (1, 1)).astype(np.float64).mean())
    return model


SCORE = [T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)]


def with_scores(docs: DataFrame, model: Ranking, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``score`` and ``predicted`` (1 from the threshold on).

    Only the text counts: null is empty, equal texts have equal scores. Input
    columns with these names give way.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value

        def compute(batch):
            scores = model.score(bytes_of(batch, text_column))
            return [pa.array(scores), pa.array((scores >= CUT).astype(np.int32))]

        return compute

    return append_columns(docs, text_column, SCORE, start, keep)


def drop_low_quality(docs: DataFrame, model: Ranking, text_column: str = "text") -> DataFrame:
    """Documents at or above the threshold, all their columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        return lambda batch: model.score(bytes_of(batch, text_column)) >= CUT

    return filter_rows(docs, text_column, start)
