"""Convolutional text classifier for toxicity.

Words are hashed to embeddings; filters of several widths slide over them, the
largest answer of each filter over the whole text is kept, and a logistic layer
weighs those. Everything starts from random numbers and is trained in numpy. The
threshold is calibrated for each language, which is guessed from the text itself by
a model of hashed letter triples; that model learns the languages of the training
documents, and serves to group texts only.
"""

from __future__ import annotations

import zlib
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from subtide.llm.frames import append_columns, bytes_of, filter_rows, labelled_sample

#: Labelled documents that the network is trained and calibrated on.
SAMPLE_ROWS = 12_000
#: An embedding is made of two halves, each found by a hash of its own.
BUCKETS, HALF, WIDTHS, FILTERS = 1 << 16, 4, (1, 2, 3), 8
SIZE, PAD = 2 * HALF, WIDTHS[-1]
#: Spread of the random start, of embeddings and filters, and the weight that each filter starts with.
START_WORDS, START_FILTERS, START_WEIGHT = 0.02, 0.3, 0.3
#: Passes over the sample, more over a small one: at least so many documents are seen, in 60 passes at most.
EPOCHS, DOCUMENTS_SEEN, MOST_EPOCHS = 8, 20_000, 60
BATCH, RATE, FADE, CALIBRATION = 32, 0.01, 0.001, 0.2
#: Toxic documents in the sample from which on a part of it is kept for calibration alone.
CALIBRATED_FROM = 100
#: How much worse it is to reject a share of the clean documents than to keep the same share of the toxic ones.
FALSE_COST = 4
#: Toxic calibration documents that a language needs for a threshold of its own.
OWN_THRESHOLD = 40
#: Words that a task remembers before it starts anew.
MEMORY = 400_000

#: Hashes of letter triples in the language model.
TRIPLES = 1 << 14

_SEPARATE = bytes(
    b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def hashes(word: bytes) -> tuple[int, int]:
    first = zlib.crc32(word)
    return first % BUCKETS, zlib.crc32(word, first) // BUCKETS % BUCKETS


def triples(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the letter triples of all words, their ends marked, and how many each word has; the empty place has none."""
    flat, counts = array("i"), array("i")
    for word in words:
        marked = b"^" + word + b"$" if word else b""
        flat.extend(zlib.crc32(marked[n : n + 3]) % TRIPLES for n in range(len(marked) - 2))
        counts.append(max(len(marked) - 2, 0))
    return np.array(flat, np.int32), np.array(counts, np.int32)


class Words(dict):
    """Number of each word and its hashes; number 0 is the empty place after a text."""

    def __init__(self):
        self.first, self.second = array("i", [0]), array("i", [0])
        self.spelled: list[bytes] = [b""]

    def __missing__(self, word):
        code = self[word] = len(self.spelled)
        first, second = hashes(word)
        self.first.append(first)
        self.second.append(second)
        self.spelled.append(word)
        return code

    def pairs(self, start: int = 0) -> np.ndarray:
        """Both hashes of the words from number ``start`` on."""
        return np.stack([np.array(self.first[start:]), np.array(self.second[start:])], axis=1)

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all texts, each followed by empty places, and where each text begins (and the end)."""
        codes, begins = [], [0]
        for text in texts:
            codes += map(self.__getitem__, text.translate(_SEPARATE).split())
            codes += [0] * PAD
            begins.append(len(codes))
        return np.array(codes, np.int64), np.array(begins, np.int64)


class Languages:
    """How likely letter triples are in each language; texts without words are a group of their own."""

    def __init__(self, names: list[str], log_chance: np.ndarray):
        self.names, self.log_chance = names, log_chance  # (languages, TRIPLES)

    @classmethod
    def fit(cls, words: Words, docs: list[np.ndarray], known: list[str | None]) -> Languages:
        names = sorted({name for name in known if name is not None})
        counts = np.full((len(names), TRIPLES), 0.5)
        triple, lengths = triples(words.spelled if names else [])
        word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        for n, name in enumerate(names):
            codes = np.concatenate([doc for doc, own in zip(docs, known) if own == name])
            often = np.bincount(codes, minlength=len(lengths)).astype(float)
            counts[n] += np.bincount(triple, often[word], TRIPLES)
        return cls(names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))

    def of_words(self, spelled: list[bytes]) -> np.ndarray:
        """Log likelihood of each word by language; the empty place has none."""
        if not self.names:
            return np.zeros((len(spelled), 0), np.float32)
        flat, lengths = triples(spelled)
        sums = np.concatenate([np.zeros((1, len(self.names))), np.cumsum(self.log_chance[:, flat].T, axis=0, dtype=np.float64)])
        ends = np.cumsum(lengths)
        return (sums[ends] - sums[np.concatenate([[0], ends[:-1]]).astype(np.int64)]).astype(np.float32)

    def guess(self, likelihoods: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Number of the likeliest language of each text, by the likelihoods of its words."""
        none = np.full(len(begins) - 1, len(self.names))
        if not self.names or not len(none):
            return none
        sums = np.add.reduceat(likelihoods, begins[:-1], axis=0, dtype=np.float64)
        return np.where(sums.any(axis=1), sums.argmax(axis=1), none)


@dataclass
class Network:
    embedding: np.ndarray  # (2, BUCKETS, HALF)
    filters: list[np.ndarray]  # one array (width, SIZE, FILTERS) per width
    bias: np.ndarray  # of the filters
    weights: np.ndarray
    offset: float
    languages: Languages = field(default_factory=lambda: Languages([], np.zeros((0, TRIPLES), np.float32)))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(1))  # by language, then of texts without words

    def vectors(self, pairs: np.ndarray) -> np.ndarray:
        return np.concatenate([self.embedding[0][pairs[:, 0]], self.embedding[1][pairs[:, 1]]], axis=1)

    def output(self, best: np.ndarray) -> np.ndarray:
        """Logits from the largest answers of the filters."""
        return np.maximum(best + self.bias, 0) @ self.weights + self.offset


class Scorer:
    """A network with what each word adds to each filter, worked out once per word."""

    def __init__(self, net: Network):
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.words = Words()
        self.likelihoods = np.zeros((1, len(self.net.languages.names)), np.float32)
        self.answers = [np.zeros(1, np.float32) for width in WIDTHS for _ in range(width * FILTERS)]

    def _learn(self) -> None:
        known = len(self.likelihoods)
        if known == len(self.words.spelled):
            return
        self.likelihoods = np.concatenate([self.likelihoods, self.net.languages.of_words(self.words.spelled[known:])])
        vectors = self.net.vectors(self.words.pairs(known))
        added = np.concatenate([vectors @ part for w in self.net.filters for part in w], axis=1)
        self.answers = [np.append(old, column) for old, column in zip(self.answers, added.T)]

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Scores from 0 to 1; the threshold of the text's language has score one half."""
        if not texts:
            return np.empty(0)
        if len(self.words) > MEMORY:
            self.forget()
        z, language = self.logits(*self.words.read(texts))
        return 1 / (1 + np.exp(-np.clip(z - self.net.thresholds[language], -30, 30)))

    def logits(self, codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logit and language of each text, given as ``Words.read`` gives them."""
        self._learn()
        best = np.empty((len(begins) - 1, FILTERS * len(WIDTHS)), np.float32)
        column = 0
        for n, width in enumerate(WIDTHS):
            for f in range(FILTERS):
                answer = self.answers[column + f][codes]
                for place in range(1, width):
                    answer[:-place] += self.answers[column + place * FILTERS + f][codes[place:]]
                    answer[begins[1:] - place] = -np.inf
                # Texts end in empty places, so each has an answer, and none reaches into the next text.
                best[:, n * FILTERS + f] = np.maximum.reduceat(answer, begins[:-1])
            column += width * FILTERS
        return self.net.output(best).astype(np.float64), self.net.languages.guess(self.likelihoods[codes], begins)


class Adam:
    def __init__(self):
        self.rate, self.step, self.moments = RATE, 0, {}

    def update(self, name: str, values: np.ndarray, gradient: np.ndarray, rows=slice(None)) -> None:
        first, second = self.moments.setdefault(name, (np.zeros_like(values), np.zeros_like(values)))
        first[rows] = 0.9 * first[rows] + 0.1 * gradient
        second[rows] = 0.99 * second[rows] + 0.01 * gradient**2
        values[rows] -= self.rate * first[rows] / (1 - 0.9**self.step) / (np.sqrt(second[rows] / (1 - 0.99**self.step)) + 1e-6)


def _train_batch(net: Network, docs: list[np.ndarray], y: np.ndarray, importance: np.ndarray, adam: Adam) -> None:
    """One step. ``docs``: the hash pairs of each text and the empty places; only the words of the largest answers learn."""
    pairs, ends = np.concatenate(docs), np.cumsum([len(doc) for doc in docs])
    vectors = net.vectors(pairs)
    for place in range(1, PAD + 1):
        vectors[ends - place] = 0
    best, at = np.empty((len(docs), FILTERS * len(WIDTHS)), np.float32), np.empty((len(docs), FILTERS * len(WIDTHS)), np.int64)
    for n, w in enumerate(net.filters):
        answers = vectors @ w[0]
        for place in range(1, len(w)):
            answers[:-place] += vectors[place:] @ w[place]
            answers[ends - place] = -np.inf
        own, begin = slice(n * FILTERS, (n + 1) * FILTERS), 0
        for d, end in enumerate(ends):
            at[d, own] = begin + answers[begin:end].argmax(axis=0)
            begin = end
        best[:, own] = np.take_along_axis(answers, at[:, own], axis=0)
    pooled = np.maximum(best + net.bias, 0)
    error = ((1 / (1 + np.exp(-net.output(best))) - y) * importance / len(docs)).astype(np.float32)
    back = error[:, None] * net.weights[None, :] * (pooled > 0)
    empty = np.zeros(len(pairs), bool)
    for place in range(1, PAD + 1):
        empty[ends - place] = True
    adam.step += 1
    rows, pulls, gradients = [], [], [np.zeros_like(w) for w in net.filters]
    for n, w in enumerate(net.filters):
        own = slice(n * FILTERS, (n + 1) * FILTERS)
        for place in range(len(w)):
            words = np.minimum(at[:, own] + place, len(pairs) - 1)
            gradients[n][place] = np.einsum("dfs,df->sf", vectors[words], back[:, own])
            real = ~empty[words]
            rows.append(words[real])
            pulls.append((back[:, own][:, :, None] * w[place].T[None])[real])
    rows, pulls = pairs[np.concatenate(rows)], np.concatenate(pulls)
    adam.update("weights", net.weights, pooled.T @ error)
    for n, gradient in enumerate(gradients):
        adam.update(f"filters{n}", net.filters[n], gradient)
    adam.update("bias", net.bias, back.sum(axis=0))
    for half in (0, 1):
        touched, where = np.unique(rows[:, half], return_inverse=True)
        gradient = np.zeros((len(touched), HALF), np.float32)
        np.add.at(gradient, where, pulls[:, half * HALF : (half + 1) * HALF])
        adam.update(f"embedding{half}", net.embedding[half], gradient, touched)
    net.offset -= RATE * float(error.sum())


def _threshold(z: np.ndarray, y: np.ndarray) -> float:
    """Logit that parts the labels best, by the rate found less FALSE_COST times the rate of false alarms; the middle, if a range does."""
    order = np.argsort(-z, kind="stable")
    gain = np.cumsum(y[order] / max(y.sum(), 1) - FALSE_COST * (1 - y[order]) / max((1 - y).sum(), 1))
    at = np.flatnonzero(gain >= gain.max() - 1e-9)[0]
    upper, lower = z[order[at]], z[order[at + 1]] if at + 1 < len(z) else z[order[at]] - 1
    return float((upper + lower) / 2)


def random_network(seed: int) -> Network:
    """The network before it has learned anything."""
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    return Network(
        rng.normal(0, START_WORDS, (2, BUCKETS, HALF)).astype(np.float32),
        [rng.normal(0, START_FILTERS, (width, SIZE, FILTERS)).astype(np.float32) for width in WIDTHS],
        np.zeros(n_filters, np.float32),
        np.full(n_filters, START_WEIGHT, np.float32),
        -2.0,
    )


def fit(
    texts: list[bytes], labels: list[int], known: list[str | None] | None = None, seed: int = 7, epochs: int | None = None
) -> Network:
    """Train and calibrate. ``known`` are the texts' languages, if they are known.

    Without both labels, no text is toxic. ``epochs`` of 0 calibrates the random start.
    """
    rng = np.random.default_rng(seed)
    net = random_network(seed)
    y = np.array(labels, np.float32)
    if not (y == 1).any() or not (y == 0).any():
        net.weights[:], net.embedding[:] = 0, 0
        return net
    words = Words()
    docs = [words.read([text])[0].astype(np.int32) for text in texts]
    pairs = words.pairs()
    order = rng.permutation(len(docs))
    n_held = int(len(docs) * CALIBRATION) if y.sum() >= CALIBRATED_FROM else 0
    held, used = order[:n_held], order[n_held:]
    importance = np.where(y == 1, min(5.0, float((y == 0).sum() / y.sum()) ** 0.5), 1.0)
    if epochs is None:
        epochs = max(EPOCHS, min(MOST_EPOCHS, DOCUMENTS_SEEN // len(used)))
    adam = Adam()
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(used)
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            _train_batch(net, [pairs[docs[d]] for d in some], y[some], importance[some], adam)
            # Words that no label speaks for fade, so that long texts of new words stay neutral.
            net.embedding *= 1 - FADE
    net.languages = Languages.fit(words, docs, known or [None] * len(docs))
    judged = held if n_held and y[held].any() and not y[held].all() else used
    del words, docs, pairs, adam
    parts = []
    for at in range(0, len(judged), 500):
        scorer = Scorer(net)
        parts.append(scorer.logits(*scorer.words.read([texts[d] for d in judged[at : at + 500]])))
    z, language = (np.concatenate([part[n] for part in parts]) for n in (0, 1))
    net.thresholds = np.full(len(net.languages.names) + 1, _threshold(z, y[judged]))
    for n in range(len(net.thresholds)):
        own = language == n
        if y[judged][own].sum() >= OWN_THRESHOLD and (1 - y[judged][own]).sum() >= OWN_THRESHOLD:
            net.thresholds[n] = _threshold(z[own], y[judged][own])
    return net


def train(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = SAMPLE_ROWS,
    text_column: str = "text",
    id_column: str = "doc_id",
    language_column: str = "lang",
) -> Network:
    """Fit on at most ``rows`` labelled documents outside the held-out fifth.

    Rows without an id or a label of 0 or 1 are not learned from; of repeated ids
    one row counts. The language column of these documents, where there is one,
    teaches the grouping of texts for thresholds; scores see the text alone.
    """
    group = language_column if language_column in docs.columns else None
    return fit(*labelled_sample(docs, labels, "toxic", rows, text_column, id_column, group))


SCORE = [T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)]


def _scorer(shared, text_column):
    def start():
        scorer = Scorer(shared.value)

        def scores(batch):
            texts, out, held, size = bytes_of(batch, text_column), [], [], 0
            for text in texts:  # about a megabyte of text at a time
                held.append(text)
                size += len(text)
                if size > 1 << 20:
                    out.append(scorer.score(held))
                    held, size = [], 0
            return np.concatenate([*out, scorer.score(held)])

        return scores

    return start


def with_scores(docs: DataFrame, net: Network, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``score`` and ``predicted`` (1 from one half on).

    Only the text counts: null is empty, equal texts have equal scores. Input
    columns with these names give way.
    """
    scorer = _scorer(docs.sparkSession.sparkContext.broadcast(net), text_column)

    def start():
        scores_of = scorer()

        def compute(batch):
            scores = scores_of(batch)
            return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

        return compute

    return append_columns(docs, text_column, SCORE, start, keep)


def drop_toxic(docs: DataFrame, net: Network, text_column: str = "text") -> DataFrame:
    """Documents below the threshold, all their columns unchanged."""
    scorer = _scorer(docs.sparkSession.sparkContext.broadcast(net), text_column)

    def start():
        scores_of = scorer()
        return lambda batch: scores_of(batch) < 0.5

    return filter_rows(docs, text_column, start)
