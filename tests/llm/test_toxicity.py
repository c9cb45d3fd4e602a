"""The toxicity network: what it learns, and its parts against plain loops."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from subtide.llm import toxicity
from subtide.llm.toxicity import FILTERS, PAD, WIDTHS

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def parts():
    """Labelled documents: the part that is learned from, and the held-out part."""
    docs = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    rows = [(d["doc_id"], (d["text"] or "").encode(), toxic[d["doc_id"]], d["lang"]) for d in docs if toxic.get(d["doc_id"]) is not None]
    held = lambda r: zlib.crc32(str(r[0]).encode()) % 5 == 0
    return [r for r in rows if not held(r)], [r for r in rows if held(r)]


def fitted(rows, **settings):
    return toxicity.fit([r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows], **settings)


def rates(net, rows):
    found = toxicity.Scorer(net).score([r[1] for r in rows]) >= 0.5
    y = np.array([r[2] for r in rows])
    return found[y == 1].mean(), found[y == 0].mean()


def test_training_is_what_finds_toxic_texts(parts):
    """Without any update the same start, calibrated the same way, tells next to nothing."""
    known, held = parts
    found, wrong = rates(fitted(known), held)
    assert found > 0.7 and wrong < 0.05
    start, start_wrong = rates(fitted(known, epochs=0), held)
    assert start - start_wrong < 0.2


def test_languages_are_guessed_from_the_text(parts):
    known, held = parts
    net = fitted(known[:800], epochs=0)
    scorer = toxicity.Scorer(net)
    _, guess = scorer.logits(*scorer.words.read([r[1] for r in held]))
    right = [net.languages.names[g] == r[3] for g, r in zip(guess, held) if g < len(net.languages.names)]
    assert np.mean(right) > 0.95 and len(right) > 0.9 * len(held)
    _, none = scorer.logits(*scorer.words.read([b"", b" ,. "]))
    assert none.tolist() == [len(net.languages.names)] * 2


def test_answers_equal_a_plain_loop():
    net = toxicity.random_network(3)
    net.bias[:] = np.linspace(-0.01, 0.01, len(net.bias))
    scorer = toxicity.Scorer(net)
    texts = [b"", b"one", b"two words", b"the same word the same word", b"A longer text, with 12 signs; and more of them"]
    z, _ = scorer.logits(*scorer.words.read(texts))
    for text, got in zip(texts, z):
        words = text.translate(toxicity._SEPARATE).split()
        rows = [np.concatenate([net.embedding[h][n] for h, n in enumerate(toxicity.hashes(w))]) for w in words]
        rows += [np.zeros(toxicity.SIZE)] * PAD
        rows = [np.asarray(r, float) for r in rows]
        logit = net.offset
        for n, (width, filters) in enumerate(zip(WIDTHS, net.filters)):
            for f in range(FILTERS):
                answers = [sum(rows[i + p] @ filters[p, :, f] for p in range(width)) for i in range(len(rows) - width + 1)]
                k = n * FILTERS + f
                logit += max(max(answers) + net.bias[k], 0) * net.weights[k]
        assert got == pytest.approx(logit, abs=1e-5)


def test_a_text_scores_alike_beside_any_other():
    scorer = toxicity.Scorer(toxicity.random_network(5))
    alone = [scorer.score([t])[0] for t in (b"some text", b"", b"another one")]
    assert scorer.score([b"some text", b"", b"another one"]) == pytest.approx(alone)


def test_a_step_lowers_the_loss():
    net = toxicity.random_network(4)
    texts, y = [b"good day to you", b"you scum", b"good morning", b"scum of the day"], np.array([0, 1, 0, 1], np.float32)
    words = toxicity.Words()
    docs = [words.read([t])[0] for t in texts]
    pairs, adam = words.pairs(), toxicity.Adam()

    def loss():
        scorer = toxicity.Scorer(net)
        z, _ = scorer.logits(*scorer.words.read(texts))
        return float(np.mean(np.logaddexp(0, z) - y * z))

    losses = [loss()]
    for _ in range(60):
        toxicity._train_batch(net, [pairs[d] for d in docs], y, np.ones(4), adam)
        losses.append(loss())
    assert losses[-1] < 0.3 * losses[0] and losses[5] < losses[0]


@pytest.mark.parametrize("labels", [[0, 0, 0], [1, 1, 1], []])
def test_one_label_teaches_nothing(labels):
    net = toxicity.fit([b"a b", b"c", b""][: len(labels)], labels)
    assert (toxicity.Scorer(net).score([b"a b", b"", b"new words"]) < 0.5).all()


def test_threshold_weighs_false_alarms():
    z, y = np.array([4.0, 3.0, 2.0, 1.0, 0.0]), np.array([1, 1, 0, 1, 0])
    assert toxicity._threshold(z, y) == 2.5
