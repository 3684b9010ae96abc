"""Quality scores: held-out accuracy, features and word vectors against plain versions, odd rows."""

import collections
import random
import re
import zlib

import numpy as np

from ebbtide.llm import quality
from ebbtide.llm.common import read_table

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
WORD = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z\x80-\xff0-9\x20\x09-\x0d]+")
TEXTS = [b"", b"a", b"Two words, and 12!! of it\n it", b" ", "é12é ...".encode(), b"a a a a a a", b"x|y | z"]


def hash_of(word):
    return quality.word_rows([word])[0][0]


def test_words_are_runs_of_one_kind():
    hashes, text = quality.word_rows(TEXTS)
    words = [(k, w) for k, t in enumerate(TEXTS) for w in WORD.findall(t)]
    assert text.tolist() == [k for k, _ in words]
    assert hashes.tolist() == [int(hash_of(w)) for _, w in words]
    assert len(set(hashes.tolist())) == len({w for _, w in words})


def test_contexts_and_pools_are_the_plain_ones():
    table = np.zeros(quality.ROWS * quality.DIMENSIONS, np.int64)
    quality.add_contexts(table, TEXTS)
    expected = np.zeros((quality.ROWS, quality.DIMENSIONS))
    for text in TEXTS:
        hashes = [hash_of(w) for w in WORD.findall(text)]
        for i, word in enumerate(hashes):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(hashes):
                    places, signs = quality.index_entries(np.array([hashes[j]]))
                    for p, s in zip(places[0], signs[0]):
                        expected[quality.row_of(np.array([word]))[0], p] += s
    assert np.array_equal(table.reshape(expected.shape), expected)
    vectors = np.random.default_rng(1).normal(size=expected.shape).astype(np.float32)
    together = quality.pooled(TEXTS, vectors)
    for k, text in enumerate(TEXTS):
        v = vectors[[quality.row_of(np.array([hash_of(w)]))[0] for w in WORD.findall(text)]]
        if not len(v):
            assert not together[k].any()
            continue
        alike = [(v[:-d] * v[d:]).sum() / max(len(v) - d, 1) for d in quality.APART]
        plain = np.concatenate([v.mean(axis=0), v.std(axis=0), alike, [np.log1p(len(v))]])
        assert np.allclose(together[k], plain, atol=2e-3)
    assert np.array_equal(together, np.concatenate([quality.pooled([t], vectors) for t in TEXTS]))


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(40, 6)), (rng.random(40) > 0.5).astype(float)
    network = quality.Network(x, y)
    loss = lambda: np.logaddexp(0, -np.where(y > 0, 1, -1) * network.output(x)).mean()
    for w, g in zip(network.weights, network._gradients(network._scaled(x), y)):
        for at in list(np.ndindex(w.shape))[:5]:
            before = w[at]
            w[at] = before + 1e-5
            up = loss()
            w[at] = before - 1e-5
            assert abs((up - loss()) / 2e-5 - g[at]) < 1e-4
            w[at] = before


def test_temperature_is_the_best_one():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(300, 3)), (rng.random(300) > 0.4).astype(float)
    network = quality.Network(x, y)
    network.calibrate(x[::2], y[::2])
    z, sign = network.output(x[::2]), np.where(y[::2] > 0, 1, -1)
    loss = lambda t: np.logaddexp(0, -sign * z / t).mean()
    assert all(loss(network.temperature) <= loss(t) + 1e-6 for t in np.exp(np.linspace(-2.9, 2.9, 200)))


def test_held_out_labels_are_met(spark):
    rows = {r.doc_id: r for r in quality.op13_quality(spark, MIDDLE).collect()}
    labels = {r.doc_id: r.quality for r in read_table(spark, MIDDLE, "labels").collect()}
    held = [i for i in labels if rows[i].held_out]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    hit = collections.Counter((labels[i], rows[i].predicted) for i in held)
    assert hit[1, 1] >= 0.98 * (hit[1, 0] + hit[1, 1]) and hit[0, 0] >= 0.85 * (hit[0, 0] + hit[0, 1])
    # calibrated: scores are as high as labels are frequent
    assert abs(np.mean([rows[i].score for i in held]) - np.mean([labels[i] for i in held])) < 0.03


def test_odd_rows(spark):
    rng = random.Random(2)
    good, bad = (lambda: " ".join(rng.choices("a of the it is word".split(), k=30))), (lambda: "| " * 20 + str(rng.random()))
    docs = [(k, good() if k % 2 else bad(), -k, "x") for k in range(120)] + [(None, None, 0, None), (500, "", 0, "y"), (3, "same", 1, "z"), (3, "same", 1, "z")]
    docs.append((900, "of the " * 300_000, 2, "long"))
    frame = spark.createDataFrame(docs, "doc_id long, text string, score int, id string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(120)] + [(None, 1), (5, None), (7, 0)], "doc_id long, quality int")
    scored = quality.score(frame, labels)
    assert scored.columns == ["doc_id", "text", "score", "id"]
    rows = scored.collect()
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text or "", set()).add(r.score)
    assert len(rows) == len(docs) and all(len(s) == 1 and 0 <= min(s) <= 1 for s in by_text.values())
    assert np.mean([(r.score > 0.5) == bool(r.doc_id % 2) for r in rows[:120]]) > 0.95
    assert {r.score for r in quality.score(frame, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in quality.score(frame, labels.where("quality = 1")).collect()} == {1.0}
    assert quality.score(frame.limit(0), labels).isEmpty()
