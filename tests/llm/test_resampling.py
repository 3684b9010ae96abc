"""Importance resampling against a plain version."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from ebbtide.llm import resampling
from ebbtide.llm.common import read_table

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, most):
    words = WORD.findall((text or "").encode().lower())
    return [b" ".join(words[k : k + n]) for n in range(1, most + 1) for k in range(len(words) - n + 1)], len(words)


def plain(docs, target, most=1, buckets=10_000, least=20, percent=10):
    """{row number: (n_features, weight, score, rank)} of docs (id, text)."""
    bucket = lambda g: zlib.crc32(g) % buckets
    s = collections.Counter(bucket(g) for _, t in docs for g in grams(t, most)[0])
    t = collections.Counter(bucket(g) for x in target for g in grams(x, most)[0])
    total_s, total_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * total_s / ((s[b] + 1) * total_t))) for b in s}
    rows = []
    for k, (i, text) in enumerate(docs):
        found, words = grams(text, most)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(g)] for g in found)
        rows.append((k, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words >= least, i))
    drawn = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[5] is None, r[5]))
    ranks = {r[0]: n for n, r in enumerate(drawn[: len(drawn) * percent // 100], 1)}
    return [(r[5], *r[1:4], ranks.get(r[0])) for r in rows]


def test_query_is_the_plain_version(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SMALL, "documents").collect()]
    target = [r.text for r in read_table(spark, SMALL, "benchmark").collect()]
    found = resampling.op11_resampling(spark, SMALL)
    assert found.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted(tuple(r) for r in found.collect()) == sorted(plain(docs, target))


@pytest.mark.parametrize("most", [1, 2, 3])
def test_features_stay_in_their_document(most):
    texts = ["a b c", None, "", "A", "x-y  z\nw", "é\x00É ü", "a b"]
    bucket, owner, words = resampling.features([None if t is None else t.encode() for t in texts], most, 1000)
    expected = collections.Counter((k, zlib.crc32(g) % 1000) for k, t in enumerate(texts) for g in grams(t, most)[0])
    assert collections.Counter(zip(owner.tolist(), bucket.tolist())) == expected
    assert words.tolist() == [grams(t, 1)[1] for t in texts]


ODD = [(3, "b " * 25), (3, "b " * 25), (None, "a " * 30), (1, "a " * 30), (2, None), (4, ""), (5, "a b"), (None, "c d " * 12), (9, "a " * 200_000)]


def test_odd_rows_and_the_drawn_documents(spark):
    frame = spark.createDataFrame([(i, t, "s", k, k) for k, (i, t) in enumerate(ODD)], "doc_id long, text string, w string, id int, score int")
    target = spark.createDataFrame([("a a b",), (None,)], "text string")
    rows = resampling.scores(frame, resampling.gains_of(frame, target, most_words=2), most_words=2, percent=50).collect()
    expected = plain(ODD, ["a a b"], 2, percent=50)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in rows), key=key) == sorted(expected, key=key)
    drawn = resampling.resample(frame, target, most_words=2, percent=50)
    assert drawn.columns == frame.columns
    kept = {r[0] for r in expected if r[4]}
    assert {r.doc_id for r in drawn.collect()} == kept and {tuple(r) for r in drawn.collect()} <= {tuple(r) for r in frame.collect()}
    assert resampling.resample(frame.limit(0), target).isEmpty()
    empty = resampling.gains_of(frame, target.limit(0))
    assert np.isfinite(empty).all() and resampling.scores(frame, empty).count() == len(ODD)
