"""SimHash against brute force over all pairs; the near-duplicate stage against exact similarities; the pipeline."""

import collections
import random
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from ebbtide.llm import decontamination, line_dedup, mixing, simhash, token_output, toxicity
from ebbtide.llm.common import components, read_table, store

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint_by_the_book():
    text = "A b\tc  D e\nb c d e f"
    words = "a b c d e b c d e f".encode().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    bits = sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))
    assert simhash.fingerprint(text) == bits
    assert simhash.fingerprint("A b") == xxhash.xxh64_intdigest(b"a b", 42)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_links_are_those_of_all_pairs(spark):
    """Dense clusters, chains, isolated values and every kind of three flipped bits."""
    rng = random.Random(3)
    values = set()
    for _ in range(60):
        v = rng.getrandbits(64)
        values.add(v)
        for _ in range(12):
            w = v
            for b in rng.sample(range(64), rng.randrange(0, 6)):
                w ^= 1 << b
            values.add(w)
    values |= {0, 1 << 63, (1 << 64) - 1, 7, (1 << 64) - 8, 3 << 62}
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    found = components(simhash.links(spark.createDataFrame([(v,) for v in signed] + [(None,)], "fp long"))).collect()
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    expected = {n: r for n, r in roots(signed, pairs).items() if any(n in p for p in pairs)}
    assert {r.node: r.component for r in found} == expected


def test_components_of_chains_and_stars(spark):
    chain = [(k + 1, k) for k in range(100)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5)]
    random.Random(1).shuffle(chain)
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(101)}, **{k: 1000 for k in range(1000, 1100)}}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_query_against_all_pairs(spark):
    rows = simhash.op6_simhash(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in read_table(spark, SMALL, "documents").collect()}
    prints = {i: simhash.fingerprint(t) for i, t in texts.items()}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {r.doc_id: r.component_id for r in rows} == roots(prints, pairs)
    assert all(int(r.fingerprint, 16) == prints[r.doc_id] and len(r.fingerprint) == 16 for r in rows)


def test_empty_null_and_repeated_rows(spark):
    docs = [(4, None), (2, ""), (None, " \t"), (7, "x"), (7, "x"), (None, "only one"), (None, "only one")]
    rows = simhash.near_duplicates(spark.createDataFrame(docs, DOCS)).collect()
    ids = collections.Counter((r.doc_id, r.fp == 0, r.component_id) for r in rows)
    assert ids == {(4, True, 2): 1, (2, True, 2): 1, (None, True, 2): 1, (7, False, 7): 2, (None, False, None): 2}
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).isEmpty()


def near_copies(rng, words, changes):
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def test_keep_one_keeps_one_of_each_component(spark):
    """Exact copies, near copies and texts of their own: of what all pairs of fingerprints link, the smallest id stays."""
    rng = random.Random(5)
    docs = []
    for g in range(40):
        words = [f"v{rng.randrange(3000)}" for _ in range(400)]
        texts = [" ".join(words), " ".join(words).upper(), near_copies(rng, words, 1), near_copies(rng, words, 3)]
        docs += [(len(docs) + k, t, "x", g) for k, t in enumerate(texts[: 1 + g % 4])]
    docs += [(500, None, "y", -1), (501, "", "y", -1), (None, "", "y", -1), (500, "", "z", -2)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, _hash string, hash long")
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    prints = [simhash.fingerprint(d[1]) for d in docs]
    pairs = [(a, b) for a in range(len(docs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = roots(range(len(docs)), pairs)
    assert 40 < len(set(root.values())) < 100
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(
        min(docs[i][0] for i in range(len(docs)) if root[i] == r and docs[i][0] is not None) for r in set(root.values())
    )
    # rows come out as they went in
    assert {tuple(r) for r in kept.collect()} <= {tuple(d) for d in docs}
    assert simhash.keep_one(frame.limit(0)).isEmpty()


def shingle_likeness(a, b):
    x, y = simhash._shingles(a), simhash._shingles(b)
    return len(x & y) / len(x | y)


LENGTHS = [(10, 40), (40, 80), (80, 150), (150, 300), (300, 700)]


@pytest.mark.parametrize("length", LENGTHS)
def test_near_copies_of_every_length_are_found(spark, length):
    """Random words replaced until the similarity is between 0.80 and 0.95, in every band of similarity."""
    rng = random.Random(length[0])
    pairs, wanted = [], collections.Counter()
    while min(wanted[k] for k in range(3)) < 20:
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.randrange(*length))]
        a, b = " ".join(words), near_copies(rng, words, rng.randrange(1, 3 + len(words) // 30))
        cell = np.digitize(shingle_likeness(a, b), [0.8, 0.84, 0.9, 0.95]) - 1
        if 0 <= cell < 3 and wanted[cell] < 20:
            wanted[cell] += 1
            pairs.append((2 * len(pairs), a, 2 * len(pairs) + 1, b))
    texts = [(p[k], p[k + 1]) for p in pairs for k in (0, 2)]
    found = simhash.similar_texts(spark.createDataFrame(texts, "hash long, text string")).collect()
    assert {(min(r), max(r)) for r in found} == {(p[0], p[2]) for p in pairs}


def test_classes_of_a_crowd_are_those_of_all_pairs(spark):
    """Copies of copies, short and long, that are like some of their group but not like its hub."""
    rng = random.Random(11)
    texts = []
    for size in (30, 60, 200):
        family = [[f"v{rng.randrange(3000)}" for _ in range(size)]]
        for _ in range(60):
            family.append(near_copies(rng, rng.choice(family), rng.randrange(1, max(2, size // 30))).split())
        texts += [" ".join(f) for f in family]
    texts = list(dict.fromkeys(texts))
    near = [(a, b) for a in range(len(texts)) for b in range(a) if simhash._jaccard_at_least(texts[a], texts[b], 0.8)]
    frame = spark.createDataFrame(list(enumerate(texts)), "hash long, text string")
    found = components(simhash.similar_texts(frame)).collect()
    expected = {n: r for n, r in roots(range(len(texts)), near).items() if any(n in p for p in near)}
    assert {r.node: r.component for r in found} == expected


def test_unlike_texts_of_one_fingerprint_do_not_meet_each_other(spark, monkeypatch):
    """Orders of the same words have the same word fingerprints: each meets the hub, and no pass joins their pairs."""
    rng = random.Random(6)
    words = [f"v{k}" for k in range(100)]
    texts = [(k, " ".join(rng.sample(words, 100))) for k in range(80)]
    pairs, stored = [], simhash.store

    def noted(df, label, *options):
        if label == "near-pairs":
            pairs.append((df.count(), df._jdf.queryExecution().analyzed().toString()))
        return stored(df, label, *options)

    monkeypatch.setattr(simhash, "store", noted)
    assert simhash.similar_texts(spark.createDataFrame(texts, "hash long, text string")).isEmpty()
    (first, _), (second, plan) = pairs
    assert first == 79 and second == 0
    assert "meet#" not in plan and "key#" in plan


def test_jaccard_is_exact():
    a, b = " ".join(map(str, range(50))), " ".join(map(str, [*range(49), "x"]))
    x, y = simhash._shingles(a), simhash._shingles(b)
    exact = len(x & y) / len(x | y)
    assert simhash._jaccard_at_least(a, b, exact) and not simhash._jaccard_at_least(a, b, exact + 0.001)


def test_pipeline_stage_by_stage(spark):
    """Every stage against its plain version, on all that the one before has kept."""
    docs = read_table(spark, SMALL, "documents")
    names, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights",
                            "token-ID / binary output"]

    def kept(name):
        out = store(stages[name](spark, docs, SMALL), "test")
        return out, sorted(r.doc_id for r in out.collect())

    scores = {r.doc_id: r.score for r in toxicity.score(docs.select("doc_id", "text"), read_table(spark, SMALL, "labels")).collect()}
    docs, ids = kept("toxicity")
    assert docs.columns == names and ids == sorted(i for i, s in scores.items() if s < 0.5) and len(ids) < len(scores)

    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: simhash.fingerprint(t) for i, t in texts.items()}
    root = roots(texts, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    docs, ids = kept("SimHash near-dedup")
    assert docs.columns == names and ids == sorted(set(root.values())) and len(ids) < len(texts)

    texts = {r.doc_id: r.text for r in docs.collect()}
    windows = set()
    for r in read_table(spark, SMALL, "benchmark").collect():
        w = decontamination.words_of(r.text.encode())
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9)) if w}

    def clean(text):
        w = decontamination.words_of((text or "").encode())
        return not any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))

    docs, ids = kept("benchmark decontamination")
    assert docs.columns == names and ids == sorted(i for i, t in texts.items() if clean(t)) and len(ids) < len(texts)

    taken = {(r.doc_id): r.taken for r in mixing.mix(docs).collect()}
    docs, ids = kept("mixing sources to target weights")
    words = collections.Counter()
    for r in docs.collect():
        words[r.doc_id] += len(r.text.split())
    assert docs.columns == names and words == {i: n for i, n in taken.items() if n}

    ordered = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda d: d[0])
    tokenizer = token_output.WordEncoder(token_output.vocabulary_path()).tokenizer
    found = stages["token-ID / binary output"](spark, docs, SMALL).orderBy("start").collect()
    assert [r.doc_id for r in found] == [i for i, _ in ordered]
    crc = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for _, t in ordered]
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == collections.Counter(
        (i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), x in zip(ordered, crc)
    )
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]


CLASHING = "doc_id long, text string, source string, _hash string, _near int, _copy string, _dropped int, _contamination string, " \
           "hash string, score int, near int, id int, fp int, class int, at int, row string, found int, component_id int"


def test_columns_of_any_name_keep_their_values(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(f"v{rng.randrange(999)}" for _ in range(60)), "s", *(f"{k}" if t.endswith("string") else k for t in CLASHING.split(", ")[3:]))
            for k in range(30)]
    frame = spark.createDataFrame(rows, CLASHING)
    every = {tuple(r) for r in rows}
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, toxic int")
    outs = [
        simhash.keep_one(frame), toxicity.below(frame, labels, 2.0), line_dedup.deduplicated(frame),
        decontamination.decontaminate(frame, spark.createDataFrame([("i", "something else altogether")], "item_id string, text string")),
    ]
    for out in outs:
        assert out.columns == frame.columns
        assert {tuple(r) for r in out.collect()} == every


def test_mixed_documents_hold_the_words_taken(spark):
    docs = read_table(spark, SMALL, "documents")
    rows = mixing.mixed_documents(docs).collect()
    words = collections.Counter()
    for r in rows:
        words[r.source] += len(r.text.split())
    plan = mixing.mix(docs).collect()
    taken = collections.Counter()
    for r in plan:
        taken[r.source] += r.taken
    assert words == taken
    assert all(abs(taken[r.source] - r.target) < 1 for r in plan)


@pytest.mark.parametrize("seeds", [(1,), (1, 2, 3)])
def test_word_fingerprints_do_not_depend_on_the_batch(seeds):
    texts = [b"a b c a", b"", b"The THE the", "é è 12".encode()]
    together = simhash.word_fingerprints(texts, seeds)
    assert np.array_equal(together, np.concatenate([simhash.word_fingerprints([t], seeds) for t in texts]))
    assert together.shape == (4, len(seeds)) and not together[1].any()
