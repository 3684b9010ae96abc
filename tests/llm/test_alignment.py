"""Alignment of two tokenizers against a plain walk over both, and the counting by runs against a counter."""

import collections
import hashlib
import random

import numpy as np
import pytest

from ebbtide.llm import alignment
from ebbtide.llm.common import read_table

SMALL = "/root/testdata/sf0.001"
ODD = ["", None, " ", "  two  spaces\n\n x \t.", "a▁b c", "<|endoftext|> <s> <0x41> </s>", "é ü ñ 　x", "it's 1990, don't", "\x00 a",
       "x" * 300, "\n\n", "ab ", " ab", "日本 語", "a ́b", "1 2 3 44 5"]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(alignment.vocabulary_path(alignment.BYTE_VOCABULARY), alignment.vocabulary_path(alignment.PIECE_VOCABULARY), known=400)


def token_bytes(of, i):
    return of.bytes[of.starts[i] : of.starts[i] + of.lengths[i]].tobytes()


def walk(aligner, text):
    """(n_a, n_b, n_groups, n_links, digest) and the links of one text."""
    if not text:
        return (0, 0, 0, 0, ""), []
    a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    spell_a, spell_b = [token_bytes(aligner.bytes_a, i) for i in a], [token_bytes(aligner.bytes_b, i) for i in b]
    if not b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode():
        return (0, 0, 0, 0, ""), []
    links, groups, i, j, end_a, end_b, start_a, start_b = [], [], 0, 0, len(spell_a[0]), len(spell_b[0]), 0, 0
    while i < len(a):
        links.append((b[j], a[i]))
        if end_a == end_b:
            groups.append(",".join(map(str, a[start_a : i + 1])) + "|" + ",".join(map(str, b[start_b : j + 1])))
            start_a, start_b = i + 1, j + 1
        step_a, step_b = end_a <= end_b, end_b <= end_a
        if step_a:
            i += 1
            end_a += len(spell_a[i]) if i < len(a) else 0
        if step_b:
            j += 1
            end_b += len(spell_b[j]) if j < len(b) else 0
    return (len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()), links


def test_units_give_what_whole_texts_give(spark, aligner):
    texts = [*ODD, *(r.text for r in read_table(spark, SMALL, "documents").collect())]
    for k in range(0, len(texts), 30):
        part = texts[k : k + 30]
        counts, digests, pairs, owner = aligner.read(part)
        for n, text in enumerate(part):
            expected, links = walk(aligner, text)
            assert (*counts[n].tolist(), digests[n]) == expected
            assert collections.Counter((int(p) >> 32, int(p) & 0xFFFFFFFF) for p in pairs[owner == n]) == collections.Counter(links)


def edged_texts():
    """Texts that begin and end with white space or marks; all are spelled, so that units are encoded together."""
    rng = random.Random(8)
    return ["".join(rng.choices([" ", "  ", "a", "b", "\n", "\t", ".", "é", "\u0301", "\u00a0", "嫫", "\x85", "'s"], k=rng.randrange(1, 9))) for _ in range(400)]


def test_white_space_at_the_ends_of_a_text_stays_in_it(aligner):
    texts = ["b \n a ", "\n c", "a  ", "  x", *edged_texts()]
    for k in range(0, len(texts), 40):
        part = texts[k : k + 40]
        counts, digests, pairs, owner = aligner.read(part)
        for n, text in enumerate(part):
            expected, links = walk(aligner, text)
            assert (*counts[n].tolist(), digests[n]) == expected
            assert collections.Counter((int(p) >> 32, int(p) & 0xFFFFFFFF) for p in pairs[owner == n]) == collections.Counter(links)


def by_the_contract(docs):
    """The rows from token entries and pieces, all byte ranges against all."""
    import sentencepiece
    from tokenizers import Tokenizer

    from ebbtide.llm.token_output import _byte_letters

    a_of = Tokenizer.from_file(alignment.vocabulary_path(alignment.BYTE_VOCABULARY))
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=alignment.vocabulary_path(alignment.PIECE_VOCABULARY))
    letter = {c: b for b, c in enumerate(_byte_letters())}

    def spans(spelled):
        ends = np.cumsum([len(x) for x in spelled]).tolist()
        return list(zip([0, *ends], ends))

    every, count, rows = [], collections.Counter(), []
    for i, text in docs:
        a = a_of.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        spell_a = [bytes(letter[c] for c in a_of.id_to_token(x)) for x in a]
        spell_b = [bytes([int(b_of.id_to_piece(x)[3:5], 16)]) if b_of.is_byte(x) else b_of.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not text or not b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode():
            a, b, spell_a, spell_b = [], [], [], []
        span_a, span_b = spans(spell_a), spans(spell_b)
        links = [(y, x) for x, (s, e) in zip(a, span_a) for y, (t, f) in zip(b, span_b) if s < f and t < e]
        cuts = sorted({e for _, e in span_a} & {f for _, f in span_b})
        groups = [
            ",".join(str(x) for x, (_, e) in zip(a, span_a) if low < e <= high) + "|"
            + ",".join(str(y) for y, (_, f) in zip(b, span_b) if low < f <= high)
            for low, high in zip([0, *cuts], cuts)
        ]
        count.update(links)
        every.append((i, len(a), len(b), links, groups))
    best = {}
    for (y, _), n in count.items():
        best[y] = max(best.get(y, 0), n)
    for i, n_a, n_b, links, groups in every:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        rows.append((i, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), digest))
    return rows


def test_edges_of_texts_in_the_whole_operator(spark):
    docs = list(enumerate([*edged_texts(), *ODD]))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    found = alignment.aligned(frame, chunk_bytes=2000).collect()
    assert sorted(map(tuple, found)) == by_the_contract(docs)


def test_other_vocabularies_get_whole_texts(aligner):
    aligner.by_units, before = False, aligner.by_units
    try:
        for text in ODD:
            counts, digests, _, _ = aligner.read([text])
            assert (*counts[0].tolist(), digests[0]) == walk(aligner, text)[0]
    finally:
        aligner.by_units = before


def test_merged_runs_are_a_counter(monkeypatch):
    monkeypatch.setattr(alignment, "FAN_IN", 3)
    rng, every, merger = random.Random(1), collections.Counter(), alignment.Merger()
    for _ in range(40):
        run = collections.Counter((rng.randrange(6) << 32) | rng.randrange(30) for _ in range(rng.randrange(1, 60)))
        every += run
        keys = sorted(run)
        merger.add(alignment.pack_pairs(np.array(keys, np.uint64), np.array([run[k] for k in keys])))
    assert all(len(held) <= 3 for held in merger.levels)
    totals, best = merger.result()
    pairs, n = alignment.unpack_pairs(totals)
    assert pairs.tolist() == sorted(every) and dict(zip(pairs.tolist(), n.tolist())) == dict(every)
    ids, most = alignment.unpacked(best)
    assert dict(zip(ids.tolist(), most.tolist())) == {b: max(v for k, v in every.items() if k >> 32 == b) for b in ids.tolist()}


def expected_rows(aligner, docs):
    walked = [walk(aligner, t) for _, t in docs]
    count = collections.Counter(link for _, links in walked for link in links)
    best = {}
    for (b, _), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (i, *found[:4], sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), found[4])
        for (i, _), (found, links) in zip(docs, walked)
    ]


def KEY(row):
    return tuple((x is None, x) for x in row)


def test_query_is_the_plain_version(spark, aligner):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SMALL, "documents").collect()]
    rows = alignment.op12_alignment(spark, SMALL)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, rows.collect()), key=KEY) == sorted(expected_rows(aligner, docs), key=KEY)


def test_small_chunks_odd_rows_and_other_columns(spark, aligner):
    rng = random.Random(5)
    docs = [(k, t) for k, t in enumerate(ODD)] + [(None, "a b a"), (None, None), (7, "a b a"), (7, "a b a")]
    docs += [(100 + k, " ".join(rng.choices(["the", "of", "Rhein", "überall", "x1"], k=rng.randrange(200)))) for k in range(150)]
    frame = spark.createDataFrame([(i, t, 1, "p") for i, t in docs], "doc_id long, text string, radix int, pairs string").repartition(5)
    found = alignment.aligned(frame, radix_bytes=1000, chunk_bytes=2000).collect()
    assert sorted(map(tuple, found), key=KEY) == sorted(expected_rows(aligner, docs), key=KEY)
    assert alignment.aligned(frame.limit(0)).isEmpty()
    nothing = alignment.aligned(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in nothing] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_a_very_long_text(spark, aligner):
    text = " ".join(random.Random(3).choices(["of", "the", "Rhein,", "é", "12.", "y" * 40], k=1_000_000))
    rows = alignment.aligned(spark.createDataFrame([(1, text), (2, "z" * 200_000)], "doc_id long, text string")).collect()
    assert sorted(map(tuple, rows)) == expected_rows(aligner, [(1, text), (2, "z" * 200_000)])
