"""Re-Pair blocks: nothing frequent is left, deep rules open on demand, words are told apart, other vocabularies."""

import random

import numpy as np

from ebbtide.llm import token_output
from ebbtide.llm.token_output import Block, WordEncoder, compress, vocabulary_path


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.2, 200_000).clip(max=3000).astype(np.uint32)
    counts = np.full(200, 1000)
    block = Block(compress(ids, counts))
    last = np.zeros(len(block.symbols), bool)
    last[np.append(block.firsts[1:].astype(int) - 1, len(last) - 1)] = True
    pairs = {}
    for a, b, end in zip(block.symbols[:-1].tolist(), block.symbols[1:].tolist(), last[:-1]):
        if not end:
            pairs[a, b] = pairs.get((a, b), 0) + 1
    assert max(pairs.values()) < token_output.LEAST_COUNT
    assert np.array_equal(block.ids(), ids)
    lengths = [1] * len(block.terminals)
    for a, b in block.rules.tolist():
        lengths.append(lengths[a] + lengths[b])
    assert lengths == block.lengths.tolist()


def test_long_rules_open_on_demand():
    ids = np.tile(np.arange(50, dtype=np.uint32), 4000)
    block = Block(compress(ids, np.array([len(ids) // 2, len(ids) // 2])))
    assert block.lengths.max() > 1000 and len(block.flat) < len(ids) / 10
    rng = random.Random(4)
    for _ in range(200):
        a = rng.randrange(len(ids))
        b = rng.randrange(a, min(len(ids), a + 5000) + 1)
        assert np.array_equal(block.ids(a, b), ids[a:b])


def test_forgotten_words_are_learned_again():
    rng = random.Random(2)
    texts = [" ".join(f"w{chr(97 + rng.randrange(26))}{rng.randrange(900)}, é{rng.randrange(50)}." for _ in range(60)) for _ in range(60)]
    encoder = WordEncoder(vocabulary_path(), cached=200)
    for t in texts:
        ids, _ = encoder.encode([t.encode()])
        assert ids.tolist() == [*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 1]
        assert len(encoder.codes) == len(encoder.lengths) == len(encoder.uses)


def test_words_of_one_hash_are_told_apart(monkeypatch):
    """With a hash that is the same for all words of three bytes."""
    monkeypatch.setattr(token_output, "mixed", lambda x: x & np.uint64(0))
    encoder = WordEncoder(vocabulary_path())
    text = "one two, one six long words. of two one"
    assert encoder.encode([text.encode()])[0].tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 1]


def marked_texts():
    rng = random.Random(6)
    pieces = ["a", "Word", "é", "ñ", "×", "÷", "İ", "ſ", "日", "\u0301", "7", "½", "'", "'s", ".", ",", "$$$", "***", "(", ")", "_", "<", "|", ">", "\\", "`",
              "<|endoftext|>", "<|startoftext|>", " ", " ", " ", "\n", "\t", "\x0b", "\x1c", "\x85", "\u00a0", "\x00", "x" * 70, "y" * 64 + "z", "ab" * 6]
    return ["".join(rng.choices(pieces, k=rng.randrange(30))) for _ in range(3000)]


def expect_whole_texts(encoder, texts, size=50):
    for k in range(0, len(texts), size):
        part = texts[k : k + size]
        ids, counts = encoder.encode([t.encode() for t in part])
        whole = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in part]
        assert ids.tolist() == [i for w in whole for i in w] and counts.tolist() == [len(w) for w in whole]


def test_marks_behind_words_change_nothing():
    expect_whole_texts(WordEncoder(vocabulary_path(), cached=600), marked_texts())


def test_few_hashes_for_many_words(monkeypatch):
    """Hashes of words that share slots, and words that share hashes."""
    monkeypatch.setattr(token_output, "mixed", lambda x: x % np.uint64(1500) * np.uint64(1 << 15))
    encoder = WordEncoder(vocabulary_path())
    expect_whole_texts(encoder, marked_texts())
    assert len(encoder.found.hashes) <= 1500 < len(encoder.codes)


def test_marks_behind_a_word_make_no_other_word():
    encoder = WordEncoder(vocabulary_path())
    encoder.encode(["overall naïveté".encode()])
    known = len(encoder.codes)
    encoder.encode([f"overall{m} naïveté{m}\tNAïVETé{m}\n".encode() for m in ("$$$", "***", ",", "?!", "...")])
    assert len(encoder.codes) == known + 5


def test_known_words_are_found_at_once(monkeypatch):
    """Only words that are new are told apart and looked up one by one."""
    encoder, texts, looked_up = WordEncoder(vocabulary_path()), [t.encode() for t in marked_texts()], []
    first = encoder.encode(texts)
    monkeypatch.setattr(token_output, "_distinct", lambda *columns: looked_up.append(columns))
    assert all(np.array_equal(a, b) for a, b in zip(first, encoder.encode(texts))) and not looked_up


def test_another_vocabulary_gets_whole_texts():
    encoder = WordEncoder(vocabulary_path("byte_bpe_50k.json"))
    texts = ["Two  spaces,\n a line. ", "", None, "Ünï code"]
    ids, counts = encoder.encode([None if t is None else t.encode() for t in texts])
    whole = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert not encoder.by_words
    assert ids.tolist() == [i for w in whole for i in [*w, 1]] and counts.tolist() == [len(w) + 1 for w in whole]


def test_a_very_long_text(spark):
    """Ten million characters, with and without breaks."""
    words = " ".join(random.Random(1).choices(["of", "the", "Rhein,", "é", "12.", "x" * 30], k=1_500_000))[:10_000_000]
    docs = spark.createDataFrame([(1, words), (2, "a" * 1_000_000), (3, "b")], "doc_id long, text string")
    rows = token_output.write_and_read(docs).orderBy("doc_id").collect()
    tokenizer = WordEncoder(vocabulary_path()).tokenizer
    assert [r.n_tokens for r in rows] == [len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in (words, "a" * 1_000_000, "b")]
