"""Token-id output compressed by Re-Pair grammars, with random-access decoding.

Documents are sorted by id into range partitions.  Each task encodes its texts and packs them into
blocks of about `BLOCK_TOKENS` ids.  A block is one record of the stored table:

    shard, block     the partition and the place in it; (shard, block) is the order of the corpus
    n_tokens         ids in the block, so that prefix sums give every block's start
    doc_ids          its documents
    blob             magic "RPG1"; seven little-endian uint32: terminals, rules, symbols, documents,
                     bytes a symbol, reserved, reserved; then the arrays
                       terminals  uint32  the id of each terminal
                       rules      symbol  the two sides of each rule
                       lengths    uint32  how many ids each rule expands to
                       firsts     uint32  the first symbol of each document
                       symbols    symbol  the compressed sequence

Symbols below the number of terminals are terminals; symbol terminals + r is rule r, whose sides
are smaller symbols.  `lengths` let a reader find the symbols that cover any range of ids
without expanding what comes before (`decode`).

Re-Pair in rounds: count the adjacent pairs of the block, turn the most frequent ones into
nonterminals, replace them from left to right, repeat until no pair stands `LEAST_COUNT` times.  A round makes many
rules at once and no pair spans two documents.

Encoding splits a text at ASCII white space, and before marks that end a word, and asks the tokenizer once for each different word, as
no token of this vocabulary spans white space or the end of a run of letters; a cache of bounded size keeps the answers for
frequent words, which a batch finds by hash all at once.  Results are those of encoding whole
texts (tested).  A vocabulary with another normaliser or pre-tokeniser gets whole texts.
"""

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import known_to_workers, read_table, store
from ebbtide.llm.fingerprints import mixed

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
BLOCK_TOKENS, BATCH_BYTES = 1 << 20, 1 << 21
RULES_A_ROUND, LEAST_COUNT, SHORT = 4096, 8, 64
CACHED_WORDS = 600_000
_BINS = 18
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
# a run of these marks between a letter or digit and white space is a word of its own; special tokens have the others
_MARKS = np.isin(np.arange(256), [*b"!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"])
_BEFORE = np.isin(np.arange(256), [*b"abcdefghijklmnopqrstuvwxyz0123456789"])
# the second byte, after 0xC3, of the letters of Latin-1
_LATIN = np.isin(np.arange(256), [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])
_plain = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_USUAL_BYTES = 1 << 22
_END = b" "  # stands for the end of a document; no word holds a space
_HEADER = struct.Struct("<4s7I")
# fixed values: the normaliser and the pre-tokeniser whose tokens never span white space
_RELIED_ON = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}

BLOCKS = "shard int, block int, n_tokens long, doc_ids array<long>, blob binary"
TOKENS = "shard int, block int, doc_id long, start_in_block long, n_tokens long, ids_crc32 long"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for
    themselves, the others for the letters from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the texts, and start, end and text of each word therein.  Words stand between ASCII white space; marks
    that end one are a word of their own."""
    joined = np.frombuffer(b"\n".join([b"", *texts, *[b""] * 9]), np.uint8)
    space, marks = _SPACE[joined], _MARKS[joined]
    final = np.zeros(len(joined), bool)
    edges = np.flatnonzero(marks[1:] != marks[:-1]) + 1  # no text is at either end
    at, behind = edges[::2], edges[1::2]
    before = joined[at - 1]
    letter = _BEFORE[before] | (_LATIN[before] & (joined[at - 2] == 0xC3))
    final[at[letter & space[behind]]] = True
    starts = np.flatnonzero(~space[1:] & (space[:-1] | final[1:])) + 1
    ends = np.flatnonzero(~space[:-1] & (space[1:] | final[1:])) + 1
    bounds = np.cumsum([len(t) + 1 for t in texts]) + 1
    return joined, starts, ends, np.searchsorted(bounds, starts, "right")


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number and of its inverse, modulo 2^64; kept for a batch of usual size."""
    if len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    made = []
    for base in (_BASE, _INVERSE):
        factors = np.full(n + n // 4, base)
        factors[0] = 1
        made.append(np.multiply.accumulate(factors))
    if n <= _USUAL_BYTES:
        _powers[:] = made
    return made[0], made[1]


def span_hashes(joined: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from differences of one prefix sum."""
    power, inverse = _power(len(joined))
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined + np.uint64(1)) * power[: len(joined)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def _eights(of: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number."""
    return np.ndarray(len(of) - 7, "<u8", of, strides=(1,))


def _differ(a: np.ndarray, starts_a: np.ndarray, b: np.ndarray, starts_b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether a[start : start + length] and b[start : start + length] differ.  Both have eight bytes more than their spans."""
    eights_a, eights_b = _eights(a), _eights(b)
    out = (eights_a[starts_a] ^ eights_b[starts_b]) & _MASKS[np.minimum(lengths, 8)] != 0
    done, rows = 8, np.flatnonzero(lengths > 8)
    while len(rows) and done < 64:
        left = np.minimum(lengths[rows] - done, 8)
        out[rows] |= (eights_a[starts_a[rows] + done] ^ eights_b[starts_b[rows] + done]) & _MASKS[left] != 0
        done += 8
        rows = rows[lengths[rows] > done]
    n = lengths[rows] - done  # of long spans all the rest at once
    differs = gather(a, starts_a[rows] + done, n) != gather(b, starts_b[rows] + done, n)
    out[rows[np.repeat(np.arange(len(rows)), n)[differs]]] = True
    return out


def _distinct(joined: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different word, and the number of its word for every place.  Words are told apart by a 64-bit hash
    and then compared byte by byte with the word they are taken for; the few that differ count as words of their own."""
    _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    lengths = ends - starts
    alike = lengths == lengths[first[word]]
    other = np.flatnonzero(alike & (first[word] != np.arange(len(word))))
    alike[other[_differ(joined, starts[other], joined, starts[first[word[other]]], lengths[other])]] = False
    apart = np.flatnonzero(~alike)
    word[apart] = len(first) + np.arange(len(apart))
    return np.concatenate([first, apart]), word


class WordCodes:
    """The codes of known words, found by a 64-bit hash for all words of a batch at once.  A word is found only if all its
    bytes are those of the known one; of several words of one hash the first is held."""

    def __init__(self):
        self.slots = np.full(1 << 16, -1, np.int32)
        self.hashes, self.codes = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.bytes = np.zeros(8, np.uint8)  # of all words, one after the other, and eight more

    def _entries(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each hash, or -1."""
        last = len(self.slots) - 1
        slot = (hashes & np.uint64(last)).astype(np.intp)
        entry = self.slots[slot]
        left = np.arange(len(hashes))
        while len(left):  # where another hash holds the slot, the next one
            left = left[entry[left] >= 0]
            left = left[self.hashes[entry[left]] != hashes[left]]
            slot[left] = (slot[left] + 1) & last
            entry[left] = self.slots[slot[left]]
        return entry

    def find(self, joined: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The code of each word, or -1."""
        entry, lengths = self._entries(hashes), ends - starts
        held = np.flatnonzero(entry >= 0)
        held = held[self.lengths[entry[held]] == lengths[held]]
        held = held[~_differ(joined, starts[held], self.bytes, self.starts[entry[held]], lengths[held])]
        out = np.full(len(hashes), -1, np.int64)
        out[held] = self.codes[entry[held]]
        return out

    def add(self, joined: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, codes: np.ndarray) -> None:
        _, fresh = np.unique(hashes, return_index=True)
        fresh = fresh[self._entries(hashes[fresh]) < 0]
        lengths, before = (ends - starts)[fresh], len(self.hashes)
        self.hashes = np.concatenate([self.hashes, hashes[fresh]])
        self.codes = np.concatenate([self.codes, codes[fresh].astype(np.int32)])
        self.starts = np.concatenate([self.starts, len(self.bytes) - 8 + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
        self.bytes = np.concatenate([self.bytes[:-8], gather(joined, starts[fresh], lengths), np.zeros(8, np.uint8)])
        if 2 * len(self.hashes) > len(self.slots):
            self.slots, before = np.full(1 << (4 * len(self.hashes)).bit_length(), -1, np.int32), 0
        entry, last = np.arange(before, len(self.hashes), dtype=np.int32), len(self.slots) - 1
        slot = (self.hashes[entry] & np.uint64(last)).astype(np.intp)
        while len(entry):  # one entry gets a free slot, the others go on
            free = self.slots[slot] < 0
            self.slots[slot[free]] = entry[free]
            out = self.slots[slot] != entry
            entry, slot = entry[out], (slot[out] + 1) & last


class WordEncoder:
    """Encodes texts word by word with one tokenizer, remembering words.

    Beyond `cached` words those that were met least often since the last time are forgotten, half of them at least.  A
    tokenizer whose normaliser and pre-tokeniser are not those that words rely on gets whole texts instead."""

    def __init__(self, path: str, end_id: int = END_ID, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        self.by_words = all(made.get(k) == v for k, v in _RELIED_ON.items()) and made["model"].get("end_of_word_suffix") == "</w>"
        # for words that are one pre-token, already normalised and in the letters of the vocabulary
        self.plain.normalizer, self.plain.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.letters = {b: letter for b, letter in enumerate(_byte_letters()) if b != 32}  # words stay apart
        self.end_id, self.cached = end_id, cached
        self.codes: dict[bytes, int] = {_END: 0}
        self.ids = np.array([end_id], np.uint32)  # of all words, one after the other
        self.lengths = np.ones(1, np.int64)
        self.uses = np.ones(1, np.int64)
        self.found = WordCodes()

    def _forget(self) -> None:
        """Keep the words that were met most often, at most half of `cached`."""
        half = self.cached // 2
        least = max(2, int(np.partition(self.uses, -half)[-half]) + 1)
        keep = np.flatnonzero(self.uses >= least)
        keep = np.union1d(keep, [0])
        words = list(self.codes)
        starts = (np.cumsum(self.lengths) - self.lengths)[keep]
        self.lengths = self.lengths[keep]
        self.ids = gather(self.ids, starts, self.lengths)
        self.codes = {words[k]: i for i, k in enumerate(keep.tolist())}
        self.uses = np.zeros(len(keep), np.int64)
        self.found = WordCodes()  # fills again as words are met

    def _add(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.codes.update(zip(words, range(len(self.lengths), len(self.lengths) + len(words))))
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32, copy=False)])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int64)])

    def _learn(self, words: set[bytes]) -> None:
        """Remember words that are not known yet."""
        # ASCII letters, and letters of Latin-1, are normalised by lower-casing alone and make one pre-token
        plain = [w for w in words if w.isalpha() or _plain(w)]
        rest = words.difference(plain)
        tails = {}  # a letter before a final stop or comma ends a token
        for word in rest:
            if word[-1:] in (b".", b",") and (before := word[:-1]) and before.decode()[-1].lower()[-1].isalpha():
                tails[word] = before
        whole = {*tails.values()} | {w[-1:] for w in tails} | (rest - tails.keys())
        other = [w for w in whole.difference(plain) if w not in self.codes]
        found = self.plain.encode_batch_fast(
            [b" ".join(plain[k : k + 500]).decode().lower().encode().decode("latin-1").translate(self.letters)
             for k in range(0, len(plain), 500)], add_special_tokens=False,
        )
        ids = np.array([i for f in found for i in f.ids], np.int64)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) == len(plain):
            self._add(plain, ids, np.diff(ends, prepend=0))
        else:
            other += plain
        found = [f.ids for f in self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False)]
        self._add(other, np.array([i for f in found for i in f], np.int64), np.array([len(f) for f in found], np.int64))
        if tails:
            parts = np.array([self.codes[p] for word, before in tails.items() for p in (before, word[-1:])], np.int64)
            n = self.lengths[parts]
            ids = gather(self.ids, (np.cumsum(self.lengths) - self.lengths)[parts], n)
            self._add([*tails], ids, n[::2] + n[1::2])

    def encode(self, texts: Iterable[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, and how many each has.  Null is empty."""
        texts = [t or b"" for t in texts]
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if not self.by_words:
            found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
            ids = [np.array([*f.ids, self.end_id], np.uint32) for f in found]
            return np.concatenate(ids), np.array([len(i) for i in ids], np.int64)
        if len(self.codes) > self.cached:
            self._forget()
        # the strings of special tokens stand for themselves in lower case only
        joined, starts, ends, text = _words([t if b"<|" in t else t.lower() for t in texts])
        hashes = span_hashes(joined, starts, ends)
        codes = self.found.find(joined, starts, ends, hashes)
        new = np.flatnonzero(codes < 0)
        if len(new):
            first, word = _distinct(joined, starts[new], ends[new], hashes[new])
            first, content = new[first], joined.tobytes()
            words = [content[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            self._learn({w for w in words if w not in self.codes})
            learned = np.array([self.codes[w] for w in words], np.int64)
            codes[new] = learned[word]
            self.found.add(joined, starts[first], ends[first], hashes[first], learned)
        self.uses += np.bincount(codes, minlength=len(self.uses))
        # every text's words, then the end
        words_of = np.bincount(text, minlength=len(texts))
        picked = np.zeros(len(codes) + len(texts), np.int64)
        picked[np.arange(len(codes)) + text] = codes
        lengths = self.lengths[picked]
        ids = gather(self.ids, (np.cumsum(self.lengths) - self.lengths)[picked], lengths)
        place = np.cumsum(words_of + 1)
        return ids, np.add.reduceat(lengths, place - words_of - 1)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[start : start + length] of each pair, joined."""
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return values[shift + np.arange(len(shift))]


def compress(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """The blob of one block: `ids` of all its documents, `counts` of each (1 at least)."""
    used = np.flatnonzero(np.bincount(ids)) if len(ids) else np.zeros(0, np.int64)
    local = np.zeros(int(used[-1]) + 1 if len(used) else 0, np.uint32)
    local[used] = np.arange(len(used), dtype=np.uint32)
    symbols = local[ids]
    last = np.zeros(len(symbols), bool)  # a document ends here
    last[np.cumsum(counts) - 1] = True
    rules, lengths = [np.zeros((0, 2), np.int64)], np.ones(len(used), np.int64)
    # the places of pairs that may still be frequent: no pair of old symbols becomes more frequent
    active = np.flatnonzero(~last).astype(np.int32)
    of_bin = np.zeros(1 << _BINS, np.int64)
    while len(active):
        keys = _pairs(symbols, active)
        bins = _bins(keys)
        counted = np.bincount(bins, minlength=1 << _BINS)
        full = counted[counted >= LEAST_COUNT]
        floor = np.partition(full, -RULES_A_ROUND)[-RULES_A_ROUND] if len(full) > RULES_A_ROUND else LEAST_COUNT
        hot = (counted >= floor)[bins]
        places, keys, active, bins = active[hot], keys[hot], active[(counted >= LEAST_COUNT)[bins]], bins[hot]
        pairs = _frequent(keys)
        if not len(pairs) and floor > LEAST_COUNT:  # bins that only look full; all pairs then
            places, keys = active, _pairs(symbols, active)
            bins, pairs = _bins(keys), _frequent(keys)
        if not len(pairs):
            break
        pair_bins = _bins(pairs)
        of_bin[pair_bins] = np.arange(len(pairs))
        served = of_bin[pair_bins] == np.arange(len(pairs))  # a bin serves one pair a round
        pairs = pairs[served]
        of_bin[pair_bins[served]] = np.arange(len(pairs))
        rule = np.minimum(of_bin[bins], len(pairs) - 1)
        hit = pairs[rule] == keys
        at, rule = places[hit], rule[hit]
        # of overlapping pairs, every other one from the left
        run = np.concatenate(([True], np.diff(at) != 1))
        odd = (np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 1
        at, rule = at[~odd], rule[~odd]
        symbols[at] = len(lengths) + rule
        last[at] = last[at + 1]
        keep, near, new = np.ones(len(symbols), bool), np.zeros(len(symbols), bool), np.zeros(len(symbols), bool)
        keep[at + 1] = False
        near[active] = new[at] = True
        symbols, last, near, new = symbols[keep], last[keep], near[keep], new[keep]
        near |= new
        near[:-1] |= new[1:]
        active = np.flatnonzero(near & ~last).astype(np.int32)
        sides = np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], axis=1).astype(np.int64)
        rules.append(sides)
        lengths = np.concatenate([lengths, lengths[sides[:, 0]] + lengths[sides[:, 1]]])
    firsts = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1)) if len(counts) else np.zeros(0, np.int64)
    grammar = np.concatenate(rules)
    kind = np.dtype(np.uint32 if len(lengths) > 1 << 16 else np.uint16)
    header = _HEADER.pack(b"RPG1", len(used), len(grammar), len(symbols), len(counts), kind.itemsize, 0, 0)
    arrays = (used.astype(np.uint32), grammar.astype(kind), lengths[len(used) :].astype(np.uint32), firsts.astype(np.uint32), symbols.astype(kind))
    return header + b"".join(a.tobytes() for a in arrays)


def _pairs(symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (symbols[places].astype(np.uint64) << np.uint64(32)) | symbols[places + 1]


def _bins(keys: np.ndarray) -> np.ndarray:
    return ((keys * _BASE) >> np.uint64(64 - _BINS)).astype(np.intp)


def _frequent(keys: np.ndarray) -> np.ndarray:
    """The `RULES_A_ROUND` most frequent keys that stand `LEAST_COUNT` times at least, ascending."""
    pairs, n = np.unique(keys, return_counts=True)
    best = np.flatnonzero(n >= LEAST_COUNT)
    return pairs[np.sort(best[np.argsort(-n[best], kind="stable")[:RULES_A_ROUND]])]


class Block:
    """A stored block, opened for reading.  Only expansions of at most `SHORT` ids are kept; longer symbols are
    opened when they are read."""

    def __init__(self, blob: bytes):
        magic, terminals, rules, symbols, docs, width, _, _ = _HEADER.unpack_from(blob)
        if magic != b"RPG1":
            raise ValueError("not a block of this format")
        at, kind = _HEADER.size, np.uint16 if width == 2 else np.uint32

        def take(n, dtype):
            nonlocal at
            values = np.frombuffer(blob, dtype, n, at)
            at += values.nbytes
            return values

        self.terminals = take(terminals, np.uint32)
        self.rules = take(2 * rules, kind).reshape(-1, 2).astype(np.int64)
        lengths = take(rules, np.uint32)
        self.firsts = take(docs, np.uint32)
        self.symbols = take(symbols, kind)
        self.lengths = np.concatenate([np.ones(terminals, np.int64), lengths.astype(np.int64)])
        kept = np.where(self.lengths <= SHORT, self.lengths, 0)
        self.offsets = np.concatenate(([0], np.cumsum(kept)))
        #: short expansions, one after the other
        self.flat = np.zeros(self.offsets[-1], np.uint32)
        self.flat[:terminals] = self.terminals
        highest, start = self.rules.max(axis=1, initial=0), 0
        while start < rules:  # as many rules as need no other of them
            known = highest[start:] < terminals + start
            stop = rules if known.all() else start + int(np.argmin(known))
            short = kept[terminals + start : terminals + stop] > 0
            sides = self.rules[start:stop][short].ravel()
            self.flat[self.offsets[terminals + start] : self.offsets[terminals + stop]] = gather(self.flat, self.offsets[sides], kept[sides])
            start = stop
        #: the first id of each symbol, and the end
        self.starts = np.concatenate(([0], np.cumsum(self.lengths[self.symbols])))

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from `start` to `stop` of the block; only the symbols that cover them are expanded."""
        stop = int(self.starts[-1]) if stop is None else min(stop, int(self.starts[-1]))
        if stop <= start:
            return np.zeros(0, np.uint32)
        first = np.searchsorted(self.starts, start, "right") - 1
        end = np.searchsorted(self.starts, stop, "left")
        part = self.symbols[first:end].astype(np.int64)
        begin = int(self.starts[first])
        while (long := self.lengths[part] > SHORT).any():
            places = np.repeat(np.arange(len(part)), np.where(long, 2, 1))
            second = np.concatenate(([False], places[1:] == places[:-1]))
            opened = part[places]
            opens = long[places]
            opened[opens] = self.rules[opened[opens] - len(self.terminals), second[opens].astype(np.intp)]
            # what lies before or behind the range is left out
            begins = begin + np.cumsum(self.lengths[opened]) - self.lengths[opened]
            inside = (begins < stop) & (begins + self.lengths[opened] > start)
            part, begin = opened[inside], int(begins[inside][0])
        out = gather(self.flat, self.offsets[part], self.lengths[part])
        return out[start - begin : stop - begin]

    def documents(self) -> np.ndarray:
        """The first id of each document, and the end."""
        return np.concatenate([self.starts[self.firsts], self.starts[-1:]])


_encoders: dict[tuple[str, int, int], WordEncoder] = {}


def encode_blocks(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                  vocabulary: str | None = None, end_id: int = END_ID,
                  block_tokens: int = BLOCK_TOKENS, cached: int = CACHED_WORDS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The blocks of `docs` in ascending order of the id (null first; equal ids in the order of their texts'
    hashes).  Null texts are empty; a document is never cut, so a block ends after the document that fills it.  A Python worker
    remembers about `cached` words, some 150 bytes each, beyond the task."""
    known_to_workers(docs.sparkSession)
    path = vocabulary or vocabulary_path()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = path, end_id, cached
        encoder = _encoders.get(kept) or _encoders.setdefault(kept, WordEncoder(*kept))
        shard, block = TaskContext.get().partitionId(), 0
        names, ids, counts = [], np.zeros(0, np.uint32), np.zeros(0, np.int64)

        def record(n: int) -> pa.RecordBatch:
            """The block of the first n documents, which leave the buffers."""
            nonlocal names, ids, counts, block
            held = int(counts[:n].sum())
            columns = [[shard], [block], [held], [names[:n]], [compress(ids[:held], counts[:n])]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            names, ids, counts, block = names[n:], ids[held:], counts[n:], block + 1
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)],
                                   ["shard", "block", "n_tokens", "doc_ids", "blob"])

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            at = 0
            while at < len(doc_ids):
                stop, size = at, 0
                while stop < len(doc_ids) and (stop == at or size < batch_bytes):
                    size += _size(texts, stop) + 1
                    stop += 1
                found, n = encoder.encode(texts[at:stop].to_pylist())
                names += doc_ids[at:stop]
                ids, counts = np.concatenate([ids, found]), np.concatenate([counts, n])
                at = stop
                while len(ids) >= block_tokens:
                    yield record(int(np.searchsorted(np.cumsum(counts), block_tokens)) + 1)
        if names:
            yield record(len(names))

    keyed = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text).alias("_text"))
    ordered = keyed.repartitionByRange(F.col("_id").asc_nulls_first()).sortWithinPartitions(
        F.col("_id").asc_nulls_first(), F.xxhash64("_text")
    )
    return ordered.mapInArrow(blocks, BLOCKS)


def _size(texts: pa.Array, i: int) -> int:
    return texts[i].as_buffer().size if texts[i].is_valid else 0


def read_documents(blocks: DataFrame) -> DataFrame:
    """Per document of stored blocks: its first id's place in the block, its number of ids and their unsigned CRC-32."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, block, names, blob in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3, 4))):
                opened = Block(blob)
                ids = opened.ids().astype("<u4", copy=False)
                bounds = opened.documents()
                crc = [zlib.crc32(ids[a:b].data) for a, b in zip(bounds[:-1], bounds[1:])]
                n = len(names)
                yield pa.record_batch(
                    [pa.array(np.full(n, shard, np.int32)), pa.array(np.full(n, block, np.int32)),
                     pa.array(names, pa.int64()), pa.array(bounds[:-1], pa.int64()),
                     pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())],
                    ["shard", "block", "doc_id", "start_in_block", "n_tokens", "ids_crc32"],
                )

    return blocks.mapInArrow(documents, TOKENS)


def block_starts(blocks: DataFrame) -> DataFrame:
    """(shard, block, block_start): the ids before each block, summed first over shards, then in
    each shard, so that no window holds more rows than there are shards or a shard has blocks."""
    sizes = blocks.select("shard", "block", "n_tokens")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start")
    )
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("in_shard", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(
        shards, "shard"
    ).select("shard", "block", (F.col("shard_start") + F.col("in_shard")).alias("block_start"))


def write_and_read(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Write the blocks, read them back: doc_id, start (ids of all documents before it), n_tokens and ids_crc32."""
    blocks = store(encode_blocks(docs, id_column, text, **options), "tokens")
    found = read_documents(blocks).join(block_starts(blocks), ["shard", "block"])
    return found.select(
        "doc_id", (F.col("block_start") + F.col("start_in_block")).alias("start"), "n_tokens", "ids_crc32"
    )


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`write_and_read` of all documents.  A null or empty text has the end id alone; documents without id come first, repeated
    rows are documents of their own, in the order of their texts' hashes; other columns take no part; no rows give none."""
    return write_and_read(read_table(spark, sf_dir, "documents"))
