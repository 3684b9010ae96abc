"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and how often, by external spill counting.

Tokenizer A reads a space and the text, tokenizer B the text alone and adds the space itself.  Both spell the same bytes;
where tokens of both end, the text is cut into groups, and every two tokens whose byte ranges overlap are a link.  A pair of ids
counts how many links of the corpus hold it.

Units.  Neither vocabulary has a token that goes on behind the space between two words, so texts are cut there and each different unit
is encoded and aligned once; a bounded memo keeps frequent units.  Vocabularies for which that does not hold get
whole texts.

Counting, in three passes over stored tables:

1. Tasks cut their documents into chunks of about `CHUNK_BYTES`.  A chunk's records (pair, document, times) are sorted by pair, B's
   id first, and radix-partitioned by a hash of the pair into runs, compressed with zstd; a run holds the pairs with
   their counts in the chunk, and apart from them the documents of each pair.
2. A radix's runs meet in one task, pairs only.  A k-way heap merge by B's id sums each pair; at most `FAN_IN` runs are open at a
   time, and merged runs are merged again, so that memory is bounded by the pairs that two vocabularies can form.  In
   this order the pairs of one B id follow each other, which gives its maximum in the radix as the merge goes along; the
   maxima of all radixes are a number per B id.
3. The sums stream back: a radix's sums come first, its runs follow one by one, and each gets the counts of its own pairs.  These
   return to their chunk, whose documents add them up.

A pair that all documents hold is one record per chunk, and a B id with a third of all links is spread over all
radixes, so nothing hot stays in one task.
"""

import hashlib
import heapq
import itertools
import os
import re
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import known_to_workers, read_table, store
from ebbtide.llm.fingerprints import mixed
from ebbtide.llm.token_output import _byte_letters, gather, vocabulary_path

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_BYTES, RADIX_BYTES, MOST_RADIXES = 1 << 22, 1 << 26, 1024
FAN_IN = 64
KNOWN_UNITS = 300_000
_TOGETHER = 200  # units that are encoded as one text
_CUT = re.compile(r" (?<=[!-~\w] )(?=[!-~\w])")
_joinable = re.compile(r"[!-~\w](?:.*[!-~\w])?", re.DOTALL).fullmatch  # a space before or behind it is a cut
# a space before a word belongs to the word's token, and nothing before it does
_RELIED_ON = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

RUNS = ("chunk long, radix int, pairs binary, records binary, "
        "docs array<struct<id:bigint, n_a:bigint, n_b:bigint, n_groups:bigint, n_links:bigint, groups_sha256:string>>")


class Vocabulary:
    """Bytes of each token, one after the other."""

    def __init__(self, tokens: list[bytes]):
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths


class Aligner:
    """Encodes and aligns texts unit by unit with both tokenizers, remembering units."""

    def __init__(self, path_a: str, path_b: str, known: int = KNOWN_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import json

        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        letters = {letter: b for b, letter in enumerate(_byte_letters())}
        names = {i: t for t, i in self.a.get_vocab().items()}
        self.bytes_a = Vocabulary([
            bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
            for t in (names.get(i, "") for i in range(max(names) + 1))
        ])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = Vocabulary([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ])
        with open(path_a, encoding="utf-8") as file:
            made = json.load(file)
        self.by_units = (
            made.get("normalizer") is None and made.get("pre_tokenizer") == _RELIED_ON
            and not any("▁" in p.lstrip("▁") for p in pieces) and self.b.encode("a b") == self.b.encode("a") + self.b.encode("b")
        )
        # ";id", ",id" and "|id" of every id, for the text of the groups
        top = max(len(names), len(pieces))
        self.top, self.spelled = top, Vocabulary([f"{c}{i}".encode() for c in ";,|" for i in range(top)])
        self.known = known
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.groups: list[bytes] = []  # the text of each unit's groups, with ";" before each
        #: tokens of A, tokens of B, groups, links and whether both spell the unit
        self.counts = np.zeros((0, 5), np.int64)
        self.pairs = np.zeros(0, np.uint64)  # B's id in the upper half, A's in the lower, of all links
        self.uses = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the units that were met most often, at most half of `known`."""
        half = self.known // 2
        keep = np.flatnonzero(self.uses >= max(2, int(np.partition(self.uses, -half)[-half]) + 1))
        units, groups, counts, pairs = list(self.codes), self.groups, self.counts, self.pairs
        starts = np.cumsum(counts[:, 3]) - counts[:, 3]
        self._clear()
        self._add([units[k] for k in keep], [groups[k] for k in keep], counts[keep], gather(pairs, starts[keep], counts[keep, 3]))

    def _add(self, units: list[str], groups: list[bytes], counts: np.ndarray, pairs: np.ndarray) -> None:
        self.codes.update(zip(units, range(len(self.groups), len(self.groups) + len(units))))
        self.groups += groups
        self.counts = np.concatenate([self.counts, counts])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.uses = np.concatenate([self.uses, np.zeros(len(units), np.int64)])

    def _learn(self, units: list[str]) -> None:
        size = _TOGETHER if self.by_units else 1
        # the ends of a text may be white space or marks, which would go on in a neighbour
        inner = list(filter(_joinable, units))
        parts = [inner[k : k + size] for k in range(0, len(inner), size)]
        parts += [[u] for u in units if not _joinable(u)]
        alone: list[str] = []
        while parts:  # what does not spell its bytes is tried unit by unit
            texts = [" ".join(p) for p in parts]
            ids_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
            ids_b = self.b.encode(texts, num_threads=1)
            good = self._spelled(texts, ids_a, ids_b)
            if good.any():
                picked = np.flatnonzero(good).tolist()
                self._align([u for k in picked for u in parts[k]], [ids_a[k] for k in picked], [ids_b[k] for k in picked])
            failed = [parts[k] for k in np.flatnonzero(~good).tolist()]
            alone += [p[0] for p in failed if len(p) == 1]
            parts = [[u] for p in failed if len(p) > 1 for u in p]
        if alone:
            self._add(alone, [b""] * len(alone), np.zeros((len(alone), 5), np.int64), np.zeros(0, np.uint64))

    def _spelled(self, texts: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> np.ndarray:
        """Whether the tokens of both spell a space and the text."""
        wanted = [b" " + t.encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.array([len(w) for w in wanted], np.int64)
        good = np.ones(len(texts), bool)
        for ids, of in ((ids_a, self.bytes_a), (ids_b, self.bytes_b)):
            flat = np.array([i for x in ids for i in x], np.int64)
            owner = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
            good &= np.bincount(owner, of.lengths[flat], minlength=len(ids)).astype(np.int64) == sizes
            flat, owner = flat[good[owner]], owner[good[owner]]
            if len(flat):
                held = np.flatnonzero(good)
                spelled = gather(of.bytes, of.starts[flat], of.lengths[flat])
                differs = spelled != np.frombuffer(b"".join([wanted[k] for k in held.tolist()]), np.uint8)
                good[np.repeat(held, sizes[held])[differs]] = False
        return good

    def _align(self, units: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> None:
        """Remember units, given the ids of all of them, which spell their bytes."""
        a, b = (np.array([i for x in ids for i in x], np.int64) for ids in (ids_a, ids_b))
        ends_a, ends_b = np.cumsum(self.bytes_a.lengths[a]), np.cumsum(self.bytes_b.lengths[b])
        # a space and the unit's bytes
        bounds = np.cumsum([len(u.encode("utf-8", "surrogatepass")) + 1 for u in units])
        unit_of = lambda ends: np.searchsorted(bounds, ends, "left")
        every = np.union1d(ends_a, ends_b)  # each range between two ends is covered by one token of either
        pairs = (b[np.searchsorted(ends_b, every)].astype(np.uint64) << np.uint64(32)) | a[np.searchsorted(ends_a, every)].astype(np.uint64)
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        n = len(units)
        counts = np.stack([np.bincount(unit_of(e), minlength=n) for e in (ends_a, ends_b, common, every)] + [np.ones(n, np.int64)], axis=1)
        # the groups as text: A's ids of a group, then B's
        group = np.concatenate([np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((side, group))  # stable: tokens stay in their order
        group, side, ids = group[order], side[order], np.concatenate([a, b])[order]
        fresh_group = np.diff(group, prepend=-1) != 0
        fresh_side = np.diff(side, prepend=1) != 0
        mark = np.where(fresh_group, 0, np.where(fresh_side, 2, 1)) * self.top + ids
        lengths = self.spelled.lengths[mark]
        text = gather(self.spelled.bytes, self.spelled.starts[mark], lengths).tobytes()
        size = np.bincount(unit_of(common[group]), lengths, minlength=n).astype(np.int64)
        stops = np.cumsum(size).tolist()
        self._add(units, [text[i - j : i] for i, j in zip(stops, size.tolist())], counts, pairs)

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of each text the tokens of A, the tokens of B, groups and links, and the digest of its groups; the pair and
        the text of each link.  A text that is empty or not spelled by both has no tokens."""
        if len(self.codes) > self.known:
            self._forget()
        units = [(_CUT.split(t) if self.by_units else [t]) if t else [] for t in texts]
        sizes = np.array([len(u) for u in units], np.int64)
        flat = [u for part in units for u in part]
        known = list(map(self.codes.get, flat))
        new = [k for k, code in enumerate(known) if code is None]
        if new:
            self._learn(list(dict.fromkeys(flat[k] for k in new)))
            for k in new:
                known[k] = self.codes[flat[k]]
        codes, owner = np.array(known, np.int64), np.repeat(np.arange(len(texts)), sizes)
        self.uses += np.bincount(codes, minlength=len(self.uses))
        counts = np.zeros((len(texts), 4), np.int64)
        good = (np.bincount(owner, 1 - self.counts[codes, 4], minlength=len(texts)) == 0) & (sizes > 0)
        for k in range(4):
            counts[:, k] = np.bincount(owner, self.counts[codes, k], minlength=len(texts))
        counts[~good] = 0
        digests, at = [], 0
        for size, ok in zip(sizes.tolist(), good.tolist()):
            if ok:
                groups = b"".join([self.groups[c] for c in known[at : at + size]])
                digests.append(hashlib.sha256(groups[1:]).hexdigest())
            else:
                digests.append("")
            at += size
        taken = good[owner]
        codes, owner = codes[taken], owner[taken]
        n = self.counts[codes, 3]
        starts = (np.cumsum(self.counts[:, 3]) - self.counts[:, 3])[codes]
        return counts, digests, gather(self.pairs, starts, n), np.repeat(owner, n)


# ---- runs ------------------------------------------------------------------------------

def packed(*columns: np.ndarray) -> bytes:
    """Whole numbers as zstd-compressed columns: how many of each, then the values as 32-bit numbers, or 64-bit if they need it."""
    kinds = [np.uint64 if len(c) and int(c.max()) >> 32 else np.uint32 for c in columns]
    head = np.array([x for c, kind in zip(columns, kinds) for x in (len(c), np.dtype(kind).itemsize)], np.uint64)
    body = b"".join(c.astype(kind).tobytes() for c, kind in zip(columns, kinds))
    return zstandard.ZstdCompressor(level=3).compress(bytes([len(columns)]) + head.tobytes() + body)


def unpacked(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    head, at, out = np.frombuffer(data, np.uint64, 2 * data[0], 1), 1 + 16 * data[0], []
    for n, size in head.reshape(-1, 2).tolist():
        out.append(np.frombuffer(data, np.uint32 if size == 4 else np.uint64, n, at).astype(np.int64))
        at += n * size
    return out


def pack_pairs(pairs: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending pairs and their counts: the steps between B's ids, A's ids, counts."""
    return packed(np.diff(pairs >> np.uint64(32), prepend=np.uint64(0)), pairs & np.uint64(0xFFFFFFFF), n)


def unpack_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, a, n = unpacked(blob)
    return (np.cumsum(steps).astype(np.uint64) << np.uint64(32)) | a.astype(np.uint64), n


def runs_of(pairs: np.ndarray, owner: np.ndarray, docs: int, radixes: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(radix, pairs, records) of a chunk's links, given the pair and the document of each."""
    distinct, place = np.unique(pairs, return_inverse=True)
    records, times = np.unique(place * docs + owner, return_counts=True)
    pair, doc = records // docs, records % docs
    total = np.bincount(pair, times, minlength=len(distinct)).astype(np.int64)
    radix = (mixed(distinct) % np.uint64(radixes)).astype(np.int64)
    by_radix, rows = np.argsort(radix, kind="stable"), np.argsort(radix[pair], kind="stable")
    cuts, row_cuts = np.searchsorted(radix[by_radix], np.arange(radixes + 1)), np.searchsorted(radix[pair][rows], np.arange(radixes + 1))
    for r in range(radixes):
        mine, held = by_radix[cuts[r] : cuts[r + 1]], rows[row_cuts[r] : row_cuts[r + 1]]
        if len(mine):
            documents = np.bincount(np.searchsorted(mine, pair[held]), minlength=len(mine))
            yield r, pack_pairs(distinct[mine], total[mine]), packed(documents, doc[held], times[held])


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(B's id, pairs, sums), ascending, of runs of ascending pairs and counts: a heap holds the next B id of each run."""

    def parts(k: int) -> Iterator[tuple]:
        pairs, n = runs[k]
        b = (pairs >> np.uint64(32)).astype(np.int64)
        edges = np.flatnonzero(np.diff(b, prepend=-1, append=-1)).tolist()
        firsts = b[edges[:-1]].tolist()
        for first, i, j in zip(firsts, edges, edges[1:]):
            yield first, k, pairs[i:j], n[i:j]

    for b, group in itertools.groupby(heapq.merge(*map(parts, range(len(runs)))), itemgetter(0)):
        held = list(group)
        pairs, n = held[0][2:]
        if len(held) > 1:
            pairs, place = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
            n = np.bincount(place, np.concatenate([h[3] for h in held])).astype(np.int64)
        yield b, pairs, n


class Merger:
    """Sums runs as they come.  `FAN_IN` runs of one level become one of the next, so that few are open, and no merged run
    is longer than the pairs there are."""

    def __init__(self):
        self.levels: list[list[bytes]] = []

    def add(self, blob: bytes, level: int = 0) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(blob)
        if len(self.levels[level]) >= FAN_IN:
            blobs, self.levels[level] = self.levels[level], []
            self.add(pack_pairs(*_joined(merged([unpack_pairs(b) for b in blobs]))), level + 1)

    def result(self) -> tuple[bytes, bytes]:
        """The sums of all pairs, and B's ids with the largest sum of each."""
        while sum(map(len, self.levels)) > FAN_IN:  # the lowest levels first
            level = next(k for k, held in enumerate(self.levels) if held)
            blobs, self.levels[level] = self.levels[level], []
            self.add(pack_pairs(*_joined(merged([unpack_pairs(b) for b in blobs]))), level + 1)
        ids, best, rows = [], [], []
        for b, pairs, n in merged([unpack_pairs(blob) for held in self.levels for blob in held]):
            ids.append(b)
            best.append(int(n.max()))
            rows.append((b, pairs, n))
        return pack_pairs(*_joined(rows)), packed(np.array(ids, np.int64), np.array(best, np.int64))


def _joined(rows: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    rows = list(rows)
    return np.concatenate([np.zeros(0, np.uint64), *(r[1] for r in rows)]), np.concatenate([np.zeros(0, np.int64), *(r[2] for r in rows)])


# ---- passes ----------------------------------------------------------------------------

_aligners: dict[tuple[str, str], Aligner] = {}
_DOC = pa.list_(pa.struct([("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                           ("n_links", pa.int64()), ("groups_sha256", pa.string())]))


def _read(texts: pa.Array, aligner: Aligner, batch_bytes: int = 1 << 19) -> Iterator[tuple]:
    held, size = [], 0
    for k in range(len(texts)):
        value = texts[k].as_buffer() if texts[k].is_valid else None
        held.append(None if value is None else value.to_pybytes().decode("utf-8", "replace"))
        size += len(held[-1] or "")
        if size >= batch_bytes or k == len(texts) - 1:
            yield aligner.read(held)
            held, size = [], 0


def write_runs(docs: DataFrame, id_column: str, text: str, path_a: str, path_b: str, radixes: int, chunk_bytes: int) -> DataFrame:
    """The runs of all chunks, and a row of radix -1 with the documents of each, stored."""
    known_to_workers(docs.sparkSession)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligners.get((path_a, path_b)) or _aligners.setdefault((path_a, path_b), Aligner(path_a, path_b))
        chunk, size = TaskContext.get().partitionId() << 32, 0
        ids, counts, digests, pairs, owners = [], [], [], [], []

        def rows() -> Iterator[pa.RecordBatch]:
            documents = [dict(zip(("id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"), (i, *c, d)))
                         for i, c, d in zip(ids, np.concatenate(counts).tolist(), digests)]
            found = [(-1, None, None, documents)]
            found += [(*run, None) for run in runs_of(np.concatenate(pairs), np.concatenate(owners), len(ids), radixes)]
            for radix, held, records, documents in found:
                yield pa.record_batch(
                    [pa.array([chunk], pa.int64()), pa.array([radix], pa.int32()), pa.array([held], pa.binary()),
                     pa.array([records], pa.binary()), pa.array([documents], _DOC)],
                    ["chunk", "radix", "pairs", "records", "docs"],
                )

        for batch in batches:
            names, texts, at = batch.column(0).to_pylist(), batch.column(1), 0
            for n, digest, pair, owner in _read(texts.cast(pa.binary()), aligner):
                owners.append(owner + len(ids))
                ids += names[at : at + len(n)]
                at += len(n)
                counts.append(n)
                digests += digest
                pairs.append(pair)
                size += 8 * len(pair)
                if size >= 4 * chunk_bytes:  # a link stands for about two bytes
                    yield from rows()
                    chunk, size = chunk + 1, 0
                    ids, counts, digests, pairs, owners = [], [], [], [], []
        if ids:
            yield from rows()

    keyed = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return store(keyed.mapInArrow(emit, RUNS), "alignment-runs")


def sums(runs: DataFrame) -> DataFrame:
    """(radix, pairs, best): the sums of each radix's pairs, and the largest sum per B id in the radix, stored."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, merger = None, Merger()

        def row() -> pa.RecordBatch:
            pairs, best = merger.result()
            return pa.record_batch([pa.array([now], pa.int32()), pa.array([pairs], pa.binary()), pa.array([best], pa.binary())],
                                   ["radix", "pairs", "best"])

        for batch in batches:
            for radix, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if radix != now:
                    if now is not None:
                        yield row()
                    now, merger = radix, Merger()
                merger.add(blob.as_py())
        if now is not None:
            yield row()

    held = runs.where("radix >= 0").select("radix", "pairs").repartition("radix").sortWithinPartitions("radix")
    return store(held.mapInArrow(merge, "radix int, pairs binary, best binary"), "alignment-sums")


def maxima(totals: DataFrame) -> np.ndarray:
    """The largest sum of each B id; a number per id of the vocabulary."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                ids, n = unpacked(blob)
                yield pa.record_batch([pa.array(ids), pa.array(n)], ["b", "n"])

    rows = totals.select("best").mapInArrow(best, "b long, n long").groupBy("b").agg(F.max("n").alias("n")).collect()
    out = np.zeros(max((r.b for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        out[r.b] = r.n
    return out


def send_back(runs: DataFrame, totals: DataFrame) -> DataFrame:
    """(chunk, radix, found): for each run the sums of its pairs, in their order, and B's ids, stored."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = n = None
        for batch in batches:
            for chunk, radix, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if chunk < 0:
                    pairs, n = unpack_pairs(blob.as_py())
                    continue
                mine = unpack_pairs(blob.as_py())[0]
                found = packed(np.diff(mine >> np.uint64(32), prepend=np.uint64(0)), n[np.searchsorted(pairs, mine)])
                yield pa.record_batch([pa.array([chunk], pa.int64()), pa.array([radix], pa.int32()), pa.array([found], pa.binary())],
                                      ["chunk", "radix", "found"])

    first = totals.select(F.lit(-1).cast("long").alias("chunk"), "radix", "pairs")
    both = runs.where("radix >= 0").select("chunk", "radix", "pairs").unionByName(first)
    both = both.repartition("radix").sortWithinPartitions("radix", "chunk")
    return store(both.mapInArrow(answer, "chunk long, radix int, found binary"), "alignment-found")


ALIGNED = ("id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
_NAMES = [part.split()[0] for part in ALIGNED.split(", ")]


def contributions(runs: DataFrame, found: DataFrame, best: np.ndarray) -> DataFrame:
    """Per document its counts, how many of its links are their B id's best, and the sum of its links' counts."""
    shared = runs.sparkSession.sparkContext.broadcast(best)  # a number per id of B

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, best, total, records = None, np.zeros(0, np.int64), np.zeros(0, np.int64), None

        def rows() -> pa.RecordBatch:
            columns = [[d[k] for d in docs] for k in ("id", "n_a", "n_b", "n_groups", "n_links")]
            arrays = [pa.array(c, pa.int64()) for c in [*columns, best, total]]
            return pa.record_batch([*arrays, pa.array([d["groups_sha256"] for d in docs], pa.string())], _NAMES)

        for batch in batches:
            for k in range(batch.num_rows):
                documents, blob, counts = (batch.column(c)[k].as_py() for c in ("docs", "records", "found"))
                if documents is not None:
                    if docs is not None:
                        yield rows()
                    docs, best, total = documents, np.zeros(len(documents), np.int64), np.zeros(len(documents), np.int64)
                elif blob is not None:
                    records = blob
                else:
                    held, doc, times = unpacked(records)
                    steps, n = unpacked(counts)
                    top = shared.value[np.cumsum(steps)] == n
                    pair = np.repeat(np.arange(len(held)), held)
                    np.add.at(total, doc, times * n[pair])
                    np.add.at(best, doc, times * top[pair])
        if docs is not None:
            yield rows()

    nothing = F.lit(None)
    mine = runs.select("chunk", "radix", F.lit(0).alias("kind"), "docs", "records", nothing.cast("binary").alias("found"))
    theirs = found.select("chunk", "radix", F.lit(1).alias("kind"), nothing.cast(runs.schema["docs"].dataType).alias("docs"),
                          nothing.cast("binary").alias("records"), "found")
    both = mine.unionByName(theirs).repartition("chunk").sortWithinPartitions("chunk", "radix", "kind")
    return both.mapInArrow(add, ALIGNED)


def aligned(docs: DataFrame, id_column: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None,
            radix_bytes: int = RADIX_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row of `docs`: id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A null or empty text, and one whose tokens of A or B do not spell it, has no tokens: zeros and an empty digest, and it adds
    nothing to the counts.  Null ids and repeated rows are documents of their own; a tie for the best of a B id makes all
    of them best.  Other columns take no part; no rows give none."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    radixes = max(8, min(MOST_RADIXES, -(-size // radix_bytes)))
    runs = write_runs(docs, id_column, text, path_a or vocabulary_path(BYTE_VOCABULARY), path_b or vocabulary_path(PIECE_VOCABULARY),
                      radixes, chunk_bytes)
    totals = sums(runs)
    found = send_back(runs, totals)
    return contributions(runs, found, maxima(totals)).withColumnRenamed("id", id_column)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`aligned` of all documents; nulls, ties and repeated rows as there."""
    return aligned(read_table(spark, sf_dir, "documents"))
