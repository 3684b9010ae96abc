"""Benchmark decontamination with suffix arrays over shards of the training corpus.

Texts are lower-cased (A-Z) and split into words of digits, letters and any character beyond ASCII.
A window is ten consecutive words of a benchmark item; an item of fewer words, but not none, is one
window.  A document word inside any occurrence of any window is hit; a document with a hit word is
contaminated.

Each task cuts its documents into shards of about `SHARD_WORDS` words.  Words become numbers of the
benchmark's vocabulary, 0 for all others.  A suffix that meets another word before the shortest window
ends cannot start with a window and is left out of the array; that loses nothing.  The remaining
suffixes are sorted by as many words as the longest window has, and
every suffix of every item is located by binary search for its window's length.  The interval found
gives all verbatim occurrences in the shard; the longest match of each pair of document and item is extended from there
word by word.

The benchmark is a stated query set.  It is dealt to the tasks in blocks of at most `BLOCK_WORDS`
words, each a broadcast of bounded size; every shard is searched for all blocks, so a larger benchmark costs
time but neither memory nor results.
"""

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.common import known_to_workers, read_table, slices, store

WINDOW = 10
SHARD_WORDS = 1 << 18
BLOCK_WORDS = 200_000
PIECE_BYTES = 1 << 20
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")

MATCH = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("item_start", T.LongType()),
    T.StructField("doc_start", T.LongType()),
    T.StructField("length", T.LongType()),
])


def words_of(text: bytes | None) -> list[bytes]:
    return _WORD.findall((text or b"").lower())


def word_numbers(text: bytes | None, numbers: dict[bytes, int]) -> np.ndarray:
    """The numbers of a text's words, 0 for those without; a long text is read in pieces that end between words."""
    low, at, parts = (text or b"").lower(), 0, [np.zeros(0, np.int32)]
    while at < len(low):
        gap = _GAP.search(low, at + PIECE_BYTES) if len(low) - at > PIECE_BYTES else None
        stop = gap.end() if gap else len(low)
        words = _WORD.findall(low, at, stop)
        parts.append(np.fromiter((numbers.get(w, 0) for w in words), np.int32, len(words)))
        at = stop
    return np.concatenate(parts)


class Windows:
    """The windows of one block of items, by length, as rows of word numbers."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.items = [(name, words) for name, words in items if words]
        self.codes: dict[bytes, int] = {}
        self.item_words = []
        for _, words in self.items:
            self.item_words.append(
                np.array([self.codes.setdefault(w, len(self.codes) + 1) for w in words], np.int64)
            )
        by_length: dict[int, list[tuple[int, int]]] = {}
        for i, words in enumerate(self.item_words):
            length = min(window, len(words))
            by_length.setdefault(length, []).extend((i, s) for s in range(len(words) - length + 1))
        #: length -> (item and start of each window, the words of each window)
        self.windows = {
            n: (np.array(at), np.stack([self.item_words[i][s : s + n] for i, s in at]))
            for n, at in sorted(by_length.items())
        }
        self.shortest = min(self.windows, default=0)


    def rows(self, words: np.ndarray) -> np.ndarray:
        """Sort keys: word numbers as big-endian bytes, which compare as the words do."""
        return np.ascontiguousarray(words.astype(">u4")).view(f"S{4 * words.shape[1]}").ravel()

    def occurrences(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place, item, start in the item and length of every window in `words`, in which 0
        stands for any word that no item has and for the end of a document."""
        found = [np.zeros((4, 0), np.int64)]
        if self.windows:
            depth = max(self.windows)
            # runs of known words, long enough for the shortest window
            ends = np.flatnonzero(words == 0)
            starts = np.concatenate(([0], ends[:-1] + 1))
            suffixes = ends - starts - self.shortest + 1
            starts, suffixes = starts[suffixes > 0], suffixes[suffixes > 0]
            places = np.repeat(starts - (np.cumsum(suffixes) - suffixes), suffixes) + np.arange(suffixes.sum())
            padded = np.concatenate([words, np.zeros(depth, words.dtype)])
            keys = self.rows(np.lib.stride_tricks.sliding_window_view(padded, depth)[places])
            order = np.argsort(keys, kind="stable")  # the suffix array
            places, keys = places[order], keys[order]
            for length, (at, windows) in self.windows.items():
                low = np.zeros((len(windows), depth), np.int64)
                high = np.full((len(windows), depth), 0xFFFFFFFF, np.int64)
                low[:, :length] = high[:, :length] = windows
                first = np.searchsorted(keys, self.rows(low), "left")
                n = np.searchsorted(keys, self.rows(high), "right") - first
                which = np.repeat(np.arange(len(at)), n)
                hits = places[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                found.append(np.stack([hits, at[which, 0], at[which, 1], np.full(len(hits), length)]))
        return tuple(np.concatenate(found, axis=1))

    def search(self, texts: list[np.ndarray]) -> list[tuple[list[tuple[int, int]], list[tuple]]]:
        """Of each text's word numbers: the hit ranges (start, stop), and the longest match with each item
        whose windows occur, as (item id, start in the item, start in the text, words); of equally long ones
        the first in the text, then in the item."""
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        first = np.cumsum(sizes) - sizes
        words = np.concatenate([part for t in texts for part in (t, np.zeros(1, np.int32))])
        place, item, start, length = self.occurrences(words)
        out = [([], []) for _ in texts]
        if not len(place):
            return out
        depth = np.bincount(place, minlength=len(words) + 1) - np.bincount(place + length, minlength=len(words) + 1)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(depth) > 0).astype(np.int8)))))
        for a, b in edges.reshape(-1, 2).tolist():  # a document's last word is followed by a 0
            doc = int(np.searchsorted(first, a, "right")) - 1
            out[doc][0].append((a - int(first[doc]), b - int(first[doc])))
        # windows that follow each other in the text and in the item are one match
        order = np.lexsort((place, place - start, item))
        place, item, start, length = place[order], item[order], start[order], length[order]
        doc = np.searchsorted(first, place, "right") - 1
        fresh = np.ones(len(place), bool)
        fresh[1:] = (np.diff(item) != 0) | (np.diff(place) != 1) | (np.diff(start) != 1)
        heads = np.flatnonzero(fresh)
        total = np.diff(np.append(heads, len(place))) - 1 + length[heads]
        place, item, start, doc = place[heads] - first[doc[heads]], item[heads], start[heads], doc[heads]
        best: set[tuple[int, str | None]] = set()
        for k in np.lexsort((start, place, -total)).tolist():
            name = self.items[item[k]][0]
            if (doc[k], name) not in best:
                best.add((doc[k], name))
                out[doc[k]][1].append((name, int(start[k]), int(place[k]), int(total[k])))
        return out


def merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("hits", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()),
    ]))),
    T.StructField("matches", T.ArrayType(MATCH)),
])
_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_MATCHES = pa.list_(pa.struct([
    ("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("length", pa.int64()),
]))


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list]:
    """Items as (id as text, words), in blocks of at most `block_words` words or one item."""
    block, held = [], 0
    for name, content in benchmark.select(F.col(item_id).cast("string"), F.col(text)).toLocalIterator():
        words = words_of((content or "").encode("utf-8", "surrogatepass"))
        if block and held + len(words) > block_words:
            yield block
            block, held = [], 0
        block.append((name, words))
        held += len(words)
    yield block


def annotate(docs: DataFrame, benchmark: DataFrame, name: str = "contamination", text: str = "text",
             item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
             block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """`docs` with struct `name`: n_words, n_hit, the hit word ranges and the longest match with each item.

    Null texts have no words, null or empty items no windows; items of one id count as one, and null ids
    as one id.  A column called `name` is replaced.  A benchmark of several blocks takes one pass per
    block; the passes before the last are stored in the shared folder."""
    spark = docs.sparkSession
    known_to_workers(spark)
    docs = docs.drop(name)
    for number, block in enumerate(item_blocks(benchmark, item_id, item_text, block_words)):
        items = spark.sparkContext.broadcast(block)
        if number:
            docs = store(docs, "decontamination")
        docs = docs.withColumn(name, _search(items, window, shard_words)(
            F.col(text), F.col(name) if number else F.lit(None).cast(FOUND)
        ))
    return docs


def _search(items, window: int, shard_words: int):
    @F.arrow_udf(FOUND)
    def search(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        windows = Windows(items.value, window)
        for texts, before in batches:
            contents, earlier = texts.cast(pa.binary()), before.to_pylist()
            found, shard, held = [], [], 0
            sizes = []
            for content in (t for part in slices(contents, 64) for t in part):
                words = word_numbers(content, windows.codes)
                shard.append(words)
                sizes.append(len(words))
                held += len(words)
                if held >= shard_words or len(sizes) == len(contents):
                    found += windows.search(shard)
                    shard, held = [], 0
            for k, old in enumerate(earlier):
                if old:
                    found[k] = _with_earlier(found[k], old)
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array([sum(b - a for a, b in h) for h, _ in found], pa.int64()),
                 pa.array([[{"start": a, "stop": b} for a, b in h] for h, _ in found], _RANGES),
                 pa.array([[dict(zip(MATCH.names, m)) for m in ms] for _, ms in found], _MATCHES)],
                FOUND.names,
            )

    return search


def _with_earlier(found: tuple[list, list], old: dict) -> tuple[list, list]:
    hits, matches = found
    best = {}
    for match in [tuple(m.values()) for m in old["matches"]] + matches:
        held = best.get(match[0])
        if held is None or (-match[3], match[2], match[1]) < (-held[3], held[2], held[1]):
            best[match[0]] = match
    return merged([*((r["start"], r["stop"]) for r in old["hits"]), *hits]), [*best.values()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """`docs` without the contaminated ones, with all columns as they are, whatever their names.  Null and empty texts
    stay, and so do all rows if there are no items; repeated rows are judged alike."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return annotate(rows, benchmark, "found", **options).where("found.n_hit = 0").select("row.*")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`annotate` of all documents against all items; nulls, ties and repeated rows as there."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = annotate(docs, read_table(spark, sf_dir, "benchmark"))
    items = F.expr("array_sort(transform(contamination.matches, m -> coalesce(m.item_id, '')))")
    return found.select(
        "doc_id", "contamination.n_words", "contamination.n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("contamination.n_hit") > 0).alias("contaminated"),
    )
