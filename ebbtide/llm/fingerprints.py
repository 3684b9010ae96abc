"""Document fingerprints by one-permutation MinHash.

Every five-word shingle is hashed once; the top bits of the hash choose one of `BINS` bins, and a bin keeps the
smallest hash that falls into it.  An empty bin takes over the value of another: a hash of its own
number and of the attempt names one bin after the other until one is filled (optimal densification), the
same ones for every text.  Stored are the `BITS` low bits of each bin, packed.

Two fingerprints agree in a bin with probability J + (1 - J) / 2^BITS, where J is the Jaccard similarity of the
shingle sets; `likeness` takes the share of chance agreement out again.

Texts are lower-cased (A-Z) and split at ASCII white space; fewer than five words are one shingle.  A text without
words, null included, has an empty fingerprint, which is like another empty one (1) and like nothing else (0).
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import known_to_workers, read_table

SHINGLE_WORDS = 5
BINS, BITS = 256, 4
CHUNK_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base^0 … base^(n-1), modulo 2^64."""
    held = _powers.get(str(base))
    if held is None or len(held) < n:
        factors = np.full(max(n, 2 * CHUNK_BYTES), base)
        factors[0] = 1
        held = np.multiply.accumulate(factors)
        if n <= 2 * CHUNK_BYTES:
            _powers[str(base)] = held
    return held[:n]


def word_hashes(texts: list[bytes], apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the text of each; `apart` marks the bytes between words, which the space must be one of.  The hash of a word is that of the polynomial of its bytes, from
    differences of one prefix sum over all texts."""
    joined = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = apart[joined]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((_LOWER[joined].astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(joined)), out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * _power(_INVERSE, len(joined))[starts])
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(bounds, starts, "right")


def shingle_hashes(texts: list[bytes], shingle: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles with repeats, and the text of each."""
    words, text = word_hashes(texts)
    n = np.bincount(text, minlength=len(texts))
    rank = np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n)
    # a shingle starts where enough words follow, or at the start of a short text
    begins = np.flatnonzero((rank <= n[text] - shingle) | (rank == 0))
    length = np.minimum(n[text[begins]], shingle)
    sums = np.zeros(len(begins), np.uint64)
    for k in range(shingle):
        inside = k < length
        at = np.minimum(begins + k, max(len(words) - 1, 0))
        sums = np.where(inside, sums * _STEP + words[at] if len(words) else sums, sums)
    return mixed(sums + length.astype(np.uint64)), text[begins]


def sketches(texts: list[bytes], bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """Densified bin values of each text (row), and whether it has any shingle."""
    hashes, text = shingle_hashes(texts)
    values = np.full(len(texts) * bins, _EMPTY)
    bits = np.uint64(64 - (bins - 1).bit_length())
    np.minimum.at(values, text * bins + (hashes >> bits).astype(np.int64) % bins, hashes & ((np.uint64(1) << bits) - np.uint64(1)))
    values = values.reshape(len(texts), bins)
    filled = values != _EMPTY
    some = filled.any(axis=1)
    row, column = np.nonzero(~filled & some[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        donor = (mixed(column.astype(np.uint64) * _STEP + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        got = filled[row, donor]
        values[row[got], column[got]] = values[row[got], donor[got]]
        row, column = row[~got], column[~got]
    return values, some


def low_bits(values: np.ndarray, bits: int = BITS) -> np.ndarray:
    return (values & np.uint64((1 << bits) - 1)).astype(np.uint8)


def packed(low: np.ndarray, some: np.ndarray, bits: int = BITS) -> list[str]:
    """Hex of the packed low bits; empty for texts without shingles."""
    each = np.unpackbits(low[:, :, None], axis=2)[:, :, 8 - bits:]
    octets = np.packbits(each.reshape(len(low), -1), axis=1)
    return [row.tobytes().hex() if s else "" for row, s in zip(octets, some)]


def likeness(a: np.ndarray, b: np.ndarray, some_a: np.ndarray, some_b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity of the texts of each row, from 0 to 1."""
    chance = 0.5**bits
    estimate = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0.0, 1.0)
    return np.where(some_a & some_b, estimate, (some_a == some_b).astype(float))


def of_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Low bits of each text's bins and whether it has shingles, computed in chunks of bounded size."""
    low, some, chunk, size = [np.zeros((0, BINS), np.uint8)], [np.zeros(0, bool)], [], 0
    for i, text in enumerate(texts):
        chunk.append(text)
        size += len(text)
        if size >= CHUNK_BYTES or i == len(texts) - 1:
            values, has = sketches(chunk)
            low.append(low_bits(values))
            some.append(has)
            chunk, size = [], 0
    return np.concatenate(low), np.concatenate(some)


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """`docs` with the fingerprint of column `text` as hex string `name`, which replaces a column of that name."""
    known_to_workers(docs.sparkSession)

    @F.arrow_udf("string")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(packed(*of_texts([t or b"" for t in batch.cast(pa.binary()).to_pylist()])), pa.string())

    return docs.withColumn(name, column(F.col(text)))


PAIRED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def with_next(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its edited text (see `edited`) and the likeness to that and to the next
    document, in ascending order of the id (null first, equal ids by the hash of the text); the first follows the last.

    Documents are dealt by ranges of the id, as many as there are shuffle partitions, so texts cross one
    exchange.  The first document of each range also goes to the range before, where it is only looked at."""
    spark = docs.sparkSession
    known_to_workers(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    fractions = [k / n for k in range(1, n)]
    cuts = rows.agg(F.percentile_approx("doc_id", fractions or [0.5], 100 * n)).first()[0] or []
    cuts = sorted(set(cuts)) if n > 1 else []
    bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), lambda c: c <= F.col("doc_id")))
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), 0).otherwise(bucket))
    # one row per range: its first document, and the range that precedes it
    heads = rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "hash")).alias("head"))
    order = Window.orderBy("bucket")
    before = F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy()))
    heads = heads.select("head", before.alias("bucket"))
    guests = (
        rows.drop("bucket").join(F.broadcast(heads), F.struct("doc_id", "hash").eqNullSafe(F.col("head")))
        .select("doc_id", "text", "hash", "bucket", F.lit(True).alias("guest"))
    )
    dealt = (
        rows.withColumn("guest", F.lit(False)).unionByName(guests)
        .repartitionByRange(n, "bucket")
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").asc_nulls_first(), "hash")
        .select("doc_id", "text", "bucket", "guest")
    )
    return dealt.mapInArrow(_paired, PAIRED)


def edited(text: str, following: str) -> str:
    """`text` with its last half of the code points (rounded down) replaced by the first as many of `following`."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket, each bucket followed by its guest; a row waits for the one after it."""
    held: list[tuple] = []
    for batch in batches:
        rows = held + list(zip(*(batch.column(c).to_pylist() for c in range(4))))
        at, size = 0, 0
        for i in range(len(rows)):
            size += len(rows[i][1])
            if (size >= CHUNK_BYTES or i == len(rows) - 1) and i > at:
                yield _pairs(rows[at : i + 1])
                at, size = i, 0
        held = rows[-1:]


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    texts = [r[1] for r in rows]
    kept = [k for k in range(len(rows) - 1) if not rows[k][3] and rows[k][2] == rows[k + 1][2]]
    low, some = of_texts([t.encode() for t in texts])
    changed = [edited(texts[k], texts[k + 1]).encode() for k in kept]
    changed_low, changed_some = of_texts(changed)
    at = np.array(kept, np.int64)
    prints = packed(low, some)
    return pa.record_batch(
        [pa.array([rows[k][0] for k in kept], pa.int64()), pa.array([len(texts[k]) for k in kept], pa.int64()),
         pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
         pa.array([prints[k] for k in kept], pa.string()), pa.array(packed(changed_low, changed_some), pa.string()),
         pa.array(likeness(low[at], changed_low, some[at], changed_some)),
         pa.array(likeness(low[at], low[at + 1], some[at], some[at + 1]))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(read_table(spark, sf_dir, "documents"))
