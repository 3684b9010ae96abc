"""Importance resampling towards a target distribution, with hashed n-grams counted by batch concatenation.

Every document gets the log ratio of two bag-of-n-grams models, that of the target texts and that of all documents:
features are the runs of 1 to `most_words` words, hashed into buckets, and a bucket's gain is a thousand times the
logarithm of its share (one added to each count) in the target over its share in the documents, rounded down.  A document's
weight is the sum of the gains of its features.  Gumbel noise made from its id turns the highest scores into a draw
without replacement in proportion to the weights' exponentials.

The texts of a batch are joined with a separator byte, which no word holds, and one pass of a regular expression cuts the whole
batch.  A search of the words' places among the documents' offsets gives each word its document, and n-grams whose first
and last words lie in different documents are masked out before one `bincount` counts the batch.

Counting and weighing read the texts once each; what tasks emit is bounded by the number of buckets.  The draw sorts
(id, score) by range and adds the rows of earlier partitions, so no task sees all of them.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import known_to_workers, read_table, store

MOST_WORDS = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
BATCH_BYTES = 1 << 20
_WORD = re.compile(rb"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")


def features(texts: list[bytes | None], most_words: int = MOST_WORDS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and document of every feature of a batch, and the number of words of each document.  Null has no words."""
    joined = b"\n".join([t or b"" for t in texts]).lower()
    parts = _WORD.split(joined)  # gap, word, gap, word, … gap
    words = parts[1::2]
    places = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))[:-1:2]
    offsets = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    document = np.searchsorted(offsets, places, "right") - 1
    n_words = np.bincount(document, minlength=len(texts))
    hashes = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    found, owners = [hashes], [document]
    spaced = [b" " + w for w in words] if most_words > 1 else []
    for n in range(2, most_words + 1):
        first = np.flatnonzero(document[: len(words) - n + 1] == document[n - 1 :])  # n-grams inside one document
        if not len(first):
            break
        # the hash of a run goes on from that of the run without its last word
        before = np.zeros(len(words), np.uint32)
        before[starts if n > 2 else slice(None)] = found[-1]
        hashes = [zlib.crc32(spaced[k + n - 1], c) for k, c in zip(first.tolist(), before[first].tolist())]
        found.append(np.array(hashes, np.uint32))
        owners.append(document[first])
        starts = first
    return np.concatenate(found) % np.uint32(buckets), np.concatenate(owners), n_words


def _batches(texts: pa.Array) -> Iterator[list[bytes | None]]:
    """The texts of an Arrow column in lists of about `BATCH_BYTES`."""
    held, size = [], 0
    for k in range(len(texts)):
        held.append(texts[k].as_py())
        size += len(held[-1] or b"")
        if size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def bucket_counts(docs: DataFrame, text: str = "text", most_words: int = MOST_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows fall into each bucket.  A task emits one row per bucket, at most."""
    known_to_workers(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in _batches(batch.column(0).cast(pa.binary())):
                total += np.bincount(features(texts, most_words, buckets)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "n"])

    rows = docs.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():  # at most `buckets` rows
        out[bucket] = n
    return out


def gains(target: np.ndarray, everything: np.ndarray) -> np.ndarray:
    """The gain of each bucket, from its counts in the target and in all documents."""
    size = len(target)
    t, s, total_t, total_s = target + 1.0, everything + 1.0, float(target.sum() + size), float(everything.sum() + size)
    return np.floor(1000 * np.log(t * total_s / (s * total_t)))


def weighed(docs: DataFrame, values: np.ndarray, text: str = "text", name: str = "weighed", most_words: int = MOST_WORDS) -> DataFrame:
    """`docs` with struct `name` (n_words, n_features, weight), which replaces a column of that name."""
    spark = docs.sparkSession
    known_to_workers(spark)
    shared = spark.sparkContext.broadcast(values)  # a number a bucket

    @F.arrow_udf("struct<n_words:bigint, n_features:bigint, weight:bigint>")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gain = shared.value
        for batch in batches:
            out = [np.zeros((0, 3), np.int64)]
            for texts in _batches(batch.cast(pa.binary())):
                bucket, document, n_words = features(texts, most_words, len(gain))
                n = np.bincount(document, minlength=len(texts))
                weight = np.bincount(document, gain[bucket], minlength=len(texts)).astype(np.int64)  # whole numbers below 2^53
                out.append(np.stack([n_words, n, weight], axis=1))
            rows = np.concatenate(out)
            yield pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], ["n_words", "n_features", "weight"])

    return docs.withColumn(name, column(F.col(text)))


def noise(id_column: Column, seed: int = SEED) -> Column:
    """A thousand times a Gumbel variate made from the id, rounded down; a null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def gains_of(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text",
             most_words: int = MOST_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """`gains` from all texts of `target` and of `docs`."""
    return gains(bucket_counts(target, target_text, most_words, buckets), bucket_counts(docs, text, most_words, buckets))


def _scored(docs: DataFrame, values: np.ndarray, id_column: str, text: str, most_words: int, seed: int, least_words: int,
            *more: Column) -> DataFrame:
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), *more)
    rows = weighed(rows, values, "text", "w", most_words)
    score = (F.col("w.weight") + noise(F.col("id"), seed)).cast("long")
    return rows.withColumns({"score": score, "eligible": F.col("w.n_words") >= least_words}).drop("text")


def scores(docs: DataFrame, values: np.ndarray, id_column: str = "doc_id", text: str = "text", most_words: int = MOST_WORDS,
           seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of `docs`, by the `gains_of` buckets: id, n_features, weight, score and `rank`, 1 for the highest score; only
    the drawn rows have one.

    Drawn are `percent` of a hundred, rounded down, of the rows with `least_words` words; equal scores go by the smaller
    id, null last.  Null and empty texts have no features and weight 0; repeated rows are drawn one by one, and a null id's
    noise is that of the empty text.  Other columns take no part; no rows give none."""
    rows = _scored(docs, values, id_column, text, most_words, seed, least_words)
    rows = store(rows.select("id", "w.*", "score", "eligible"), "resampling-scores")
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("id")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = store(placed.withColumn("place", F.monotonically_increasing_id()), "resampling-order")
    # a row per partition of the sort
    part = F.shiftright("place", 33)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    drawn = placed.where("eligible").count() * percent // 100
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    ranked = placed.withColumn("part", part).join(F.broadcast(parts), "part").withColumn("rank", rank)
    return ranked.select(
        F.col("id").alias(id_column), "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    )


def resample(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text: str = "text", target_text: str = "text",
             most_words: int = MOST_WORDS, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS,
             percent: int = PERCENT) -> DataFrame:
    """The drawn rows of `docs`, with all columns as they are, whatever their names.

    The last drawn row is the cut: texts are weighed again where they are read and kept down to it, so none is
    shuffled.  Rows that equal the last drawn one in id and score come with it."""
    values = gains_of(docs, target, text, target_text, most_words, buckets)
    found = scores(docs, values, id_column, text, most_words, seed, least_words, percent).withColumnRenamed(id_column, "id")
    last = found.where("rank IS NOT NULL").orderBy(F.desc("rank")).select("score", "id").first()
    rows = _scored(docs, values, id_column, text, most_words, seed, least_words, F.struct("*").alias("row"))
    if last is None:
        return rows.select("row.*").limit(0)
    down_to = F.lit(True) if last.id is None else F.col("id") <= F.lit(last.id)
    return rows.where(F.col("eligible") & ((F.col("score") > last.score) | ((F.col("score") == last.score) & down_to))).select("row.*")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`scores` of all documents towards the benchmark; nulls, ties and repeated rows as there."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scores(docs, gains_of(docs, read_table(spark, sf_dir, "benchmark")))
