"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network with calibrated probabilities.

Words are runs of letters, of digits or of other characters, case kept.  Every word has an index vector, `NONZERO`
entries of +1 or -1 at places given by its hash.  Its context vector is the sum of the index vectors of its
neighbours within `NEAR` words, over all documents; words share `ROWS` vectors by hash, so the table has a fixed size whatever
the corpus.  Tasks sum their own documents and emit the table once; its parts are added where they meet.

A document is the mean and the spread of the directions of its words' context vectors, how alike near words' vectors are, and the
logarithm of its length.  A network with one hidden layer learns the labels from a bounded sample of about `TRAIN_ROWS` labelled rows chosen by a hash of the id.  A fifth
of the sample does not train: it fits the temperature that divides the network's output, so that scores are calibrated on
texts that the network has not seen.  Word vectors and scores cover all rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import known_to_workers, read_table, store
from ebbtide.llm.fingerprints import mixed
from ebbtide.llm.token_output import span_hashes

ROWS, DIMENSIONS, NONZERO, NEAR = 1 << 14, 64, 2, 2
APART = (1, 2, 4)
TRAIN_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 32, 60, 256, 0.005, 1e-4, 42
BATCH_BYTES = 1 << 18
_PARTS = 64  # of the table
# white space, letters (all bytes beyond ASCII), digits, others
_KIND = np.full(256, 3, np.int8)
_KIND[[32, *range(9, 14)]] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2


def word_rows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every word."""
    joined = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    kind = _KIND[joined]
    edge = np.flatnonzero(np.diff(kind, prepend=0, append=0))
    edge = edge[edge < len(joined)]
    starts = edge[kind[edge] > 0]
    ends = np.append(edge, len(joined))[np.searchsorted(edge, starts) + 1]
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return span_hashes(joined, starts, ends), np.searchsorted(bounds, starts, "right")


def row_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % ROWS


def index_entries(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each word's index vector, `NONZERO` a word."""
    drawn = [mixed(hashes + np.uint64(k + 1)) for k in range(NONZERO)]
    places = np.stack([(d % np.uint64(DIMENSIONS)).astype(np.int64) for d in drawn], axis=1)
    return places, np.stack([np.where(d >> np.uint64(63), 1.0, -1.0) for d in drawn], axis=1)


def add_contexts(table: np.ndarray, texts: list[bytes]) -> None:
    """Add the texts' context vectors to `table`, flat."""
    hashes, text = word_rows(texts)
    row, (places, signs) = row_of(hashes) * DIMENSIONS, index_entries(hashes)
    at, values = [np.zeros(0, np.int64)], [np.zeros(0)]
    for far in range(1, NEAR + 1):
        i = np.flatnonzero(text[:-far] == text[far:])
        for word, neighbour in ((i, i + far), (i + far, i)):
            at.append((row[word][:, None] + places[neighbour]).ravel())
            values.append(signs[neighbour].ravel())
    table += np.bincount(np.concatenate(at), np.concatenate(values), minlength=len(table)).astype(np.int64)


def _batches(column: pa.Array) -> Iterator[list[bytes]]:
    held, size = [], 0
    for k in range(len(column)):
        held.append(column[k].as_py() or b"")
        size += len(held[-1])
        if size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def context_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The directions of the context vectors of all rows' words: `ROWS` unit vectors, or zero where no word is."""
    known_to_workers(docs.sparkSession)
    each = ROWS * DIMENSIONS // _PARTS

    def record(part: int, values: np.ndarray) -> pa.RecordBatch:
        blob = zstandard.ZstdCompressor(level=1).compress(values.tobytes())
        return pa.record_batch([pa.array([part], pa.int32()), pa.array([blob], pa.binary())], ["part", "sums"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(ROWS * DIMENSIONS, np.int64)
        for batch in batches:
            for texts in _batches(batch.column(0).cast(pa.binary())):
                add_contexts(table, texts)
        for part, values in enumerate(table.reshape(_PARTS, each)):
            if values.any():
                yield record(part, values)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob.as_py()), np.int64)
                held[part] = held[part] + values if part in held else values
        for part, values in held.items():
            yield record(part, values)

    schema = "part int, sums binary"
    parts = docs.select(text).mapInArrow(count, schema).repartition("part").mapInArrow(add, schema)
    table = np.zeros((_PARTS, each))
    for part, blob in parts.collect():  # `_PARTS` rows, 8 MB in all
        table[part] = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int64)
    table = table.reshape(ROWS, DIMENSIONS)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """The features of each text: mean and spread of its words' vectors, how alike those of words `APART` places apart are, and
    the logarithm of its words.  Without words all are 0."""
    hashes, text = word_rows(texts)
    out = np.zeros((len(texts), 2 * DIMENSIONS + len(APART) + 1), np.float32)
    if len(hashes):
        first = np.flatnonzero(np.diff(text, prepend=-1))
        n = np.diff(np.append(first, len(text)))[:, None]
        vectors = table[row_of(hashes)]
        mean = np.add.reduceat(vectors, first) / n
        spread = np.sqrt(np.maximum(np.add.reduceat(vectors * vectors, first) / n - mean * mean, 0))
        alike = []
        for far in APART:
            products = np.einsum("ij,ij->i", vectors[:-far], vectors[far:]) * (text[:-far] == text[far:])
            likeness = np.bincount(text[:-far], products, minlength=len(texts))
            alike.append(likeness[text[first]] / np.maximum(n[:, 0] - far, 1))
        out[text[first]] = np.concatenate([mean, spread, np.stack(alike, axis=1), np.log1p(n)], axis=1)
    return out


class Network:
    """Two layers: `HIDDEN` rectified units, one output; `temperature` divides the output before the logistic function."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.temperature = 1.0
        x = self._scaled(x)
        self.weights = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                        rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for k in range(0, len(x), BATCH):
                at, step = order[k : k + BATCH], step + 1
                for w, m, v, g in zip(self.weights, first, second, self._gradients(x[at], y[at])):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= RATE * ((m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + DECAY * w)

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        w, b, u, c = self.weights
        inner = x @ w + b
        hidden = np.maximum(inner, 0)
        error = (1 / (1 + np.exp(-(hidden @ u + c))) - y) / len(y)
        back = np.outer(error, u) * (inner > 0)
        return [x.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]

    def output(self, x: np.ndarray) -> np.ndarray:
        w, b, u, c = self.weights
        return np.maximum(self._scaled(x) @ w + b, 0) @ u + c

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature of the least log loss, by a search in which the interval shrinks by the golden ratio."""
        z, sign = self.output(x), np.where(y > 0, 1, -1)
        loss = lambda t: np.logaddexp(0, -sign * z / np.exp(t)).mean()
        low, high, ratio = np.log(0.05), np.log(20), (np.sqrt(5) - 1) / 2
        while high - low > 1e-4:
            a, b = high - ratio * (high - low), low + ratio * (high - low)
            low, high = (low, b) if loss(a) < loss(b) else (a, high)
        self.temperature = float(np.exp((low + high) / 2))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.output(x) / self.temperature, -500, 500)))


def held_out(id_column: str) -> Column:
    """Whether labels of a row are kept from training; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_sample(labels: DataFrame, id_column: str, label: str, rows: int) -> DataFrame:
    """(of, label, calibrates): labelled rows that may be learned from, one per id (the larger label), and of these about
    `rows` by a hash of the id."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column))
    known = known.groupBy(F.col(id_column).alias("of")).agg((F.max(label) > 0).cast("int").alias("label"))
    share = min(1.0, rows / max(1, known.count()))
    place = F.pmod(F.xxhash64("of"), F.lit(1 << 20)) / float(1 << 20)
    return known.where(place < share).withColumn("calibrates", F.pmod(F.xxhash64("of", F.lit("part")), F.lit(5)) == 0)


def fit(docs: DataFrame, labels: DataFrame, table: np.ndarray, id_column: str, text: str, label: str, rows: int) -> "Network | float":
    """The network, or the share of label 1 where a part of the sample lacks one of the labels (0 without labels)."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # of a fixed size

    @F.arrow_udf("binary")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([r.tobytes() for texts in _batches(batch.cast(pa.binary())) for r in pooled(texts, shared.value)], pa.binary())

    sample = store(training_sample(labels, id_column, label, rows), "quality-sample")  # bounded by `rows`
    texts = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    known = texts.join(F.broadcast(sample), F.col("id") == F.col("of"))
    known = known.select("id", "label", "calibrates", column("text").alias("x")).collect()
    if not known:
        return 0.0
    known.sort(key=lambda r: (r.id, r.x))
    x = np.stack([np.frombuffer(r.x, np.float32) for r in known]).astype(np.float64)
    y, kept = np.array([r.label for r in known], np.float64), np.array([r.calibrates for r in known])
    if any(len(np.unique(part)) < 2 for part in (y[kept], y[~kept])):
        return float(y.mean())
    network = Network(x[~kept], y[~kept])
    network.calibrate(x[kept], y[kept])
    return network


def score(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality",
          train_rows: int = TRAIN_ROWS, name: str = "score") -> DataFrame:
    """`docs` with `name`, the calibrated probability that a text has label 1; a column of that name is replaced.

    Learned are the labels of `labels` that `held_out` allows.  Nothing but the text enters a score, so equal texts score
    alike; null is the empty text, which has a score too.  Without both labels every score is the share of label 1."""
    known_to_workers(docs.sparkSession)
    table = context_table(docs, text)
    model = fit(docs, labels, table, id_column, text, label, train_rows)
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(model))
    shared = docs.sparkSession.sparkContext.broadcast((table, model))  # of a fixed size

    @F.arrow_udf("double")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, network = shared.value
        for batch in batches:
            parts = [network.score(pooled(texts, table)) for texts in _batches(batch.cast(pa.binary()))]
            yield pa.array(np.concatenate([np.zeros(0), *parts]))

    return docs.withColumn(name, column(F.col(text)))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`score` of all documents; a null text is the empty one, a null id counts as the empty text for `held_out`; repeated rows
    are scored alike and no rows give none."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, read_table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
