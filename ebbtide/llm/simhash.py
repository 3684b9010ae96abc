"""SimHash near-duplicates, joined by meet-in-the-middle ball hashing.

A fingerprint has 64 bits: a bit is set if more than half of the text's shingle hashes have
it set.  Two fingerprints are linked if at most three bits differ.

The join.  The bits are cut into three parts.  Of three differing bits at least two parts
hold at most one each; call them P and Q and the third part T.  One fingerprint of the pair
emits all its variants with up to one bit of P flipped, the other all with up to one bit of
Q flipped, and they meet in the same value of P and Q.  Doing so for each choice of T, every
fingerprint emits 131 variants, whatever the corpus.  Variants that no other fingerprint
shares end there.  Those that meet in P and Q go on with the variants of T: the first side
flips up to two bits in all, the second up to one.  What then meets in all 64 bits differs in at most
three bits, by construction and without a comparison of pairs: everything in such a ball is
linked to its smallest member.  Links therefore grow with the balls' sizes, not with
their squares, also where thousands of near copies are within three bits of each other.

Only distinct fingerprints take part, so exact copies cost nothing.
"""

import itertools
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import bitmap, components, known_to_workers, maybe_in, read_table, slices, store
from ebbtide.llm.fingerprints import mixed, shingle_hashes, word_hashes

SHINGLE_WORDS = 3
SEED = 42
WORD_SEEDS = (1, 2)
SIMILARITY = 0.8
BANDS, BAND_ROWS = 24, 5
_SLACK = 0.15
# odd, one for each MinHash function
_FACTORS = mixed(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_NO_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_PARTS = [(0, 21), (21, 42), (42, 64)]
# the bits of each byte value, highest first
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of one text: A-Z lower-cased, words split at ASCII white space,
    shingles with repeats; fewer words make one shingle, no word gives zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], dtype=">u8")
    octets = hashes.view(np.uint8).reshape(-1, 8)
    set_bits = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(set_bits * 2 > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """`docs` with the signed 64-bit fingerprint of column `text` as `name`, which replaces
    a column of that name; `text` itself is left out.  A null or empty text has fingerprint zero."""

    known_to_workers(docs.sparkSession)

    @F.arrow_udf("long")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            values = [fingerprint(t) for part in slices(texts, 64) for t in part]
            yield pa.array(np.array(values, np.uint64).view(np.int64))

    return docs.withColumn(name, column(F.col(text))).drop(text)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _flips(part: tuple[int, int], most: int) -> list[int]:
    """Masks of up to `most` bits within a part."""
    return [
        sum(1 << b for b in bits)
        for n in range(most + 1) for bits in itertools.combinations(range(*part), n)
    ]


def _long(value: int) -> str:
    """64-bit pattern as an SQL literal."""
    value = _signed(value)
    return "(-9223372036854775807L - 1L)" if value == -(1 << 63) else f"({value}L)"


def _meeting_variants() -> str:
    """SQL array of (part left out, side, bits kept, bits flipped); side 0 is the unchanged
    value, which serves both sides."""
    rows = []
    for t, third in enumerate(_PARTS):
        keep = _long(((1 << 64) - 1) ^ sum(1 << b for b in range(*third)))
        first, second = (p for p in _PARTS if p != third)
        sides = [(0, 0)] + [(s, m) for s, p in ((1, first), (2, second)) for m in _flips(p, 1)[1:]]
        rows += [f"struct({3 * t + side}Y, {keep}, {_long(mask)})" for side, mask in sides]
    return f"array({', '.join(rows)})"


def _third_part(spark) -> DataFrame:
    """(variant, role, others, third_flip): how a variant goes on in the part left out, whose bits are
    `others`.  The first side may flip two bits in all, the second one."""
    rows = []
    for t, third in enumerate(_PARTS):
        for side, role, most in ((0, 1, 2), (0, 2, 1), (1, 1, 1), (2, 2, 0)):
            others = _signed(sum(1 << b for b in range(*third)))
            rows += [(3 * t + side, role, others, _signed(mask)) for mask in _flips(third, most)]
    return spark.createDataFrame(rows, "variant tinyint, role tinyint, others long, third_flip long")


def _shared(rows: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """Rows whose `key` holds two different fingerprints and both sides, with the smallest."""
    group = Window.partitionBy(key)
    return (
        rows.withColumn("least", F.min("fp").over(group))
        .withColumn("most", F.max("fp").over(group))
        .withColumn("sides", F.max(F.expr(f"int({first})")).over(group) + F.max(F.expr(f"int({second})")).over(group))
        .where("least <> most AND sides = 2")
        .drop("most", "sides")
    )


def _met(fps: DataFrame, column: str) -> DataFrame:
    """(fp, variant, meet) of the variants that another value of `column` shares."""
    nodes = fps.select(F.col(column).alias("fp")).where("fp IS NOT NULL").distinct()
    variants = nodes.selectExpr("fp", f"inline({_meeting_variants()}) AS (variant, keep, flip)")
    variants = variants.selectExpr("fp", "variant", "(fp & keep) ^ flip AS meet")
    return _shared(variants, "meet", "variant % 3 < 2", "variant % 3 <> 1").drop("least")


def _balls(met: DataFrame) -> DataFrame:
    """(fp, centre, least) of the values of `met` that lie in a ball with another; any two in a ball that hold different
    roles differ in three bits at most."""
    # the masks are a fixed table of 960 rows
    balls = met.join(F.broadcast(_third_part(met.sparkSession)), "variant").selectExpr(
        "fp", "role", "meet ^ (fp & others) ^ third_flip AS centre"
    )
    return _shared(balls, "centre", "role = 1", "role = 2").drop("role")


def links(fps: DataFrame, column: str = "fp") -> DataFrame:
    """(a, b): links whose components are those of "at most three bits differ" over the
    distinct values of `column`; b is the smallest member of a ball that holds a.  Nulls
    have no links, repeated values count once, other columns take no part."""
    balls = _balls(_met(fps, column))
    return balls.where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()


def _classes(rows: DataFrame) -> DataFrame:
    """(fp, class) of the distinct values of `fp`: classes go by the smallest fingerprint that can be reached over links."""
    distinct = store(rows.select("fp").distinct(), "simhash-values")
    found = components(links(distinct))
    return distinct.join(found, distinct.fp == found.node, "left").select("fp", F.coalesce("component", "fp").alias("class"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without `text`, with `fp` (signed long) and `component_id`: the smallest id among the documents that can
    be reached over links, the document itself included; columns of these names are replaced.

    Null and empty texts have fingerprint zero and are linked like any other.  Equal texts and repeated rows are in one
    component.  Null ids never become a component's name unless all of its ids are null."""
    kept = [c for c in docs.columns if c not in (text, "fp", "component_id")]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(id_column).alias("id"), F.col(text).alias("text"))
    rows = store(fingerprints(rows), "simhash")
    classes = store(_classes(rows), "simhash-classes")
    smallest = rows.groupBy("fp").agg(F.min("id").alias("id")).join(classes, "fp")
    named = classes.join(smallest.groupBy("class").agg(F.min("id").alias("component_id")), "class")
    return rows.join(named, "fp", "left").select("row.*", "fp", "component_id")


def word_fingerprints(texts: list[bytes], seeds: Sequence[int]) -> np.ndarray:
    """Fingerprints of the words of each text (row), one for each seed (column), as signed numbers.  Words are runs of
    digits, letters and bytes beyond ASCII; a word weighs the square root of how often it occurs."""
    hashes, text = word_hashes(texts, _NO_WORD)
    out = np.zeros((len(texts), len(seeds)), np.uint64)
    if len(hashes):
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        heads = np.flatnonzero(np.concatenate(([True], (np.diff(hashes) != 0) | (np.diff(text) != 0))))
        weights = np.sqrt(np.diff(np.append(heads, len(hashes)))).astype(np.float32)
        hashes, text = hashes[heads], text[heads]
        first = np.flatnonzero(np.concatenate(([True], np.diff(text) != 0)))
        half = np.add.reduceat(weights, first) / 2
        for k, seed in enumerate(seeds):
            octets = mixed(hashes ^ np.uint64(seed)).view(np.uint8).reshape(-1, 8)
            bits = np.add.reduceat(np.unpackbits(octets, axis=1) * weights[:, None], first, axis=0)
            out[text[first], k] = np.packbits(bits > half[:, None], axis=1).view(np.uint64).ravel()
    return out.view(np.int64)


def least_hashes(texts: list[bytes]) -> np.ndarray:
    """Of each text (row) the smallest value of its five-word shingles under each of BANDS * BAND_ROWS hash functions
    (column).  Two texts agree in a column with the probability of their Jaccard similarity, however short they are; texts
    without words agree in all."""
    hashes, text = shingle_hashes(texts)
    out = np.zeros((len(texts), len(_FACTORS)), np.uint64)
    if len(hashes):
        first = np.flatnonzero(np.concatenate(([True], np.diff(text) != 0)))
        for k, factor in enumerate(_FACTORS):
            out[text[first], k] = np.minimum.reduceat(hashes * factor, first)
    return out


def _bands(least: np.ndarray) -> np.ndarray:
    """A key for each band of BAND_ROWS columns of `least_hashes`."""
    rows = least.reshape(len(least), BANDS, BAND_ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for k in range(BAND_ROWS):
        keys = mixed(keys * np.uint64(0xD6E8FEB86659FD93) + rows[:, :, k])
    return keys.view(np.int64)


def _sketch(least: np.ndarray) -> np.ndarray:
    """Four bits of each column of `least_hashes`, as numbers of sixteen."""
    low = (least & np.uint64(15)).astype(np.uint8)
    low = np.pad(low, ((0, 0), (0, -low.shape[1] % 16)))
    return ((low[:, ::2] << 4) | low[:, 1::2]).view(np.int64)


def _jaccard_at_least(a: str, b: str, least: float) -> bool:
    """Whether the sets of five-word shingles are that similar; texts without words are equal."""
    x, y = (_shingles(t) for t in (a, b))
    if min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    same = len(x & y)
    return same >= least * (len(x) + len(y) - same)


@lru_cache(maxsize=16)
def _shingles(text: str, words: int = 5) -> frozenset[bytes]:
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if len(found) <= words:
        return frozenset([b" ".join(found)])
    return frozenset(map(b" ".join, zip(*(found[i:] for i in range(words)))))


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of text hashes whose texts are similar, stored.  Only their texts are fetched from `texts` (hash, text)."""
    pairs = store(pairs.distinct(), "near-pairs")
    wanted = pairs.select(F.col("a").alias("hash")).unionByName(pairs.select(F.col("b").alias("hash"))).distinct()
    near = texts.where(maybe_in(texts.sparkSession, bitmap(wanted, "hash"), "hash")).dropDuplicates(["hash"])
    found = store(near.join(wanted, "hash", "left_semi"), "near-texts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(c).to_pylist() for c in range(4))
            kept = [k for k in range(len(a)) if _jaccard_at_least(x[k], y[k], least)]
            yield pa.record_batch([pa.array([a[k] for k in kept], pa.int64()), pa.array([b[k] for k in kept], pa.int64())], ["a", "b"])

    both = (
        pairs.join(found.select(F.col("hash").alias("b"), F.col("text").alias("y")), "b")
        .join(found.select(F.col("hash").alias("a"), F.col("text").alias("x")), "a").select("a", "b", "x", "y")
    )
    return store(both.mapInArrow(verify, "a long, b long"), "near-links")


def similar_texts(texts: DataFrame, seeds: Sequence[int] = WORD_SEEDS, least: float = SIMILARITY) -> DataFrame:
    """(a, b): hashes of similar texts, from `texts` (hash, text); the components of the links are the classes.

    A shingle fingerprint moves by three bits only if almost nothing changes, so candidates come from two kinds of keys: two texts are
    candidates if one of their fingerprints of weighted words differs in three bits at most, or if they agree in all columns of a band
    of MinHashes.  A pair of similarity J shares a band with probability 1 - (1 - J^BAND_ROWS)^BANDS, 0.99993 at 0.8, at any
    length.  Candidates are linked if the Jaccard similarity of their five-word shingles is `least` or more, which is computed exactly.

    Candidates are verified in two passes.  First every text with the hub of each ball or band's key that it is in, the member that
    shares most with others; a text with thousands of near copies is that hub.  The second pass takes all pairs in a band's
    key that the first has not brought into one class, and whose MinHashes come within `_SLACK` (4 standard errors) of the
    similarity; copies that differ from each other more than from their origin are told apart there, without their texts.
    Texts that only a fingerprint brings together meet their hub, but not each other."""
    spark = texts.sparkSession
    known_to_workers(spark)

    @F.arrow_udf("array<bigint>")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """The fingerprints, then the bands' keys, then the sketch."""
        for batch in batches:
            rows = []
            for part in slices(batch.cast(pa.binary()), 64):
                part = [t or b"" for t in part]
                found = least_hashes(part)
                rows += np.concatenate([word_fingerprints(part, seeds), _bands(found), _sketch(found)], axis=1).tolist()
            yield pa.array(rows, pa.list_(pa.int64()))

    nodes = texts.select("hash", prints("text").alias("fps")).groupBy("hash").agg(F.first("fps").alias("fps"))
    nodes = store(nodes, "near-nodes")
    hubs = []
    for k in range(len(seeds)):
        keyed = nodes.select("hash", F.col("fps")[k].alias("fp"))
        held = keyed.groupBy("fp").agg(F.min("hash").alias("rep"))
        balls = store(_balls(store(_met(held, "fp"), "near-met")).select("centre", "fp").distinct(), "near-balls")
        degree = balls.groupBy("fp").agg(F.count("*").alias("degree"))
        ranked = balls.join(degree, "fp").select("centre", "fp", F.struct("degree", "fp").alias("rank"))
        hub = ranked.groupBy("centre").agg(F.max("rank").alias("hub"))
        stars = ranked.join(hub, "centre").select("fp", F.col("hub.fp").alias("hub")).where("fp <> hub").distinct()
        reps = held.withColumnsRenamed({"fp": "hub", "rep": "hub_rep"})
        hubs.append(stars.join(held, "fp").join(reps, "hub").select(F.col("rep").alias("a"), F.col("hub_rep").alias("b")))
        hubs.append(keyed.join(held, "fp").where("hash <> rep").select(F.col("hash").alias("a"), F.col("rep").alias("b")))

    banded = nodes.select("hash", F.explode(F.slice("fps", len(seeds) + 1, BANDS)).alias("key"))
    shared = store(banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "near-keys")
    banded = store(banded.join(shared, "key"), "near-banded")
    weight = banded.groupBy("hash").agg(F.sum("n").alias("weight"))
    ranked = banded.join(weight, "hash").select("key", F.struct("weight", "hash").alias("rank"))
    hub = ranked.groupBy("key").agg(F.max("rank").alias("hub"))
    hubs.append(banded.join(hub, "key").select(F.col("hash").alias("a"), F.col("hub.hash").alias("b")).where("a <> b"))

    def ordered(pairs: Sequence[DataFrame]) -> DataFrame:
        every = reduce(DataFrame.unionByName, pairs)
        return every.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    tried = store(ordered(hubs), "near-tried")
    first = _verified(tried, texts, least)
    classes = store(components(first).withColumnRenamed("node", "hash"), "near-classes")
    # columns of four bits that differ: fold each one's bits into its lowest and count
    size = -(-len(_FACTORS) // 16)
    words = [f"(x_sketch[{i}] ^ y_sketch[{i}])" for i in range(size)]
    folded = [f"({w} | shiftright({w}, 1) | shiftright({w}, 2) | shiftright({w}, 3)) & 1229782938247303441L" for w in words]
    different = "(" + " + ".join(f"bit_count({f})" for f in folded) + ")"
    most = int(len(_FACTORS) * (1 - 0.5**4) * (1 - least + _SLACK))
    sketch = F.slice("fps", len(seeds) + BANDS + 1, size).alias("sketch")
    classed = banded.join(classes, "hash", "left").select("key", "hash", F.coalesce("component", "hash").alias("class"))
    open_keys = classed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("key")
    classed = store(classed.join(open_keys, "key").join(nodes.select("hash", sketch), "hash"), "near-open")
    x = classed.select("key", *[F.col(c).alias(f"x_{c}") for c in ("hash", "class", "sketch")])
    y = classed.select("key", *[F.col(c).alias(f"y_{c}") for c in ("hash", "class", "sketch")])
    close = x.join(y, "key").where(f"x_hash > y_hash AND x_class <> y_class AND {different} <= {most}")
    rest = close.select(F.col("x_hash").alias("a"), F.col("y_hash").alias("b"))
    second = _verified(ordered([rest]).join(tried, ["a", "b"], "left_anti"), texts, least)
    return first.unionByName(second)


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one document of each component of near-duplicates (fingerprints of three-word shingles that differ in three bits
    at most): the one with the smallest id (null last), of equal ids the smallest hash of the text, of rows equal in both
    any one.  A null text is an empty one.  All columns stay as they are, whatever their names.

    Rows whose text is in a component of its own and occurs once are passed on where they are read; only the
    others are shuffled: a bitmap of fixed size holds the hashes of their texts."""
    hash_ = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(id_column).alias("id"), hash_.alias("hash"), F.col(text).alias("text"))
    rows = store(fingerprints(rows), "simhash")
    rows = rows.join(_classes(rows), "fp").select("class", F.struct(F.col("id").isNull().alias("last"), "id", "hash").alias("at"))
    rows = store(rows, "simhash-rows")
    firsts = rows.groupBy("class").agg(F.min("at").alias("at"), F.count("*").alias("n")).where("n > 1")
    firsts = store(firsts.select("class", F.col("at.id").alias("first"), F.col("at.hash").alias("of")), "simhash-firsts")
    several = store(rows.join(firsts, "class").select("at.hash").distinct(), "simhash-several")
    marked = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), hash_.alias("hash"))
    marked = marked.withColumn("near", maybe_in(docs.sparkSession, bitmap(several, "hash"), "hash"))
    open_ = marked.where("near")
    alone = open_.join(several, "hash", "left_anti").select("row")
    chosen = open_.join(firsts, (F.col("hash") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")), "left_semi")
    chosen = chosen.dropDuplicates(["hash"]).select("row")
    return marked.where("NOT near").select("row").unionByName(alone).unionByName(chosen).select("row.*")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`near_duplicates` of all documents, with the fingerprint in hexadecimal digits; nulls, ties and repeated rows as there."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    keyed = near_duplicates(docs)
    return keyed.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
