"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a given lexicon and of a learned one, how many of their words stand near a
second person, capitals, punctuation and obfuscation rates, and lexicon words that appear only when an obfuscation
is undone.  Texts are read in one pass, and the stored features are small.

Training uses a bounded sample of the labelled rows, about `TRAIN_ROWS` chosen by a hash of the id, in three parts: one
finds the learned lexicon (words that are much more frequent in toxic texts), one fits the trees, one the
calibration.  The parts are disjoint, so that a word that is frequent by chance is not trusted, and scores
are calibrated on texts that the trees have not seen.  Everything else covers all rows.
"""

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import bitmap, known_to_workers, maybe_in, read_table, slices, store

TRAIN_ROWS = 60_000
PARTS = {"lexicon": (0, 4), "trees": (4, 8), "calibration": (8, 10)}  # tenths of the sample
CANDIDATE_WORDS, LEARNED_WORDS = 4000, 64
LEAST_SHARE, LEAST_LOG_ODDS = 0.02, 2.0
NEAR_WORDS = 4
TREES, DEPTH, SEED = 30, 3, 42

# words that insult or demean, in the languages of the texts
LEXICON = frozenset(
    """
    idiot idiots moron morons stupid dumb loser losers trash garbage scum pathetic worthless disgusting clown fool
    imbecile jerk bastard bitch crap damn hell hate ugly filthy freak creep coward liar pig rat vermin useless
    hopeless ridiculous shut kill die sucks suck
    dumm blöd blödmann depp trottel arschloch versager widerlich erbärmlich abschaum
    idiota estúpido imbécil basura asqueroso inútil payaso perdedor
    stupide débile ordure minable dégoûtant nul clochard
    """.split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself youre u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre tú ti usted ustedes".split()
)

_WORD = re.compile(r"[^\W\d_]+")
_SHOUTED = re.compile(r"(?<![A-Za-z])[A-Z]{3,}(?![A-Za-z])")
_RUN = re.compile(r"[!?]{2,}")
_OBFUSCATED = re.compile(r"[A-Za-z][@$*0-9|!+]+(?=[A-Za-z])")
_STRETCHED = re.compile(r"([A-Za-z])\1\1")
_UNDO = str.maketrans("013457@$!|+", "oieastasilt", "*._-")
_UPPER = bytes(range(65, 91))
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_DIGITS = b"0123456789"

NAMES = (
    "words", "given_hits", "given_density", "learned_hits", "learned_density", "learned_weight", "near_second",
    "near_share", "second_density", "capitals", "shouted", "exclamations", "questions", "runs", "punctuation",
    "digits", "obfuscated", "undone_hits", "stretched",
)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def features(text: str | None, learned: dict[str, float], marked: frozenset[str]) -> list[float]:
    """The features of one text, in the order of `NAMES`.  Null is the empty text, whose features are all 0.  `marked`
    holds all words that count."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    low = text.lower()
    words = _WORD.findall(low)
    n, size = max(1, len(words)), max(1, len(data))
    given, found, weight, near, second = 0, 0, 0.0, 0, 0
    for i in [i for i, w in enumerate(words) if w in marked]:
        word = words[i]
        second += word in SECOND_PERSON
        given += word in LEXICON
        found += word in learned
        weight += learned.get(word, 0.0)
        if word in LEXICON or word in learned:
            near += not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR_WORDS) : i + NEAR_WORDS + 1])
    obfuscated = len(_OBFUSCATED.findall(text))
    undone = 0
    if obfuscated:
        for token in low.split():
            if not token.isalpha():
                plain = token.strip(".,;:?").translate(_UNDO)
                undone += (plain in LEXICON or plain in learned) and plain not in token
    share = lambda k: k / n
    rate = lambda k: k / size
    return [
        math.log1p(len(words)), math.log1p(given), share(given), math.log1p(found), share(found), share(weight),
        math.log1p(near), near / max(1, given + found), share(second),
        rate(size - len(data.translate(None, _UPPER)) if data else 0), share(len(_SHOUTED.findall(text))),
        rate(data.count(b"!")), rate(data.count(b"?")), share(len(_RUN.findall(text))),
        rate(len(data) - len(data.translate(None, _PUNCTUATION))),
        rate(len(data) - len(data.translate(None, _DIGITS))), share(obfuscated), math.log1p(undone),
        share(len(_STRETCHED.findall(text))),
    ]


def with_features(docs: DataFrame, text: str, learned: dict[str, float], name: str) -> DataFrame:
    known_to_workers(docs.sparkSession)
    marked = LEXICON | SECOND_PERSON | learned.keys()

    @F.arrow_udf("array<double>")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([features(t, learned, marked) for part in slices(texts) for t in part], pa.list_(pa.float64()))

    return docs.withColumn(name, column(F.col(text)))


def held_out(id_column: str) -> Column:
    """Whether labels of a row are kept from training; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_sample(labels: DataFrame, id_column: str, label: str, rows: int) -> DataFrame:
    """(_id, label, part): labelled rows that may be learned from, one per id (the larger label), and of these
    about `rows` by a hash of the id."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column))
    known = known.groupBy(F.col(id_column).alias("_id")).agg((F.max(label) > 0).cast("double").alias("label"))
    share = min(1.0, rows / max(1, known.count()))
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) / float(1 << 20)
    tenth = F.pmod(F.xxhash64("_id", F.lit("part")), F.lit(10))
    part = F.when(tenth < PARTS["lexicon"][1], "lexicon").when(tenth < PARTS["trees"][1], "trees").otherwise("calibration")
    return known.where(place < share).select("_id", "label", part.alias("part"))


def learned_lexicon(texts: DataFrame, text: str) -> dict[str, float]:
    """Words and their log-odds, from rows (`text`, label): at most `LEARNED_WORDS` that stand in `LEAST_SHARE` of the toxic
    texts at least and whose odds of toxicity are e^LEAST_LOG_ODDS times the usual.

    The candidates are the words that most toxic texts hold; only they are counted in the others.  Each task counts
    its own texts, so a few thousand short rows are shuffled per task."""
    spark = texts.sparkSession

    def counter(candidates: frozenset[str] | None):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: dict[str, int] = {}
            for batch in batches:
                for content in (t for part in slices(batch.column(0)) for t in part):
                    words = set(words_of(content))
                    for w in words if candidates is None else words & candidates:
                        counts[w] = counts.get(w, 0) + 1
                if len(counts) > 1_000_000:
                    yield pa.record_batch([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
                    counts = {}
            yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        return count

    def counted(label: int, candidates: frozenset[str] | None) -> DataFrame:
        rows = texts.where(F.col("label") == label).select(text)
        return rows.mapInArrow(counter(candidates), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))

    totals = {int(r.label): r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {}
    known_to_workers(spark)
    top = counted(1, None).where(F.col("n") >= max(2, LEAST_SHARE * toxic))
    in_toxic = {r.word: r.n for r in top.orderBy(F.desc("n"), "word").limit(CANDIDATE_WORDS).collect()}
    in_clean = {r.word: r.n for r in counted(0, frozenset(in_toxic)).collect()}
    odds = {
        w: math.log((n + 0.5) / (toxic - n + 0.5)) - math.log((in_clean.get(w, 0) + 0.5) / (clean - in_clean.get(w, 0) + 0.5))
        for w, n in in_toxic.items()
    }
    best = sorted((w for w in odds if odds[w] >= LEAST_LOG_ODDS), key=lambda w: (-odds[w] * math.sqrt(in_toxic[w]), w))
    return {w: odds[w] for w in best[:LEARNED_WORDS]}


def score(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
          label: str = "toxic", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """`docs` with `score`, the calibrated probability that a text is toxic; a column of that name is replaced.

    Learned are the labels of `labels` that `held_out` allows.  Nothing but the text enters a score, so equal texts
    score alike; null is the empty text.  If one of the labels is missing, every score is the share of toxic labels
    (0 without labels)."""
    # here, so that Python workers, which import this module for the features, do not load it
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    # bounded by `train_rows`
    sample = store(training_sample(labels, id_column, label, train_rows), "toxicity-sample")
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    learning = texts.join(F.broadcast(sample.where("part = 'lexicon'")), "_id").select("_text", "label")
    learned = learned_lexicon(learning, "_text")

    kept = [c for c in docs.columns if c not in (text, "score")]
    rows = with_features(docs.select(*kept, F.col(text).alias("_text")), "_text", learned, "_features")
    rows = store(rows.drop("_text"), "toxicity-features")
    train = rows.select(F.col(id_column).alias("_id"), "_features").join(F.broadcast(sample), "_id")
    train = store(train.select("part", "label", array_to_vector("_features").alias("features")).coalesce(32), "toxicity-train")
    trees, calibration = (train.where(F.col("part") == p) for p in ("trees", "calibration"))
    counts = {(r.part, int(r.label)): r.n for r in train.groupBy("part", "label").agg(F.count("*").alias("n")).collect()}
    if not all(counts.get((p, v)) for p in ("trees", "calibration") for v in (0, 1)):
        total = sum(counts.values())
        prior = sum(n for (_, v), n in counts.items() if v) / total if total else 0.0
        return rows.select(*kept, F.lit(prior).alias("score"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=64, stepSize=0.2, seed=SEED).fit(trees)
    model.setPredictionCol("").setRawPredictionCol("")

    def probability(frame: DataFrame) -> DataFrame:
        return model.transform(frame).withColumn("_p", vector_to_array("probability")[1])

    fitted = IsotonicRegression(labelCol="label", featuresCol="_p", predictionCol="_score").fit(probability(calibration))
    scored = fitted.transform(probability(rows.withColumn("features", array_to_vector("_features"))))
    return scored.select(*kept, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_score"))).alias("score"))


def below(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_column: str = "doc_id", text: str = "text",
          **options) -> DataFrame:
    """`docs` whose score is below `threshold`, with all columns as they are, whatever their names; repeated rows are judged alike.

    The rejected texts are few and known by their hash (of the text as it stands); a bitmap of fixed size passes the
    others on where they are read, and only texts that share a bit with a rejected one are joined."""
    hash_ = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), hash_.alias("hash"))
    known = labels.select(F.col(id_column).alias("id"), options.get("label", "toxic"))
    scored = score(rows, known, "id", "text", **options)
    rejected = store(scored.where(F.col("score") >= threshold).select("hash").distinct(), "toxicity-rejected")
    marked = docs.select(F.struct("*").alias("row"), hash_.alias("hash"))
    marked = marked.withColumn("near", maybe_in(docs.sparkSession, bitmap(rejected, "hash"), "hash"))
    clean = marked.where("near").join(rejected, "hash", "left_anti")
    return marked.where("NOT near").select("row").unionByName(clean.select("row")).select("row.*")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`score` of all documents.  A null text is the empty one and has a score; a null id counts as the empty text for `held_out`."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, read_table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
