"""Secret scan with corpus-wide ownership frequency.

Base spans are what the patterns below match: assignments to a password-like name, access keys, long hex strings.
Every base span is a candidate, and so is every other long token of letters and digits.  Candidates are hashed and
counted over the whole corpus by distinct repositories and owners: a value that many of them hold is a widely
copied example; one that few hold and that looks random is an owner-specific, live-looking credential.

A copied document does not make its values examples: exact and near copies of a text are one holder of a value, which
stands for one owner and one repository.  Near copies are looked for among the texts of those values alone that are above the limits
without them.  A text of fewer than `LEAST_WORDS` words has no shingle that would tell a copied document from a
common snippet, so it counts for each of its owners.

Base spans are always returned.  Tokens without a pattern become spans of kind `owned` if they are live.  Every
span comes with its verdict.

Values leave the scan as hashes only.  Counts are pre-aggregated by value, text, repository and owner before the shuffle, so
an example that a third of all documents hold is counted like any other.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import components, known_to_workers, read_table, store
from ebbtide.llm.simhash import similar_texts

KINDS = ("assign", "access", "hex", "owned")
MOST_OWNERS, MOST_REPOSITORIES = 4, 8
LEAST_WORDS = 5
LEAST_LENGTH, LEAST_ENTROPY = 16, 3.0
PLACEHOLDERS = ("example", "placeholder", "changeme", "your", "xxxx", "test", "dummy", "sample")

# letters of the names in either case, ASCII only
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
# runs that are long enough; shorter ones would be dropped
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")

_WORD = r"[^\x20\x09-\x0D]+"

SPAN = "struct<kind:int, start:int, stop:int, value:bigint, random:boolean>"


def looks_random(value: str) -> bool:
    """Long, with letters and digits, of high entropy and no placeholder."""
    if len(value) < LEAST_LENGTH or not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
        return False
    low = value.lower()
    if any(p in low for p in PLACEHOLDERS):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= LEAST_ENTROPY


def scan(text: str | None) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of all candidates of one text, by start, then kind; offsets in code points.  Tokens
    that overlap a base span are left to it."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [(0, *m.span(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(1, *m.span(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(2, *m.span(), m[0]) for m in _HEX.finditer(text)]
    base, k = sorted((a, b) for _, a, b, _ in found), 0
    covered = 0  # the end of the base spans that start before the token's end
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while k < len(base) and base[k][0] < b:
            covered = max(covered, base[k][1])
            k += 1
        if covered <= a and looks_random(m[0]):
            found.append((3, a, b, m[0]))
    return sorted(found, key=lambda s: (s[1], s[0]))


def candidates(docs: DataFrame, text: str = "text", name: str = "candidates") -> DataFrame:
    """`docs` with array `name` of the candidates of column `text`; a column of that name is replaced."""
    known_to_workers(docs.sparkSession)

    @F.arrow_udf(f"array<{SPAN}>")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
                                   ("value", pa.int64()), ("random", pa.bool_())]))
        for texts in batches:
            yield pa.array([
                [{"kind": k, "start": a, "stop": b, "value": xxhash.xxh64_intdigest(v.encode()) - (1 << 63),
                  "random": looks_random(v)} for k, a, b, v in scan(text)]
                for text in texts.to_pylist()
            ], kind)

    return docs.withColumn(name, column(F.col(text)))


def ownership(found: DataFrame) -> DataFrame:
    """(value, owners, repositories) from (value, holder, owner, repository): how many different ones hold each value, where a
    holder counts for one owner and one repository, those with the fewest holders of the value; null counts as one."""

    def counted(of: str) -> DataFrame:
        held = found.select("value", "holder", of).distinct()
        spread = held.groupBy("value", of).agg(F.count("*").alias("n")).withColumnsRenamed({"value": "_value", of: "_of"})
        ranked = held.join(spread, (F.col("value") == F.col("_value")) & F.col(of).eqNullSafe(F.col("_of")))
        one = ranked.groupBy("value", "holder").agg(F.min(F.struct("n", of)).alias("at"))
        return one.select("value", f"at.{of}").distinct().groupBy("value")

    owners = counted("owner").agg(F.count("*").alias("owners"))
    return owners.join(counted("repository").agg(F.count("*").alias("repositories")), "value")


def _ownership_without_copies(held: DataFrame, texts: DataFrame, most_owners: int, most_repositories: int) -> DataFrame:
    """`ownership` of `held` (value, text_hash, short, owner, repository); `texts` (hash, text) holds all texts."""
    alone = F.xxhash64("text_hash", F.coalesce("owner", F.lit("")), F.col("owner").isNull(),
                       F.coalesce("repository", F.lit("")), F.col("repository").isNull())
    held = store(
        held.distinct().withColumn("holder", F.when(F.col("short"), alone).otherwise(F.col("text_hash"))), "secret-holders"
    )
    counts = store(ownership(held), "secret-counts")
    above = counts.where((F.col("owners") > most_owners) | (F.col("repositories") > most_repositories))
    contested = store(held.join(above.select("value"), "value"), "secret-contested")
    wanted = contested.where("NOT short").select(F.col("text_hash").alias("hash")).distinct()
    if wanted.isEmpty():
        return counts
    near = store(texts.join(wanted, "hash", "left_semi").dropDuplicates(["hash"]), "secret-texts")
    classes = components(similar_texts(near))
    merged = contested.join(classes, contested.holder == classes.node, "left").withColumn(
        "holder", F.coalesce("component", "holder")
    )
    return counts.join(above.select("value"), "value", "left_anti").unionByName(ownership(merged))


def secrets(docs: DataFrame, id_column: str = "doc_id", text: str = "text", owner: str = "source",
            repository: str | None = None, most_owners: int = MOST_OWNERS,
            most_repositories: int = MOST_REPOSITORIES) -> DataFrame:
    """Per row of `docs`: id and `spans`, an array of (kind, start, stop, verdict) by start, then kind.

    Kinds are numbered as in `KINDS`.  The verdict is "copied" (more owners or repositories than allowed, copies of a
    document counted once), "live" (few of both and random-looking) or "plain" (few, but not random-looking).  `repository` is the column of that name, or the
    owner if not given.  Null texts have no spans; null ids, owners and repositories are values like any other;
    repeated rows are each reported and count once for their owner.  Other columns are ignored."""
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(owner).cast("string").alias("owner"),
        F.col(repository or owner).cast("string").alias("repository"), F.col(text).alias("text"),
    )
    content = F.coalesce("text", F.lit(""))
    texts = rows.select(F.xxhash64(content).alias("hash"), content.alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64(content)).withColumn("short", F.regexp_count(content, F.lit(_WORD)) < LEAST_WORDS)
    rows = store(candidates(rows).drop("text").withColumn("row", F.monotonically_increasing_id()), "secrets")
    spans = rows.select("row", "text_hash", "short", "owner", "repository", F.explode("candidates").alias("span"))
    counted = _ownership_without_copies(
        spans.select("span.value", "text_hash", "short", "owner", "repository"), texts, most_owners, most_repositories
    )
    copied = (F.col("owners") > most_owners) | (F.col("repositories") > most_repositories)
    judged = spans.withColumn("value", F.col("span.value")).join(counted, "value").withColumn(
        "verdict", F.when(copied, "copied").when(F.col("span.random"), "live").otherwise("plain")
    ).where("span.kind < 3 OR verdict = 'live'")
    per_row = judged.groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("span.start", "span.kind", "span.stop", "verdict")
    )).alias("spans"))
    in_order = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["verdict"].alias("verdict")))
    none = F.array().cast("array<struct<kind:int,start:int,stop:int,verdict:string>>")
    return rows.select("row", "id").join(per_row, "row", "left").select(
        F.col("id").alias(id_column), F.coalesce(in_order, none).alias("spans")
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is the owner, its documents in one language are a repository."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", F.concat_ws("/", "source", "lang").alias("repository")
    )
    found = secrets(docs, repository="repository", most_repositories=MOST_REPOSITORIES)

    def joined(kinds: str) -> Column:
        names = ", ".join(f"'{k}'" for k in KINDS)
        return F.expr(
            f"array_join(transform(filter(spans, s -> {kinds}), "
            f"s -> concat_ws(':', element_at(array({names}), s.kind + 1), s.start, s.stop)), ',')"
        )

    def number(of: str) -> Column:
        return F.expr(f"cast(size(filter(spans, s -> {of})) as bigint)")

    return found.select(
        "doc_id", number("s.kind = 0").alias("n_assign"), number("s.kind = 1").alias("n_access"),
        number("s.kind = 2").alias("n_hex"), F.sha2(joined("s.kind < 3"), 256).alias("base_sha256"),
        joined("true").alias("spans"), number("s.verdict = 'live'").alias("n_live"),
        number("s.verdict = 'copied'").alias("n_copied"),
    )
