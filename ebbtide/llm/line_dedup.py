"""Line deduplication by a segment-partition edit join.

Lines are stripped of white space at both ends.  Two lines are linked if at most `allowed` insertions, deletions and
substitutions of characters turn one into the other: none below 8 characters of the shorter line, one from there, two from 24
(`STEPS`); equal lines are one.  Linked lines form classes (all that can be reached); of each class only the first line of the
corpus stays, by ascending document id (null last), then the row, then the place in the text.  Blank lines stay.

The join.  A line that others may differ from in k edits is cut into k + 1 even segments.  A line within that many edits keeps
one of them unchanged, near its place.  Every line therefore indexes its segments under its length and probes the
indexes of its own and the shorter lengths with those of its substrings that can be that segment; where alignments overlap the
narrowest range of places is enough.  For two edits this makes 12 keys a line.  All keys are written once and cross one exchange,
which drops the keys that only one line has.

The lines of a key are compared inside a task, in blocks of bounded size: a key of many lines is dealt to several tasks, one
for every two blocks.  First go 64-bit signatures, the parities of how often characters of 64 classes occur: an edit changes two of
them at most.  Lines with a likely partner get their text (a bitmap of fixed size drops the others where they are read), and a
bit-parallel edit distance in a band of 2k + 1 diagonals verifies.  A pair that meets under several keys counts under the first.
What leaves a task is a row per line with the number of its links and its local class, so the rows grow with
the lines of a key and not with their pairs.

Lines go by a 64-bit hash of their text.
"""

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import bitmap, components, known_to_workers, maybe_in, read_table, slices, store

# (characters, edits): lines of at least so many characters may differ in so many edits
STEPS = ((8, 1), (24, 2))
# lines, and characters, of a key that are compared with each other at once
BLOCK_LINES, BLOCK_CHARS = 1024, 1 << 22
# line hashes that a task remembers to write a repeated line's keys once
SEEN = 100_000
_HALF = 1 << 63
_PIECE = 1 << 18

Steps = Sequence[tuple[int, int]]


def lines_of(text: str | None) -> list[str]:
    return [line.strip() for line in (text or "").split("\n")]


def line_hash(line: str) -> int:
    """Signed 64-bit hash; 0 stands for a blank line."""
    return xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) - _HALF if line else 0


def allowed(length: int, steps: Steps = STEPS) -> int:
    """How many edits a line may differ in from one that is not shorter."""
    return max((edits for least, edits in steps if length >= least), default=0)


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, stop) of the even segments of a line; the longer ones come last."""
    each, longer = divmod(length, edits + 1)
    sizes = [each + (k > edits - longer) for k in range(edits + 1)]
    starts = [sum(sizes[:k]) for k in range(edits + 1)]
    return [(a, a + n) for a, n in zip(starts, sizes)]


def _seed(length: int, segment: int) -> int:
    return length * 64 + segment


@lru_cache(100_000)
def meetings(length: int, other: int, edits: int) -> tuple[tuple[int, int, int, int], ...]:
    """(segment, its start, its stop, start in the longer line): where a line of `length` may hold a segment of one of `other`."""
    more, held = length - other, []
    for i, (p, q) in enumerate(segments(other, edits)):
        first = max(0, p - i, p + more - (edits - i))
        last = min(length - (q - p), p + i, p + more + (edits - i))
        held += [(i, p, q, a) for a in range(first, last + 1)]
    return tuple(held)


@lru_cache(100_000)
def probes(length: int, steps: Steps) -> tuple[tuple[tuple[int, int, int], ...], np.ndarray]:
    """(start, stop, seed) of the substrings that a line looks up, and whether it is indexed under each.  The seed tells apart lengths and
    segments."""
    held, own = [], []
    for other in range(max(1, length - allowed(length, steps)), length + 1):
        edits = allowed(other, steps)
        if 0 < edits >= length - other:
            for i, p, q, a in meetings(length, other, edits):
                held.append((a, a + q - p, _seed(other, i)))
                own.append(other == length and a == p)
    return tuple(held), np.array(own, bool)


def signatures(lines: list[str]) -> np.ndarray:
    """Per line the parities of the characters of each of 64 classes, as signed 64-bit numbers."""
    out = np.zeros(len(lines), np.int64)
    start = 0
    while start < len(lines):
        if len(lines[start]) > _PIECE:
            for k in range(0, len(lines[start]), _PIECE):
                out[start] ^= signatures([lines[start][k : k + _PIECE]])[0]
            start += 1
            continue
        stop, size = start, 0
        while stop < len(lines) and size + len(lines[stop]) <= _PIECE:
            size += len(lines[stop])
            stop += 1
        some = lines[start:stop]
        codes = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32) & 63
        place = np.repeat(np.arange(len(some)) * 64, [len(x) for x in some]) + codes
        odd = (np.bincount(place, minlength=64 * len(some)) & 1).astype(np.uint8)
        out[start:stop] = np.packbits(odd.reshape(-1, 64), axis=1).view(">i8")[:, 0]
        start = stop
    return out


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most `edits`.

    Row i holds, for each number of edits d, a bit per diagonal j - i in [-edits, edits]: whether a[:j] becomes b[:i] with d
    edits.  A common start and end are cut off first.  The cost grows with the length, whatever it is."""
    if abs(len(a) - len(b)) > edits:
        return False
    start, most = 0, min(len(a), len(b))
    while start < most and a[start] == b[start]:
        start += 1
    end = 0
    while end < most - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    band = (1 << (2 * edits + 1)) - 1
    rows = [(((1 << (d + 1)) - 1) << edits) & band for d in range(edits + 1)]
    for i, c in enumerate(b):
        equal, low = 0, max(0, i - edits)
        for o, x in enumerate(a[low : i + edits + 1], low - i + edits):  # a[i - edits + o] == c
            equal |= (x == c) << o
        new, above, newer = [], 0, 0
        for row in rows:
            newer = ((row & equal) | above | (above >> 1) | (newer << 1)) & band
            new.append(newer)
            above = row
        rows = new
        if not rows[-1]:
            return False
    return bool(rows[-1] >> (len(a) - len(b) + edits) & 1)


def _line_rows(docs: DataFrame, text: str, name: str) -> DataFrame:
    """`docs` with array `name` of the line hashes of column `text`, which is left out."""

    @F.arrow_udf("array<bigint>")
    def hashes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [np.array([line_hash(x) for x in lines_of(t)], np.int64) for part in slices(texts) for t in part]
            yield pa.array(rows, pa.list_(pa.int64()))

    return docs.withColumn(name, hashes(F.col(text))).drop(text)


def _key(segment: str, seed: int) -> int:
    return xxhash.xxh64_intdigest(segment.encode("utf-8", "surrogatepass"), seed) - _HALF


_KEYS = "key long, own boolean, line long, chars int, signature long"


def _keys(texts: DataFrame, steps: Steps) -> DataFrame:
    """(key, own, line, chars, signature) of the lines of the only column of `texts`; a task repeats lines that it has not seen for long."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, seen = xxhash.xxh64_intdigest, set()
        least = min(n for n, _ in steps)
        for part in (part for batch in batches for part in slices(batch.column(0), 64)):
            fresh = {}
            for x in (x for t in part for x in lines_of(t) if len(x) >= least):
                if (h := line_hash(x)) not in seen:
                    seen.add(h)
                    fresh[h] = x
            if len(seen) > SEEN:
                seen.clear()
            keys, owns = [], []
            for x in fresh.values():
                found, own = probes(len(x), steps)
                if x.isascii():
                    octets = x.encode()
                    keys += [digest(octets[a:b], seed) for a, b, seed in found]
                else:
                    keys += [digest(x[a:b].encode("utf-8", "surrogatepass"), seed) for a, b, seed in found]
                owns.append(own)
            if not fresh:
                continue
            names, sizes = np.array(list(fresh), np.int64), np.array([len(x) for x in fresh.values()], np.int32)
            times = [len(own) for own in owns]
            yield pa.record_batch([
                pa.array((np.array(keys, np.uint64) ^ np.uint64(_HALF)).view(np.int64)), pa.array(np.concatenate(owns)),
                *(pa.array(np.repeat(v, times)) for v in (names, sizes, signatures(list(fresh.values())))),
            ], ["key", "own", "line", "chars", "signature"])

    return texts.mapInArrow(emit, _KEYS)


def _texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line, text) of the lines whose hash is in `wanted` (line)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch.column(0))):
            found = {x for t in part for x in lines_of(t) if x}
            yield pa.record_batch([pa.array([line_hash(x) for x in found], pa.int64()), pa.array(list(found), pa.string())], ["line", "text"])

    lines = texts.mapInArrow(emit, "line long, text string")
    near = lines.where(maybe_in(texts.sparkSession, bitmap(wanted, "line"), "line"))
    return near.dropDuplicates(["line"]).join(wanted, "line", "left_semi")


def _of_key(total: Column) -> Column:
    return total.over(Window.partitionBy("key"))


def _members(rows: DataFrame, lines: int) -> DataFrame:
    """Each line of a key once, with the number of `blocks` of the key: about `lines` lines in each, or fewer long ones."""
    once = rows.groupBy("key", "line", "chars", "signature").agg(F.max("own").alias("own"))
    size = F.greatest(F.lit(1), F.least(F.lit(lines), F.floor(F.lit(BLOCK_CHARS) / _of_key(F.max("chars")))))
    return once.withColumn("blocks", F.ceil(_of_key(F.count("*")) / size).cast("int"))


def _meetings(members: DataFrame) -> DataFrame:
    """`members` with their `block` and the two blocks `i` <= `j` that meet, once for each meeting, in the order of the
    meetings inside a partition."""
    block = F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int")
    met = F.explode(F.expr("transform(sequence(0, blocks - 1), o -> struct(least(block, o) AS i, greatest(block, o) AS j))"))
    dealt = members.withColumn("block", block).withColumn("met", met).select("*", "met.i", "met.j").drop("met", "blocks")
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The meetings of a sorted partition, one by one."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        marks = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1]) if table.num_rows else rest
    if rest is not None and rest.num_rows:
        yield rest


def _likely(group: pa.Table, steps: Steps) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (longer lines, indexed lines) of a meeting whose signatures do not rule a link out.  Of lines of equal length that
    with the larger hash looks the other up."""
    line, chars, mark, block = (group.column(c).to_numpy() for c in ("line", "chars", "signature", "block"))
    own = np.flatnonzero(group.column("own").to_numpy())
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    if not len(own):
        return
    bits = 2 * np.array([allowed(int(n), steps) for n in chars[own]])
    for a in range(0, len(line), 256):
        x = np.arange(a, min(a + 256, len(line)))[:, None]
        longer = (chars[x] > chars[own]) | ((chars[x] == chars[own]) & (line[x] > line[own]))
        apart = block[x] + block[own] == i + j if i < j else True
        far = np.bitwise_count((mark[x] ^ mark[own]).view(np.uint64))
        rows, columns = np.nonzero(longer & apart & (far <= bits))
        if len(rows):
            yield rows + a, own[columns]


def _with_partner(members: DataFrame, steps: Steps) -> DataFrame:
    """The rows of `members` that a link is not ruled out for, once for each meeting that shows it."""
    names = ["key", "own", "line", "chars", "signature"]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            kept = np.zeros(group.num_rows, bool)
            for x, y in _likely(group, steps):
                kept[x] = kept[y] = True
            if kept.any():
                yield from group.select(names).filter(pa.array(kept)).to_batches()

    return _meetings(members).mapInArrow(keep, _KEYS)


def _verified(group: pa.Table, steps: Steps) -> Iterator[tuple[int, int]]:
    """Places of the linked lines of a meeting; a pair that met under an earlier key is left out."""
    texts, key = group.column("text").to_pylist(), group.column("key")[0].as_py()
    for some, others in _likely(group, steps):
        for a, b in zip(some.tolist(), others.tolist()):
            x, y = texts[a], texts[b]
            edits = allowed(len(y), steps)
            if len(x) - len(y) > edits:
                continue
            first = next((m for m in meetings(len(x), len(y), edits) if x.startswith(y[m[1] : m[2]], m[3])), None)
            if first and _key(y[first[1] : first[2]], _seed(len(y), first[0])) == key and within(x, y, edits):
                yield a, b


def _crowds(docs: DataFrame, text: str, steps: Steps) -> DataFrame:
    """The meetings of all lines of column `text` that may have a link, with their texts, in order."""
    known_to_workers(docs.sparkSession)
    texts = docs.select(text)
    shared = (
        _keys(texts, steps)
        .withColumns({"low": _of_key(F.min("line")), "high": _of_key(F.max("line")), "held": _of_key(F.max("own"))})
        .where("low < high AND held")
    )
    members = store(_members(shared, 2 * BLOCK_LINES), "line-keys")
    near = store(_members(_with_partner(members, steps), BLOCK_LINES), "line-partners")
    found = store(_texts(texts, near.select("line").distinct()), "line-texts")
    return _meetings(near.join(found, "line"))


def links(docs: DataFrame, text: str = "text", steps: Steps = STEPS) -> DataFrame:
    """(a, b): hashes of every two different lines of column `text` that are linked, each pair once, stored.  A crowd of near-equal lines has
    the square of its number of links; `near_lines` counts them without writing them."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            line, found = group.column("line").to_numpy(), list(_verified(group, steps))
            if found:
                ends = [line[list(side)] for side in zip(*found)]
                yield pa.record_batch([pa.array(np.maximum(*ends)), pa.array(np.minimum(*ends))], ["a", "b"])

    return store(_crowds(docs, text, steps).mapInArrow(pairs, "a long, b long"), "line-links")


def near_lines(docs: DataFrame, text: str = "text", steps: Steps = STEPS) -> DataFrame:
    """(line, class, degree): every line of column `text` with links, the smallest line it can reach, and the number of its links, stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            lead, degree = list(range(group.num_rows)), np.zeros(group.num_rows, np.int64)
            for a, b in _verified(group, steps):
                degree[a] += 1
                degree[b] += 1
                while lead[a] != a:
                    lead[a] = a = lead[lead[a]]
                while lead[b] != b:
                    lead[b] = b = lead[lead[b]]
                lead[max(a, b)] = min(a, b)
            linked = np.flatnonzero(degree)
            if len(linked):
                for k in range(len(lead)):  # a lead stands before what it leads
                    lead[k] = lead[lead[k]]
                line = group.column("line").to_numpy()
                yield pa.record_batch(
                    [pa.array(line[linked]), pa.array(line[np.array(lead)[linked]]), pa.array(degree[linked])], ["line", "lead", "degree"]
                )

    counted = store(_crowds(docs, text, steps).mapInArrow(count, "line long, lead long, degree long"), "line-links")
    classes = components(counted.select(F.col("line").alias("a"), F.col("lead").alias("b")))
    classes = classes.withColumnsRenamed({"node": "line", "component": "class"})
    return store(counted.groupBy("line").agg(F.sum("degree").alias("degree")).join(classes, "line").select("line", "class", "degree"), "line-classes")


def dropped_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", steps: Steps = STEPS) -> DataFrame:
    """`docs` without `text`, with `lines` (number), `dropped` (places of the lines that go, from 0, ascending) and `links` (how many
    different lines its lines are linked with, summed over its lines); columns of these names are replaced.

    Null and empty texts have one blank line, an empty table gives none.  Repeated rows and ids are documents of their own, the first
    one keeps the lines.  A text of any length is one row; its lines are compared whole."""
    known_to_workers(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (text, "lines", "dropped", "links", "_row", "_hashes")]
    rows = _line_rows(docs.select(*kept, text), text, "_hashes").withColumn("_row", F.monotonically_increasing_id())
    rows = store(rows, "lines")
    near = near_lines(docs, text, steps)
    single = rows.select(F.col(id_column).alias("_id"), "_row", F.posexplode("_hashes").alias("place", "line")).where("line <> 0")
    single = single.join(near, "line", "left").select(
        F.coalesce("class", "line").alias("class"), F.coalesce("degree", F.lit(0)).alias("degree"),
        F.struct(F.col("_id").isNull().alias("last"), "_id", "_row", "place").alias("at"),
    )
    # the first of each class, joined to its lines: no class is gathered or sorted
    first = single.groupBy("class").agg(F.min("at").alias("first"))
    judged = single.join(first, "class").select("at._row", "at.place", "degree", (F.col("at") != F.col("first")).alias("drop"))
    per_row = judged.where("drop OR degree > 0").groupBy("_row").agg(
        F.sort_array(F.collect_list(F.when(F.col("drop"), F.col("place")))).alias("dropped"), F.sum("degree").alias("links"),
    )
    return rows.join(per_row, "_row", "left").select(
        *kept, F.size("_hashes").cast("long").alias("lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"), F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`docs` with the dropped lines taken out of `text`; lines that stay are unchanged."""
    # equal rows that are told apart by nothing get their number from the stored copy
    numbered = docs.select(
        F.struct("*").alias("row"), F.monotonically_increasing_id().alias("copy"), F.col(id_column).alias("id"), F.col(text).alias("text")
    )
    numbered = store(numbered, "line-docs")
    gone = dropped_lines(numbered.select("id", "copy", "text"), "id", "text", **options).select(F.col("copy").alias("of"), "dropped")
    kept = F.expr("array_join(filter(split(text, '\\n', -1), (x, i) -> NOT array_contains(dropped, i)), '\\n')")
    joined = numbered.join(gone, F.col("copy") == F.col("of")).withColumn("kept", kept)
    return joined.select(*[F.col("kept").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dropped_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.col("lines").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"),
        F.col("links").alias("n_links"), F.array_join("dropped", ",").alias("dropped"),
    )
