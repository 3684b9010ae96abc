"""Mixing sources to target weights, in DataFrame operations alone.

Every row gets a hash-random key that depends on its contents only, so reruns agree.  Each
source is cut into equal ranges of the key, as many as its share of all rows asks for, so a source that
holds most rows is spread over as many more tasks.  Token counts are summed per range, the sums are turned
into prefix sums over the ranges of a source (one short row per range), and rows add the prefix sum within their
range.  A row's place in the source's random order is then known in tokens, and the source's budget is
cut there: every row is taken as often as the budget holds whole epochs, rows before the cut once
more, and the row on the cut in part, so that a source gives exactly its budget.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import read_table, store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
ROWS_A_RANGE = 50_000


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none.  Counts the places where a word starts."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, source: str = "source", weights: Sequence[float] = WEIGHTS,
            most_epochs: float = MOST_EPOCHS) -> DataFrame:
    """`sizes`, one row per source with its source_size, with `target`: sources in code point order, null last,
    take the weights in turn and share the sum of all sizes by them; a target stops at
    `most_epochs` times its source's size and what is above is shared again by weight.

    With sources in ascending order of size per weight, those that stop come first.  A source
    stops if the level (words per unit of weight) that is left when all before it have stopped would
    give it its maximum or more.  One row per source; sums over that order replace the rounds of resharing."""
    # 2^53 words and 10,000 sources keep the sums exact; `size` of a source is a long
    order = Window.orderBy(F.col(source).asc_nulls_last())
    turn = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col(source).asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    most = F.lit(float(most_epochs)) * F.col("source_size")
    level = (F.col("all_words") - F.coalesce(F.sum(most).over(before), F.lit(0.0))) / F.sum("weight").over(after)
    return (
        sizes.withColumn("weight", weight)
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("level", level)
        .withColumn("stops", F.col("level") * F.col("weight") >= most)
        # the level of the first source that does not stop holds for all after it
        .withColumn("final", F.min(F.when(~F.col("stops"), F.struct(F.col("source_size") / F.col("weight"), F.col("level")))).over(everything))
        .withColumn("target", F.when(F.col("stops"), most).otherwise(F.col("final.level") * F.col("weight")))
        .drop("weight", "all_words", "level", "stops", "final")
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, most_epochs: float = MOST_EPOCHS,
        rows_a_range: int = ROWS_A_RANGE, keep: Sequence[str] = ()) -> DataFrame:
    """Per row of `docs`: id, source, size, source_size, target and `taken`, the words that the mix takes with repeats,
    and the columns `keep`.

    Null texts and texts without words have size 0 and are never taken.  Null is a source of its own.  Equal rows
    are ordered by chance of their task but take the same words in all; a source whose texts are all
    empty has target 0.  Columns of `docs` that are not asked for are left out, so no names clash."""
    rows = docs.select(
        F.col(id_column).alias("_id"), F.col(source).alias("_source"), word_count(F.col(text)).alias("_size"),
        F.xxhash64(F.col(id_column), F.col(text)).alias("_key"),
        F.struct(*[F.col(c) for c in keep]).alias("_kept") if keep else F.lit(None).cast("string").alias("_kept"),
    )
    rows = store(rows, "mixing-sizes")
    sources = store(
        targets(
            rows.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("_rows")),
            "_source", weights, most_epochs,
        ),
        "mixing-sources",
    )
    # equal ranges of the key, numbered from 0: as many as keep about `rows_a_range` rows in each
    ranges = F.ceil(F.col("_rows") / rows_a_range)
    share = F.shiftrightunsigned("_key", 11) / F.lit(float(1 << 53))
    placed = rows.join(sources, rows._source.eqNullSafe(sources._source)).drop(sources._source)
    placed = placed.withColumn("_range", F.floor(share * ranges))
    sums = placed.groupBy("_source", "_range").agg(F.sum("_size").alias("_words"))
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # stored, so that its size decides how it is joined before the rows are dealt
    starts = store(sums.select(
        F.col("_source").alias("_s"), F.col("_range").alias("_r"),
        F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_range_start"),
    ), "mixing-ranges")
    inside = Window.partitionBy("_source", "_range").orderBy("_key", "_id", "_size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor(F.col("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    left = budget - epochs * F.col("source_size") - F.col("_start")
    return (
        placed.withColumn("_in_range", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .join(starts, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
        .withColumn("_start", F.col("_range_start") + F.col("_in_range"))
        .withColumn("taken", epochs * F.col("_size") + F.greatest(F.lit(0), F.least("_size", left)))
        .select(
            F.col("_id").alias(id_column), F.col("_source").alias(source), F.col("_size").alias("size"),
            "source_size", "target", F.col("taken").cast("long"), *(["_kept.*"] if keep else []),
        )
    )


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
                    **options) -> DataFrame:
    """The mix as documents with the columns of `docs`: a row for every epoch of a document, and of the document on
    its source's cut the words before the cut, joined by spaces."""
    kept = [c for c in docs.columns if c not in (id_column, source)]
    rows = mix(docs.withColumnsRenamed({c: f"_in_{c}" for c in kept}), id_column, f"_in_{text}", source,
               keep=[f"_in_{c}" for c in kept], **options)
    whole, part = F.floor(F.col("taken") / F.col("size")).cast("int"), F.col("taken") % F.col("size")
    words = F.regexp_extract_all(f"_in_{text}", F.lit(WORD), F.lit(0))
    cut = F.when(part > 0, F.array(F.array_join(F.slice(words, F.lit(1), part.cast("int")), " ")))
    copies = F.concat(F.array_repeat(F.col(f"_in_{text}"), whole), F.coalesce(cut, F.array().cast("array<string>")))
    taken = rows.where("taken > 0").withColumn("_copy", F.explode(copies))
    renamed = {c: F.col(c) if c in (id_column, source) else F.col("_copy") if c == text else F.col(f"_in_{c}") for c in docs.columns}
    return taken.select([column.alias(c) for c, column in renamed.items()])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
