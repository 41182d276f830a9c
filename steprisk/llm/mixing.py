"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

Documents of a source are laid out from the longest to the shortest. Every document has an expected number of copies,
these are summed along that order, one random offset per source is added, and a document is emitted once for every
integer its stretch of the sum crosses. The expectation is what is left of the target over what is left of the source,
both in words, refreshed for every class of sizes: what rounding has done to long documents is made good by shorter
ones, and a source's words end within about its shortest documents of the target, however uneven the sizes are.

There are at most 976 classes of sizes, so a source's walk is over a short array. Places within a class
come from counts: sizes within a class, ``BUCKETS`` hash buckets within a size, rows within a bucket. No task sees a
whole source, and no group of equal rows stays in one task.

Defined results: null text counts 0 words; a null source is a source of its own, last in order; a source without
words has target 0 and is never taken; documents of 0 words are never taken.
Rows with equal or null ``doc_id`` are documents of their own. Columns other than ``doc_id``, ``text`` and ``source``
play no role. An empty table gives an empty result. The offset comes from a hash of the source, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from steprisk.llm.common import free_name, word_count, written
from steprisk.operators.prefix import ordered_prefix

BUCKETS = 1024
MOST_COPIES = 3
SEED = 17
# The offset has so many binary places: ranks times whole expectations stay exact in double precision.
_OFFSET_STEPS = 1 << 20

_SOURCE = "_source"


def _source_key() -> Column:
    """Never null, so that plain equality finds the null source too."""
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """Per source of (``source``, ``source_size``): ``target``, its words in the mix.

    Targets share the sum of all sizes by weight; none exceeds ``most`` times its source, the excess goes to the others
    by weight until none is above. Ordered by size per weight, the sources that end up at their limit come first, so
    the share per unit of weight follows from two running sums.
    """
    order = [F.col("source").isNull(), F.col("source")]
    ranked = ordered_prefix(sizes.withColumn("_one", F.lit(1)), order, {"_rank": "_one"})
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    weighted = ranked.withColumns(
        {
            "_weight": F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")),
            "_limit": F.col("source_size") * most,
        }
    ).withColumn("_ratio", F.col("_limit") / F.col("_weight"))
    running = ordered_prefix(
        weighted, [F.col("_ratio"), *order], {"_weight_before": "_weight", "_limit_before": "_limit"}
    )
    totals = sizes.agg(F.sum("source_size").alias("_total")).crossJoin(  # one row beside one row
        weighted.agg(F.sum("_weight").alias("_weights"))
    )
    # The share if all sources before this one are at their limit; the first source above its share settles it.
    share = (F.col("_total") - F.col("_limit_before")) / (F.col("_weights") - F.col("_weight_before"))
    settled = (
        running.join(F.broadcast(totals))
        .withColumn("_share", share)
        .where(F.col("_ratio") >= F.col("_share"))
        .agg(F.min_by("_share", F.struct("_ratio", F.col("source").isNull(), "source")).alias("_share"))
    )
    return weighted.join(F.broadcast(settled)).select(
        "source",
        "source_size",
        F.least(F.col("_limit").cast("double"), F.col("_weight") * F.col("_share")).alias("target"),
    )


def size_class(size: Column) -> Column:
    """Classes rise with the size: sizes below 64 one by one, above that 16 to every doubling (at most 976)."""
    doubling = F.length(F.bin(size)) - 1
    within = F.floor(size / F.pow(F.lit(2.0), doubling - 4)) - 16
    return F.when(size < 64, size).otherwise(64 + (doubling - 6) * 16 + within).cast("int")


def _walk(classes: Column, target: Column, total: Column, offset: Column, most: int) -> Column:
    """For (class, rows, words) from the longest class on: (class, expected copies, sum of expectations before)."""
    start = F.struct(
        target.alias("target"),
        total.cast("double").alias("words"),
        F.lit(0.0).alias("sum"),
        F.array().cast("array<struct<class:int,expected:double,before:double>>").alias("steps"),
    )

    def step(state: Column, item: Column) -> Column:
        wanted = F.when(state["words"] > 0, state["target"] / state["words"]).otherwise(F.lit(0.0))
        expected = F.when(item["words"] > 0, F.least(F.lit(float(most)), F.greatest(F.lit(0.0), wanted))).otherwise(0.0)
        after = state["sum"] + item["rows"] * expected
        taken = (F.floor(after + offset) - F.floor(state["sum"] + offset)) * item["words"] / item["rows"]
        here = F.struct(item["class"].alias("class"), expected.alias("expected"), state["sum"].alias("before"))
        return F.struct(
            (state["target"] - taken).alias("target"),
            (state["words"] - item["words"]).alias("words"),
            after.alias("sum"),
            F.concat(state["steps"], F.array(here)).alias("steps"),
        )

    return F.aggregate(classes, start, step, lambda state: state["steps"])


def copies(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """``sized`` (``source``, ``size``, ``tie``: a hash that tells documents apart, and others) with ``source_size``,
    ``target`` and ``copies``. ``sized`` is read several times: hand over a written table."""
    tie = F.pmod(F.xxhash64("tie", F.lit(seed)), F.lit(BUCKETS)).cast("int")
    keyed = sized.withColumns({_SOURCE: _source_key(), "_class": size_class(F.col("size")), "_bucket": tie})
    cell = [_SOURCE, "_class", "size", "_bucket"]
    cells = keyed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_rows"))
    by_size = cells.groupBy(_SOURCE, "_class", "size").agg(F.sum("_rows").alias("_rows"))

    # Rows before a cell within its class: longer sizes, then earlier buckets of the same size.
    longer = Window.partitionBy(_SOURCE, "_class").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(_SOURCE, "_class", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    longer_rows = by_size.select(
        _SOURCE, "_class", "size", F.coalesce(F.sum("_rows").over(longer), F.lit(0)).alias("_longer")
    )
    starts = (
        cells.withColumn("_earlier", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .join(longer_rows, [_SOURCE, "_class", "size"])
        .select(*cell, (F.col("_longer") + F.col("_earlier")).alias("_start"))
    )

    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, most).select(_source_key().alias(_SOURCE), "source_size", "target")
    classes = (
        by_size.groupBy(_SOURCE, "_class")
        .agg(F.sum("_rows").alias("_rows"), F.sum(F.col("_rows") * F.col("size")).alias("_words"))
        .groupBy(_SOURCE)
        .agg(
            F.sort_array(
                F.collect_list(F.struct(F.col("_class").alias("class"), F.col("_rows").alias("rows"), F.col("_words").alias("words"))),
                asc=False,
            ).alias("_classes")
        )
    )
    draw = F.pmod(F.xxhash64(_SOURCE, F.lit(seed)), F.lit(_OFFSET_STEPS))
    offset = (draw + F.lit(0.5)) / F.lit(float(_OFFSET_STEPS))
    steps = (
        classes.join(targets, _SOURCE)
        .withColumn("_offset", offset)
        .select(
            _SOURCE,
            "source_size",
            "target",
            "_offset",
            F.explode(_walk(F.col("_classes"), F.col("target"), F.col("source_size"), F.col("_offset"), most)).alias("_step"),
        )
        .select(
            _SOURCE,
            F.col("_step.class").alias("_class"),
            "source_size",
            "target",
            "_offset",
            F.col("_step.expected").alias("_expected"),
            F.col("_step.before").alias("_before"),
        )
    )

    places = starts.join(steps, [_SOURCE, "_class"])
    in_cell = Window.partitionBy(*cell).orderBy("tie")
    ranked = keyed.withColumn("_place", F.row_number().over(in_cell)).join(places, cell)
    rank = F.col("_start") + F.col("_place")
    upto = lambda place: F.floor(F.col("_before") + place * F.col("_expected") + F.col("_offset"))
    crossed = F.greatest(F.lit(0), F.least(F.lit(most), upto(rank) - upto(rank - 1)))
    return ranked.select(*sized.columns, "source_size", "target", crossed.cast("int").alias("copies"))


def sized_documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("tie")
    )


def op3_mixing(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` of every row."""
    return copies(written(sized_documents(docs), "sizes")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, columns unchanged.

    The decision travels on a hash of the whole row. Equal rows may differ in their copies: they share the sum, and one
    of them stands for all of it, which gives the same rows.
    """
    key = F.xxhash64(*[F.col(name) for name in docs.columns])
    second = F.xxhash64(F.lit(SEED), *[F.col(name) for name in docs.columns])
    *row_keys, taken, equal, copy = (
        free_name(name, docs.columns) for name in ("_tie_of_row", "_second_of_row", "_copies", "_equal", "_copy")
    )
    sized = written(
        docs.select("source", word_count(F.col("text")).alias("size"), key.alias("tie"), second.alias("_second")), "sizes"
    )
    decided = (
        copies(sized)
        .groupBy("tie", "_second")
        .agg(F.sum("copies").alias(taken), F.count(F.lit(1)).alias(equal))
        .where(F.col(taken) > 0)
    )
    joined = docs.withColumns(dict(zip(row_keys, (key, second)))).join(
        decided.withColumnsRenamed({"tie": row_keys[0], "_second": row_keys[1]}), row_keys
    )
    single = joined.where(F.col(equal) == 1)
    repeated = joined.where(F.col(equal) > 1).dropDuplicates(row_keys)
    return single.unionByName(repeated).select(
        *docs.columns, F.explode(F.array_repeat(F.lit(0), F.col(taken).cast("int"))).alias(copy)
    ).drop(copy)
