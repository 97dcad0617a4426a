"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a random but fixed order, once per pass. A document's virtual finish
time is the number of words of its source up to its end, divided by the source's weight. All sources
are served in the order of finish times until the budget is spent, so a source that has nothing left
gives its share to the others in proportion to their weights.

No source is walked by one task: words are summed per bucket of a source's order and per part of as
many buckets as a bucket has rows, and the buckets' starts come from those sums. The order over all
sources is a range sort of narrow rows; its cut is found from the sums of the ranges and in one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import KEY, WORD, clear_text, row_key, same_row, shuffle_tasks

WEIGHTS = (5.0, 2.0, 1.0)
BUCKET_ROWS = 4_096
_TAKE = "__segqa_take"
_BEFORE = (Window.unboundedPreceding, -1)


def source_targets(
    sized: DataFrame, weights: tuple[float, ...], share: float, passes: int
) -> DataFrame:
    """A row per source: ``source, rank, weight, source_size, n_rows, target``.

    Sources stand in code point order, null last, and take ``weights`` in turn. Targets share
    ``share`` times all words by weight, none above ``passes`` times its source; what is above is
    shared again. Windows without a key run over one row per source.
    """
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")
    )
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*map(F.lit, weights))
    ranked = sources.withColumn("rank", rank).withColumn(
        "weight", F.get(cycle, (F.col("rank") - 1) % len(weights))
    )
    cap = (F.col("source_size") * passes).cast("double")
    everything = Window.partitionBy()
    filled = ranked.withColumn("_level", cap / F.col("weight"))
    before = Window.orderBy("_level", "rank").rowsBetween(*_BEFORE)
    total = F.sum("source_size").over(everything) * share
    rest = total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    rate = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # sources fill up in the order of _level; the first that stays below its cap gives the level
    filled = filled.withColumn("_reached", rest / rate)
    level = F.max(F.when(F.col("_reached") <= F.col("_level"), F.col("_reached"))).over(everything)
    target = F.coalesce(F.least(cap, level * F.col("weight")), cap)
    return filled.withColumn("target", target).drop("_level", "_reached")


def mixing_plan(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    passes: int = 2,
    seed: int = 0,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` for every row.

    ``size`` counts the words of the text (null: 0), ``copies`` is how often the mix takes the row
    and ``taken`` the words that makes. Rows without words are taken as often as their neighbours in
    the order. Repeated rows are separate rows of equal size. The order depends on ids, texts and
    ``seed`` alone, so reruns agree. An empty table gives no rows.
    """
    text = clear_text()
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    sized = materialize(
        docs.select(
            *(c.alias(n) for n, c in row_key("doc_id", text).items()),
            F.col("source"),
            size.alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", text).alias("_order"),
        ),
        "mixing-sizes",
    )
    spark = sized.sparkSession
    targets = materialize(source_targets(sized, weights, share, passes), "mixing-sources")
    served = sized.join(
        targets.withColumnRenamed("source", "_source"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")

    # where each row ends in its source's order: the sums of the buckets before, then its own bucket
    buckets = F.ceil(F.col("n_rows") / bucket_rows)
    place = (F.col("_order") / F.lit(2.0**64) + 0.5) * buckets
    served = served.withColumn("_bucket", F.floor(place))
    sums = materialize(
        served.groupBy("rank", "_bucket")
        .agg(F.sum("size").alias("_words"))
        .withColumn("_part", F.floor(F.col("_bucket") / bucket_rows)),
        "mixing-buckets",
    )
    # in two levels, so that no task sorts all buckets of a source
    parts = _running_start(
        sums.groupBy("rank", "_part").agg(F.sum("_words").alias("_words")), ["rank"], "_part"
    ).select("rank", "_part", F.col("_start").alias("_part_start"))
    starts = (
        _running_start(sums, ["rank", "_part"], "_bucket")
        .join(parts, ["rank", "_part"])
        .select("rank", "_bucket", (F.col("_part_start") + F.col("_start")).alias("_start"))
    )
    own = (
        Window.partitionBy("rank", "_bucket")
        .orderBy("_order", *KEY)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = materialize(
        served.withColumn("_in_bucket", F.sum("size").over(own))
        .join(starts, ["rank", "_bucket"])
        .withColumn("_end", F.col("_start") + F.col("_in_bucket"))
        .drop("_start", "_in_bucket", "_bucket", "_order"),
        "mixing-order",
    )

    # all passes of all rows in the order of finish times, and the last one within the budget
    def finish(turn: Column) -> Column:
        words = F.col("source_size") * turn + F.col("_end")
        return F.struct((words / F.col("weight")).alias("time"), F.col("rank"), words.alias("words"))

    turns = placed.select(
        F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("_turn"),
        "source_size", "_end", "weight", "rank", "size",
    ).select(finish(F.col("_turn")).alias("at"), "size")
    ordered = materialize(
        turns.repartitionByRange(shuffle_tasks(spark), "at")
        .sortWithinPartitions("at")
        .withColumn("_range", F.spark_partition_id()),
        "mixing-finish",
    )
    budget = targets.agg(F.sum("source_size") * share).first()[0] or 0.0
    cut = _last_within(ordered, budget)
    copies = F.lit(0)
    if cut is not None:
        end = F.struct(*(F.lit(cut[name]).alias(name) for name in ("time", "rank", "words")))
        for turn in range(passes):
            copies += F.when(finish(F.lit(turn)) <= end, 1).otherwise(0)
    return placed.withColumn("copies", copies).select(
        F.col(KEY[0]).alias("doc_id"), *KEY, "source", "size", "source_size", "target",
        "copies", (F.col("size") * F.col("copies")).alias("taken"),
    )


def _running_start(sums: DataFrame, within: list[str], order: str) -> DataFrame:
    """``sums`` with ``_start``, the ``_words`` of the rows before in ``order``."""
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(*_BEFORE)
    return sums.withColumn("_start", F.coalesce(F.sum("_words").over(before), F.lit(0)))


def _last_within(ordered: DataFrame, budget: float) -> Row | None:
    """``at`` of the last row of ``ordered`` (``_range, at, size``) that the budget still covers.

    The sums of the ranges tell in which range the budget ends; only that one is summed row by row.
    """
    sums = ordered.groupBy("_range").agg(F.sum("size").alias("_words"))
    upto = F.sum("_words").over(Window.orderBy("_range"))  # a row per range
    reached = sums.withColumn("_before", upto - F.col("_words")).filter(F.col("_before") <= budget)
    last = reached.agg(F.max_by(F.struct("_range", "_before"), "_range")).first()[0]
    if last is None:
        return None
    running = F.sum("size").over(Window.partitionBy("_range").orderBy("at")) + last["_before"]
    inside = ordered.filter(F.col("_range") == last["_range"]).withColumn("_running", running)
    cut = inside.filter(F.col("_running") <= budget).agg(F.max("at")).first()[0]
    if cut is None:  # the budget ends with the range before
        cut = ordered.filter(F.col("_range") < last["_range"]).agg(F.max("at")).first()[0]
    return cut


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its ``copies``, others left out.

    Rows that repeat an id and a text share their copies evenly; a remainder goes to some of them.
    """
    plan = mixing_plan(docs, **options)
    plan = plan.groupBy(*KEY, "source").agg(
        F.sum("copies").cast("int").alias("_copies"), F.count(F.lit(1)).cast("int").alias("_rows")
    )
    keyed = docs.withColumns(row_key("doc_id", clear_text()))
    each, rest = F.floor(F.col("_copies") / F.col("_rows")), F.col("_copies") % F.col("_rows")

    def taken(plan: DataFrame, number: Column | None) -> DataFrame:
        found = keyed.join(
            plan, same_row(keyed, plan) & keyed["source"].eqNullSafe(plan["source"])
        )
        own = [*(keyed[c] for c in docs.columns), *(keyed[c] for c in KEY), "_copies", "_rows"]
        # the caller's columns keep their places, whatever they are called
        found = found.select(*(c.alias(f"_c{k}") if k < len(docs.columns) else c for k, c in enumerate(own)))
        times = each if number is None else each + (number <= rest).cast("int")
        found = found.withColumn(_TAKE, times.cast("int")).filter(F.col(_TAKE) > 0)
        copies = F.explode(F.array_repeat(F.lit(1), F.col(_TAKE)))
        names = [F.col(f"_c{k}").alias(name) for k, name in enumerate(docs.columns)]
        return found.select(*names, copies.alias(_TAKE)).drop(_TAKE)

    mixed = taken(plan.filter(rest == 0), None)
    # where the mix ends among equal rows: at most once in each source
    uneven = materialize(plan.filter(rest > 0), "mixing-uneven")
    if not uneven.isEmpty():
        number = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(1)))
        mixed = mixed.unionByName(taken(uneven, number))
    return mixed
