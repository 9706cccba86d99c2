"""Operator 1: mixing sources to target weights by capped water-filling.

Every source gets a share of the budget in proportion to its weight; a source
whose share exceeds ``max_epochs`` times its size is clamped there and the
excess is dealt out again among the others, until no share is above its cap.
With water level L the targets are min(L * weight, cap), so a round only needs
one aggregate over the source table (one row per source) and hands one number,
the next level, to the following round.

A target is then taken as whole repetitions of every document plus one more
repetition of the documents whose seeded hash (of id, length and, among rows
alike in these, source and size, their number) lies below the source's
threshold. The threshold is found exactly by two histograms of the hash (its
first and next 12 bits, combined map-side); of the documents above it the one
whose size fills the rest best comes last, so a source's taken words differ
from its target by less than half a histogram cell: half a document for any
source up to some millions of documents. All of it is DataFrame code; no group, hot
source included, is ever gathered in one task.

Defined cases: null or empty text has size 0 and takes 0 words; a null source
is a source of its own, last in order; a source of size 0 has target 0; every
row is decided by itself, also where ids repeat or are null (of rows alike in
id, source, length and size it is arbitrary which are taken, but not how
many); a very long text is one row, counted where it is read; weights must be
positive; an empty table gives an empty result; other columns are ignored by
``plan_mix`` and carried along by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import WORD, shuffle_partitions, table, whole_text
from churnlens.operators.ordered import null_safe_join
from churnlens.session import materialize

CELL_BITS = 12
CELLS = 1 << CELL_BITS


def ordered_positions(df: DataFrame, col: str, name: str = "position") -> DataFrame:
    """0-based position of each row by ``col`` (code points, null last), without a one-task sort."""
    spark = df.sparkSession
    order = F.col(col).asc_nulls_last()
    ranged = df.repartitionByRange(shuffle_partitions(spark), order).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged.withColumn(
        "_at", F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1), "positions")
    # one row per partition number
    offsets = ranged.groupBy("_part").count().withColumn(
        "_before", F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    return (ranged.join(F.broadcast(offsets.select("_part", "_before")), "_part")
            .withColumn(name, F.col("_at") + F.coalesce("_before", F.lit(0)))
            .drop("_part", "_at", "_before"))


def water_level(sources: DataFrame, budget: float, max_epochs: float) -> float:
    """Level L at which the targets min(L * weight, max_epochs * source_size) sum to the budget.

    ``sources`` has ``source_size`` and ``weight``. Infinite if the caps
    cannot hold the budget.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= cap
        got = sources.agg(
            F.sum(F.when(full, cap)).alias("held"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count_if(full).alias("n")).first()
        if got["open"] is None:
            return float("inf")
        if got["n"] == clamped:
            return level
        clamped = got["n"]
        level = (budget - (got["held"] or 0.0)) / got["open"]


def numbered_repeats(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """0, 1, ... in column ``name`` among the rows alike in ``keys``; ``row`` (an increasing id) tells them apart.

    Rows are numbered within (keys, part of the table) and the parts' counts
    are summed up, so equal rows are never gathered in one task.
    """
    part = F.shiftright("row", 33)
    counts = rows.groupBy(*keys, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    by_key = Window.partitionBy(*keys)
    before = F.sum("_n").over(by_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = materialize(counts.withColumns({"_all": F.sum("_n").over(by_key), "_before": F.coalesce(before, F.lit(0))})
                         .where("_all > 1").drop("_n", "_all"), "mix_repeats")
    if not counts.head(1):
        return rows.withColumn(name, F.lit(0).cast("long"))
    own = rows.withColumn("_part", part)
    place = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy("row")) - 1
    repeats = null_safe_join(own, counts, [*keys, "_part"]).withColumn(name, F.col("_before") + place)
    single = null_safe_join(own, counts.withColumn("_repeats", F.lit(True)), [*keys, "_part"], "left").where("_repeats IS NULL")
    return repeats.select(*rows.columns, name).unionByName(single.select(*rows.columns, F.lit(0).cast("long").alias(name)))


def plan_mix(docs: DataFrame, weight: Column | DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", max_epochs: float = 3.0, budget: float | None = None,
             seed: int = 17, row_col: str | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, repeats, taken`` for every row.

    ``row_col``: a written column that is unique to each row; it comes back as
    ``row``.

    ``weight``: an expression over ``position`` (the source's place in code
    point order, from 0), or a table (source, weight) that covers the sources.
    ``budget``: words to take, by default as many as the input has.
    """
    text = whole_text(text_col)
    rows = materialize(docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.length(text).alias("chars"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size")), "mix_rows")
    h = F.xxhash64("doc_id", "chars", F.lit(seed))
    rows = numbered_repeats(rows, ["doc_id", "source", "chars", "size"], "again").withColumn(
        "h", F.when(F.col("again") > 0, F.xxhash64(h, "again")).otherwise(h))
    rows = materialize(rows.select(
        "row", "doc_id", "source", "size",
        F.shiftrightunsigned("h", 64 - CELL_BITS).cast("int").alias("cell"),
        F.shiftrightunsigned("h", 64 - 2 * CELL_BITS).bitwiseAND(F.lit(CELLS - 1)).cast("int").alias("sub"),
    ), "mix_sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    if isinstance(weight, DataFrame):
        w = weight.select(F.col("source").alias("_source"), F.col("weight").cast("double"))
        sources = sources.join(w, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    else:
        sources = ordered_positions(sources, "source").withColumn("weight", weight.cast("double")).drop("position")
    sources = materialize(sources, "mix_sources")
    if budget is None:
        budget = float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level = water_level(sources, budget, max_epochs)
    target = F.least(F.col("weight") * F.lit(level), F.col("source_size") * F.lit(float(max_epochs)))
    plan = sources.select(
        "source", "source_size",
        F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target).alias("target"))
    plan = plan.withColumn("whole", F.when(F.col("source_size") == 0, F.lit(0)).otherwise(
        F.floor(F.col("target") / F.col("source_size"))).cast("long"))
    plan = materialize(plan.withColumn("more", F.col("target") - F.col("whole") * F.col("source_size")), "mix_plan")

    def on_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        right = right.withColumnRenamed("source", "_source")
        return left.join(right, left["source"].eqNullSafe(right["_source"]), how).drop("_source")

    def crossing(cells: DataFrame, cell: str, start: Column) -> DataFrame:
        """Words below each cell of a source (at most CELLS rows a source)."""
        w = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
        return cells.withColumn("below", start + F.coalesce(F.sum("words").over(w), F.lit(0)))

    first = rows.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    first = on_source(first, plan.select("source", "more"))
    first = (crossing(first, "cell", F.lit(0.0)).filter("below <= more AND more < below + words")
             .select("source", F.col("cell").alias("at_cell"), F.col("below").alias("cell_below"), "more"))
    edge = materialize(first, "mix_edge")
    second = on_source(rows, edge).filter("cell = at_cell").groupBy("source", "sub").agg(
        F.sum("size").alias("words"), F.first("cell_below").alias("cell_below"), F.first("more").alias("more"))
    upto = F.col("below") + F.col("words")
    second = crossing(second, "sub", F.col("cell_below")).groupBy("source").agg(
        F.max(F.when(upto <= F.col("more"), F.col("sub"))).alias("at_sub"),
        F.max(F.when(upto <= F.col("more"), upto).otherwise(F.col("cell_below"))).alias("reached"))
    cut = materialize(on_source(on_source(plan, edge.select("source", "at_cell"), "left"), second, "left")
                      .withColumn("gap", F.col("more") - F.coalesce("reached", F.lit(0.0)))
                      .select("source", "source_size", "target", "whole", "at_cell", "at_sub", "gap"), "mix_cuts")
    below = (F.col("cell") < F.col("at_cell")) | \
        ((F.col("cell") == F.col("at_cell")) & (F.col("sub") <= F.coalesce("at_sub", F.lit(-1))))
    marked = on_source(rows, cut).withColumn("below", F.coalesce(below, F.lit(False)))
    # the last document: of those above the threshold the one whose size fills the gap best, if that is nearer than none
    filler = marked.filter("NOT below AND size > 0 AND size < 2 * gap").groupBy("source").agg(
        F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "cell", "sub", "doc_id", "size", "row")).alias("fill"))
    filler = materialize(filler.select("source", "fill"), "mix_fill")
    fill = F.col("fill")
    extra = F.col("below") | F.coalesce(
        (F.col("cell") == fill["cell"]) & (F.col("sub") == fill["sub"]) & (F.col("size") == fill["size"])
        & F.col("doc_id").eqNullSafe(fill["doc_id"]) & F.col("row").eqNullSafe(fill["row"]), F.lit(False))
    return (on_source(marked, filler, "left")
            .withColumn("repeats", F.col("whole") + extra.cast("long"))
            .select(*(["row"] if row_col else []), "doc_id", "source", "size", "source_size", "target", "repeats",
                    (F.col("size") * F.col("repeats")).alias("taken")))


#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)


def cycling_weights(weights=WEIGHTS) -> Column:
    return F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("position") % len(weights) + 1).cast("int"))


def mix(docs: DataFrame, weight: Column | DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The mixed corpus: the input's rows, each as often as it is taken.

    The rows are written once with a key, and each is taken as the plan says for that key.
    """
    docs = materialize(docs.withColumn("__mix_row", F.monotonically_increasing_id()), "mix_rows")
    plan = plan_mix(docs, weight, id_col=id_col, row_col="__mix_row", **options)
    plan = plan.filter("repeats > 0").select(F.col("row").alias("__mix_row"), F.col("repeats").cast("int").alias("__mix_repeats"))
    return (docs.join(plan, "__mix_row")
            .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_repeats"))))
            .drop("__mix_row", "__mix_repeats", "__mix_copy"))


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    return plan_mix(table(spark, sf_dir, "documents"), cycling_weights()).select(
        "doc_id", "size", "source_size", "target", "taken")
