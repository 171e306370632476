"""Mixing sources to target weights: weighted fair queueing, in DataFrame operations alone.

Each source is a queue of its documents in a fixed shuffled order, repeated up to `repeats` times. A copy's
virtual finish time is the words its source has sent up to and with it, divided by the source's weight. The
mix is the copies in order of finish time, cut where the total budget (all words of all sources) is reached:
a source that has sent all its repeats falls silent, and the others share what it leaves by weight.

No running sum goes through one task: sums run over (source, shuffle cell) and then inside a cell; there are more cells where the table is
larger. The cut, the place in the sorted mix where the budget ends, is found in two levels of cells of finish time before anything is sorted; `mix` then
range-sorts the copies before the cut, `allotted` counts them. Rows that reach a single task are one per source, or one per
cell of finish time, whose number is fixed.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; a source of size 0
has target 0; an empty table gives no rows; equal rows may stand for each other; a text of any length is counted whole. Columns of the input are kept
as they are, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldus.llm import scratch

WEIGHTS = (5, 2, 1)
REPEATS = 3
#: Rows of a cell of a source's shuffled order, about, where the table has more than so many in 1,024 cells; cells of finish times at each of two levels.
CELL_ROWS = 1 << 16
CELLS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def keyed(docs: DataFrame, size: Column) -> DataFrame:
    """docs with the size and the place in the shuffled order of each row; the text takes part, so rows without an id or with equal ones are spread."""
    return docs.withColumns({"__mix_size": size, "__mix_order": F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("source"), F.col("text"))})


def _celled(rows: DataFrame, bits: int) -> DataFrame:
    """rows with their shuffle cell: a range of the order."""
    return rows.withColumn("__mix_cell", F.shiftrightunsigned("__mix_order", 64 - bits))


@dataclass(frozen=True)
class Schedule:
    """prefix: a row for each (source, shuffle cell), with what was sent before it; cut: the last copy taken; bits: of a shuffle cell."""

    prefix: DataFrame
    cut: tuple | None
    bits: int


def _finish(epoch: Column) -> Column:
    return (epoch * F.col("__mix_source_size") + F.col("__mix_sent")) / F.col("__mix_weight")


def _served(rows: DataFrame, prefix: DataFrame) -> DataFrame:
    """rows with their source's figures and the words sent up to and with each."""
    at = prefix.withColumnsRenamed({"source": "__mix_s", "__mix_cell": "__mix_c"})
    inside = Window.partitionBy("source", "__mix_cell").orderBy("__mix_order", "doc_id", "__mix_size").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(at, F.col("source").eqNullSafe(F.col("__mix_s")) & (F.col("__mix_cell") == F.col("__mix_c")))
    return joined.withColumn("__mix_sent", F.col("__mix_before") + F.sum("__mix_size").over(inside)).drop("__mix_s", "__mix_c", "__mix_before")


def _key(finish: Column) -> Column:
    return F.struct(finish.alias("f"), F.col("__mix_order").alias("o"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.col("__mix_size").alias("s"))


def schedule(slim: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> Schedule:
    """The schedule of the rows of keyed(); slim needs doc_id, source and the two internal columns."""
    bits = max(10, (slim.count() // CELL_ROWS).bit_length())
    slim = _celled(slim, bits)
    sums = slim.groupBy("source", "__mix_cell").agg(F.sum("__mix_size").alias("__mix_sum"))
    sources = sums.groupBy("source").agg(F.sum("__mix_sum").alias("__mix_source_size"))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    ranked = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    sources = sources.withColumn("__mix_weight", F.element_at(cycle, ((ranked - 1) % len(weights) + 1).cast("int")))
    # The level at which shares stop: sources in order of what they can give for their weight; those before the first that needn't stop give all.
    cap = repeats * F.col("__mix_source_size")
    by_ratio = Window.orderBy(cap / F.col("__mix_weight"), "source")
    whole = Window.partitionBy()
    sources = sources.withColumns({"__mix_total": F.sum("__mix_source_size").over(whole).cast("double"), "__mix_given": F.coalesce(F.sum(cap).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "__mix_rest": F.sum("__mix_weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))})
    level = (F.col("__mix_total") - F.col("__mix_given")) / F.col("__mix_rest")
    sources = sources.withColumn("__mix_level", F.coalesce(F.min(F.when(cap / F.col("__mix_weight") >= level, F.struct(F.col("__mix_given"), level.alias("l")))).over(whole)["l"], F.lit(0.0)))
    sources = sources.withColumn("__mix_target", F.least(cap.cast("double"), F.col("__mix_level") * F.col("__mix_weight")))
    sources = sources.drop("__mix_given", "__mix_rest").withColumnRenamed("source", "__mix_of")
    earlier = Window.partitionBy("source").orderBy("__mix_cell").rowsBetween(Window.unboundedPreceding, -1)
    prefix = sums.withColumn("__mix_before", F.coalesce(F.sum("__mix_sum").over(earlier), F.lit(0))).join(sources, F.col("source").eqNullSafe(F.col("__mix_of"))).drop("__mix_of", "__mix_sum")
    prefix = scratch.stored(prefix, "mix-prefix")
    return Schedule(prefix, _cut(_served(slim, prefix), prefix, repeats), bits)


def _cut(served: DataFrame, prefix: DataFrame, repeats: int) -> tuple | None:
    """The key and epoch of the last copy, in order of finish time, with which the total is not exceeded."""
    ends = prefix.agg(F.max(repeats * F.col("__mix_source_size") / F.col("__mix_weight")), F.max("__mix_total")).first()
    if not ends[0]:
        return None
    low, high, room = 0.0, float(ends[0]), float(ends[1])
    copies = served.withColumn("__mix_epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("__mix_finish", _finish(F.col("__mix_epoch"))).where("__mix_size > 0")
    copies = scratch.stored(copies.select("doc_id", "__mix_order", "__mix_size", "__mix_epoch", "__mix_finish"), "mix-copies")
    last = None
    for _ in range(2):
        cell = F.least(F.floor((F.col("__mix_finish") - low) / (high - low) * CELLS), F.lit(CELLS - 1))
        cells = copies.where((F.col("__mix_finish") > low) & (F.col("__mix_finish") <= high)).groupBy(cell.alias("cell")).agg(F.sum("__mix_size").alias("n"), F.max("__mix_finish").alias("high"))
        run = cells.withColumn("upto", F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)))
        found = run.agg(F.max(F.when(F.col("upto") <= room, F.struct("upto", "high"))).alias("under"), F.min(F.when(F.col("upto") > room, F.struct("upto", "high"))).alias("over")).first()
        if found["under"]:
            last, low, room = found["under"]["high"], found["under"]["high"], room - found["under"]["upto"]
        if not found["over"]:
            break
        high = found["over"]["high"]
        if high <= low:
            break
    edge = copies.where((F.col("__mix_finish") > low) & (F.col("__mix_finish") <= high)) if high > low else copies.where("false")
    order = Window.orderBy("__mix_finish", "__mix_order", "doc_id", "__mix_size", "__mix_epoch").rowsBetween(Window.unboundedPreceding, 0)
    fits = edge.withColumn("upto", F.sum("__mix_size").over(order)).where(F.col("upto") <= room)
    key = fits.agg(F.max(F.struct(_key(F.col("__mix_finish")).alias("k"), F.col("__mix_epoch").alias("e"))).alias("m")).first()["m"]
    if key is not None:
        return (*key["k"], key["e"])
    return None if last is None else (last, (1 << 63) - 1, (1 << 63) - 1, (1 << 63) - 1, repeats)


def taken(rows: DataFrame, plan: Schedule, repeats: int = REPEATS) -> DataFrame:
    """rows of keyed() with __mix_taken, how many copies of each the mix takes, and the source's figures."""
    served = _served(_celled(rows, plan.bits), plan.prefix)
    if plan.cut is None:
        return served.withColumn("__mix_taken", F.lit(0))
    f, o, d, s, e = plan.cut
    edge = F.struct(F.struct(F.lit(f).cast("double").alias("f"), F.lit(o).cast("long").alias("o"), F.lit(d).cast("long").alias("d"), F.lit(s).cast("long").alias("s")).alias("k"), F.lit(e).cast("int").alias("e"))
    count = sum((F.when(F.struct(_key(_finish(F.lit(i))).alias("k"), F.lit(i).cast("int").alias("e")) <= edge, 1).otherwise(0) for i in range(repeats)), F.lit(0))
    return served.withColumn("__mix_taken", F.when(F.col("__mix_size") > 0, count).otherwise(0))


def slim(docs: DataFrame) -> DataFrame:
    """doc_id, source and internal columns of docs, stored: words are counted once."""
    return scratch.stored(keyed(docs.select("doc_id", "source", "text"), word_count(F.col("text"))).drop("text"), "mix-slim")


def allotted(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted) of every row of docs."""
    rows = slim(docs)
    out = taken(rows, schedule(rows, weights, repeats), repeats)
    return out.select("doc_id", "source", F.col("__mix_size").alias("size"), F.col("__mix_source_size").cast("long").alias("source_size"), F.col("__mix_target").alias("target"), (F.col("__mix_size") * F.col("__mix_taken")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The mix itself: the rows of docs, each as often as the mix takes it, range-sorted by finish time."""
    columns = docs.columns
    # No column of the input keeps a name that begins as the internal ones do.
    longest = max(map(len, columns))
    docs = docs.withColumnsRenamed({c: "_" * longest + c for c in columns if c.lower().startswith("__mix_")})
    plan = schedule(slim(docs), weights, repeats)
    rows = taken(keyed(docs, word_count(F.col("text"))), plan, repeats).where("__mix_taken > 0")
    copies = rows.withColumn("__mix_epoch", F.explode(F.sequence(F.lit(0), F.col("__mix_taken") - 1)))
    ordered = copies.withColumn("__mix_finish", _finish(F.col("__mix_epoch")))
    return ordered.repartitionByRange("__mix_finish", "__mix_order").sortWithinPartitions("__mix_finish", "__mix_order", "__mix_epoch").select(docs.columns).toDF(*columns)
