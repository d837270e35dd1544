"""Interleave sources by target weights with a Pfair schedule.

Every source's documents are laid end to end and cut into blocks of equal size. Slots of a common clock take one block
each. Block i of a source with weight w is released at slot floor(i/w) and due by slot ceil((i+1)/w); of the released
blocks the one that is due first goes next. No source is then ever a whole block ahead of or behind its weight. All
blocks of the run are scheduled once by the exact weights. The driver holds one number per block, and blocks grow with
the table, so that there are never more than a few million.
"""

from __future__ import annotations

import heapq
import math
from array import array
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from admitflow.llm.common import stored

# Characters of a block, and blocks of a run: larger tables have larger blocks, and the deviation stays below one.
BLOCK_CHARS = 1 << 16
MOST_BLOCKS = 1 << 22
# A source without a sound weight gets one slot in so many for each source.
SLOTS_PER_SOURCE = 32
# Documents of a source that are laid end to end within one task.
RUN_ROWS = 4096
# Weights are whole parts of this, so that windows are exact whole numbers.
PARTS = 1 << 40
# The driver holds a row for each source; more than this are refused.
MAX_SOURCES = 1 << 20
# Sources take part by this power of their size: large ones count for less than their share.
SMOOTHING = 0.7


def default_weights(sizes: DataFrame, power: float = SMOOTHING) -> DataFrame:
    """(source, weight) from (source, chars)."""
    return sizes.select("source", F.pow(F.greatest("chars", F.lit(1)).cast("double"), power).alias("weight"))


def parts_of(weights: list[float | None]) -> list[int]:
    """Parts of PARTS in proportion to the weights, by largest remainder; they add up to it, and none is 0.

    What is null, not positive or not finite gets one part in SLOTS_PER_SOURCE for each source, the others the rest.
    """
    sound = [w is not None and 0 < w < float("inf") for w in weights]
    if not any(sound):
        weights, sound = [1.0] * len(weights), [True] * len(weights)
    least = PARTS // (SLOTS_PER_SOURCE * len(weights))
    spare = PARTS - least * sound.count(False)
    total = sum(Fraction(w) for w, s in zip(weights, sound) if s)
    exact = [Fraction(w) * spare / total if s else Fraction(least) for w, s in zip(weights, sound)]
    parts = [max(int(x), 1) for x in exact]
    left = PARTS - sum(parts)
    order = sorted(range(len(parts)), key=lambda i: (parts[i] - exact[i], i))
    for i in order[: max(left, 0)]:
        parts[i] += 1
    parts[max(range(len(parts)), key=parts.__getitem__)] += min(left, 0)  # what the least parts took
    return parts


def whole_run(blocks: list[int], parts: list[int]) -> list[array]:
    """The slots of each source's blocks: earliest deadline first within the windows of the exact weights.

    Slots that nothing is released for stay empty and take no time, so the work follows the number of blocks.
    """
    slots = [array("q") for _ in blocks]
    pending = [(0, i) for i, n in enumerate(blocks) if n]  # by release
    released: list[tuple[int, int]] = []  # by deadline
    clock = 0
    while pending or released:
        if not released:
            clock = max(clock, pending[0][0])
        while pending and pending[0][0] <= clock:
            _, i = heapq.heappop(pending)
            heapq.heappush(released, (-(-(len(slots[i]) + 1) * PARTS // parts[i]), i))
        _, i = heapq.heappop(released)
        slots[i].append(clock)
        if len(slots[i]) < blocks[i]:
            heapq.heappush(pending, (len(slots[i]) * PARTS // parts[i], i))
        clock += 1
    return slots


def _plan(wanted: DataFrame, sizes: DataFrame, block_chars: int) -> DataFrame:
    """(s, b, slot) of every block of every source."""
    whole = sizes.select(F.col("source").alias("s"), F.floor((F.col("chars") - 1) / block_chars).alias("last"))
    rows = wanted.join(whole, F.col("source").eqNullSafe(F.col("s"))).select("s", "weight", "last").collect()
    rows.sort(key=lambda r: (r.s is not None, r.s or ""))
    slots = whole_run([r.last + 1 for r in rows], parts_of([r.weight for r in rows])) if rows else []
    kinds = pa.schema([("s", pa.string()), ("b", pa.int64()), ("slot", pa.int64())])
    tables = [
        pa.Table.from_arrays([pa.repeat(pa.scalar(r.s, pa.string()), len(x)), pa.array(range(len(x)), pa.int64()), pa.array(x, pa.int64())], schema=kinds)
        for r, x in zip(rows, slots)
    ]
    return wanted.sparkSession.createDataFrame(pa.concat_tables(tables) if tables else kinds.empty_table())


def _laid_out(docs: DataFrame, sizes: DataFrame, run_rows: int) -> DataFrame:
    """(source, chars, start, tie, at) per document: where it starts when its source is laid end to end.

    A source's documents are dealt by a hash into runs of about ``run_rows``; a run is summed within one task, and runs
    follow each other by the sums of those before. So no task holds a whole source.
    """
    runs = sizes.select(F.col("source").alias("s"), F.ceil(F.col("rows") / run_rows).cast("long").alias("runs"))
    dealt = docs.join(F.broadcast(runs), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    dealt = dealt.withColumn("run", F.pmod("tie", F.col("runs")))
    totals = dealt.groupBy("source", "run").agg(F.sum("chars").alias("sum"))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("source").alias("s"), F.col("run").alias("r"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("source", "run").orderBy("tie", F.col("doc_id").asc_nulls_last(), "at")
    earlier = F.coalesce(F.sum("chars").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("run") == F.col("r"))
    return (
        dealt.withColumn("earlier", earlier)
        .join(offsets, same)
        .withColumn("start", F.col("offset") + F.col("earlier"))
        .drop("s", "r", "offset", "earlier", "runs", "run")
    )


def mix(
    docs: DataFrame, weights: DataFrame | None = None, block_chars: int = BLOCK_CHARS, run_rows: int = RUN_ROWS
) -> DataFrame:
    """(doc_id, source, chars, block, slot, start) of every row; sorting by slot, start and doc_id mixes the sources.

    ``weights`` has (source, weight); without it weights follow the sources' sizes, smoothed. Every row is scheduled
    once: a source that has run out leaves its slots empty, so those left keep their proportions. A document belongs to
    the block in which it starts; a long one spans several, and the slots of those it fills whole stay its own. Null and
    empty texts count as one character. A null source is a source; one without a weight gets the smallest part. Repeated
    rows are scheduled one after the other; an empty table gives none. Other columns are not read. ``block_chars`` is the
    least size of a block. More than MAX_SOURCES sources are refused.
    """
    length = F.greatest(F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0)), F.lit(1)).cast("long")
    tie = F.xxhash64(F.col("doc_id").cast("string"), F.lit(17))
    # Rows that agree in id and length are told apart by their text alone.
    rows = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        length.alias("chars"),
        tie.alias("tie"),
        F.xxhash64("text").alias("at"),
    )
    counted = rows.groupBy("source").agg(F.sum("chars").alias("chars"), F.count("*").alias("rows"))
    sizes = stored(counted, "source-sizes")
    whole = sizes.agg(F.count("*").alias("sources"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars")).first()
    if whole.sources > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    block_chars = max(block_chars, math.ceil(whole.chars / MOST_BLOCKS))
    if weights is None:
        wanted = default_weights(sizes)
    else:
        given = weights.groupBy(F.col("source").cast("string").alias("s")).agg(F.max("weight").alias("weight"))
        wanted = sizes.join(given, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "weight")
    plan = _plan(wanted, sizes, block_chars)
    laid = _laid_out(rows, sizes, run_rows).withColumn("block", F.floor(F.col("start") / block_chars).cast("long"))
    placed = laid.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    return placed.select("doc_id", "source", "chars", "block", "slot", "start", "at")


def interleave(docs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """``docs`` in the order of the schedule: partitions, and the files written from them, are runs of slots.

    Every row stays, and so do its columns. Repeated rows come one after the other.
    """
    mixed = mix(docs, weights).groupBy("doc_id", "at").agg(F.min(F.struct("slot", "start")).alias("__place"))
    mixed = mixed.select(F.col("doc_id").alias("__id"), F.col("at").alias("__at"), "__place")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__at"))
    placed = docs.join(mixed, same)
    order = [F.col("__place.slot"), F.col("__place.start")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*docs.columns)
