"""Mixing sources to target weights: repetition rates per source, whole copies plus one hash-drawn copy per document."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import WORD, stored

#: Sources above this number are joined by a shuffle instead of a broadcast (a row of rates is about 100 bytes).
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_rates(sizes: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """``sizes`` (source, source_size; one row a source) with each source's ``target`` and ``rate``.

    Sources weigh ``weights`` in turn, in code-point order with NULL last, and share the sum of all sizes. A target stops
    at ``cap`` times its source's size and the excess is shared again by weight. Sorted by the level at which they fill
    up, the capped sources are a prefix, so running sums find them without iterating. Windows here see one row a source.
    """
    common = math.lcm(*weights)
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long"))
    ceiling = F.col("source_size") * cap
    by_level = Window.orderBy(
        F.expr(f"source_size * {cap} * ({common} div weight)"), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    levels = weighed.select(
        "*", ceiling.alias("ceiling"), F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("all_weight"), (F.sum(ceiling).over(by_level) - ceiling).alias("full_before"),
        (F.sum("weight").over(by_level) - F.col("weight")).alias("weight_before"),
    ).withColumn(
        "is_full", F.expr("(total - full_before) * weight >= ceiling * (all_weight - weight_before)")
    )
    full = F.sum(F.when(F.col("is_full"), F.col("ceiling")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(F.col("is_full"), 0).otherwise(F.col("weight"))).over(everything)
    shared = levels.select("*", full.alias("full"), open_weight.alias("open_weight"))
    target = F.expr("CASE WHEN is_full THEN double(ceiling) ELSE double(weight * (total - full)) / open_weight END")
    rated = shared.select("source", "source_size", target.alias("target"))
    return rated.withColumn("rate", F.expr("CASE WHEN source_size > 0 THEN target / source_size ELSE 0D END"))


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """Number in [0, 1) that depends on the seed and the document alone (on the text where there is no id)."""
    name = F.coalesce(F.concat(F.lit("#"), doc_id.cast("string")), F.concat(F.lit("-"), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(seed), name)), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**52))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: str = "mix:") -> DataFrame:
    """Per row of ``docs`` (as the struct ``doc``): ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    A document is taken floor(rate) times, and once more if its draw falls below the fraction, so the expected words of a
    source are its target and no document is taken more than ``cap`` times. Sizes are summed on the map side, so a source
    with a third of all rows sends one row a task.

    NULL or empty text: size 0, taken 0 words (it still has copies). NULL source: a source of its own, last in order.
    NULL id: drawn by text. Repeated rows: each is taken as often as its equals. All sizes 0: every target is 0. Empty
    table: no rows. Other columns, of whatever names, stay inside ``doc``.
    """
    sized = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc")).withColumn("size", word_count(F.col("doc.text")))
    sizes = docs.select(docs["source"].alias("source"), word_count(docs["text"]).alias("size"))
    rates = stored(
        source_rates(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap), "mix-rates"
    )
    side = F.broadcast(rates) if rates.count() <= BROADCAST_SOURCES else rates
    joined = sized.join(side, F.col("doc.source").eqNullSafe(rates["source"]))
    chance = draw(F.col("doc.doc_id"), F.col("doc.text"), seed)
    whole = F.floor("rate")
    copies = (whole + (chance < F.col("rate") - whole).cast("long")).alias("copies")
    return joined.select("doc", "size", "source_size", "target", "rate", copies).withColumn("taken", F.expr("size * copies"))


def emit_copies(mixed: DataFrame) -> DataFrame:
    """The mixed documents themselves, each as often as it is taken, with the columns they came with."""
    times = F.explode(F.expr("CASE WHEN copies > 0 THEN sequence(1L, copies) END"))
    return mixed.select("doc", times.alias("copy")).select("doc.*")
