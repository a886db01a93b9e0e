"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

A document's size is its number of words. Sources are ranked by code point (null last) and
weigh ``weights`` in turn. Together the targets share all sizes by weight; a target stops at
``cap`` times its source's size and the excess goes to the others by weight until none is
above. A source's documents are all taken as often as the target goes into the source's size,
and those first in a seeded order once more, so that the words taken miss the target by at
most half the size of one document (of one id).

Defined cases: null texts have size 0; a null source is a source; rows with the same doc_id
are decided alike, repeated rows all count; a source of size 0 gets target 0 and is taken
zero times; an empty table gives an empty result. Other columns are kept by ``repeated`` and
ignored by ``plan``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetwane.llm.text import n_words, unused, whole
from fleetwane.session import local_table, store

#: The weights that the sources take in turn, and how often a source is used at most.
WEIGHTS = (5, 2, 1)
CAP = 3

#: Hexadecimal digits of the seeded key by which a source is cut into slices.
SLICE_DIGITS = 3


def seeded_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def ranked(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows from 0 in ``order`` without bringing them into one task."""
    parts = store(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    before, offsets = 0, []
    for part, count in sorted(tuple(x) for x in parts.groupBy("_part").count().collect()):
        offsets.append((part, before))
        before += count
    starts = local_table(df.sparkSession, offsets, "_part int, _before bigint")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return parts.join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + inside).drop("_part", "_before")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Capped sources are those with few words for their weight, so that one number, the share
    per weight, tells them; it rises from round to round until no further source is capped.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    table = ranked(totals, [F.col("source").isNull(), F.col("source")], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    big = lambda c: c.cast("decimal(38,0)")
    table = store(table.select("source", "source_size", weight.alias("weight")), "sources")
    share, free, seen = F.lit(0), F.lit(1), -1
    while True:
        capped = cap * big(F.col("source_size")) * free < big(F.col("weight")) * share
        row = table.agg(
            F.count(F.when(capped, 1)),
            F.sum("source_size") - cap * F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)),
            F.sum(F.when(~capped, F.col("weight"))),
        ).first()
        if row[0] == seen or row[2] is None:
            break
        seen, share, free = row[0], big(F.lit(row[1])), big(F.lit(row[2]))
    # a decimal, as above: a total below 2**31 is an int literal, its product with a weight need not fit one
    part = (big(F.col("weight")) * F.lit(row[1] or 0)).cast("double") / F.lit(float(row[2] or 1))
    target = F.when(capped, (cap * F.col("source_size")).cast("double")).otherwise(part)
    return table.select("source", "source_size", target.alias("target"))


def plan(docs: DataFrame, seed: int = 0, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per source: source_size, target, how often each document is taken, and the key up to which once more."""
    keyed = store(docs.select("source", n_words(whole("text")).alias("size"), seeded_key(F.col("doc_id"), seed).alias("key")), "sizes")
    sources = targets(keyed, weights, cap)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    sources = store(sources.withColumn("times", times.cast("long")).withColumn("rest", F.col("target") - F.col("times") * F.col("source_size")), "targets")

    # the slice of the key space in which the rest is used up, then the key within that slice
    slices = keyed.groupBy("source", F.substring("key", 1, SLICE_DIGITS).alias("slice")).agg(F.sum("size").alias("held"))
    upto = F.sum("held").over(Window.partitionBy("source").orderBy("slice"))
    slices = slices.withColumn("before", upto - F.col("held"))
    slices = slices.join(sources.select("source", "rest").withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    edge = slices.filter((F.col("rest") > 0) & (F.col("before") < F.col("rest")))
    edge = edge.groupBy("source").agg(F.max_by(F.struct("slice", "before", "rest"), "slice").alias("e")).select(F.col("source").alias("s"), "e.*")
    near = keyed.join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.substring("key", 1, SLICE_DIGITS) == F.col("slice")))
    by_key = near.groupBy("source", "key").agg(F.sum("size").alias("held"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    reach = F.col("before") + F.sum("held").over(Window.partitionBy("source").orderBy("key"))
    inside = by_key.withColumn("reach", reach).filter(2 * F.col("reach") - F.col("held") <= 2 * F.col("rest"))
    last = inside.groupBy("source").agg(F.max("key").alias("last"))
    found = edge.select("s", "slice").join(last.withColumnRenamed("source", "t"), F.col("s").eqNullSafe(F.col("t")), "left")
    found = found.select("s", F.coalesce("last", "slice").alias("last"))  # no key of the slice: all keys below it
    return store(
        sources.join(found, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "times", F.coalesce("last", F.lit("")).alias("last")),
        "mix",
    )


def _decided(docs: DataFrame, decisions: DataFrame, seed: int) -> tuple[DataFrame, dict[str, str]]:
    """docs with its source's figures and ``copies`` to take, and the names these columns have; nothing but the sources is joined."""
    names = {c: unused(docs, f"mix_{c}") for c in [*decisions.columns, "copies", "copy"]}
    own = decisions.select(*(F.col(c).alias(names[c]) for c in decisions.columns))
    both = docs.join(own, F.col("source").eqNullSafe(F.col(names["source"])))
    once_more = (seeded_key(F.col("doc_id"), seed) <= F.col(names["last"])).cast("long")
    return both.withColumn(names["copies"], F.col(names["times"]) + once_more), names


def mix(docs: DataFrame, seed: int = 0, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    sized = docs.select("doc_id", "source", n_words(whole("text")).alias("size"))
    both, name = _decided(sized, plan(docs, seed, weights, cap), seed)
    taken = (F.col("size") * F.col(name["copies"])).alias("taken")
    return both.select("doc_id", "size", F.col(name["source_size"]).alias("source_size"), F.col(name["target"]).alias("target"), taken)


def repeated(docs: DataFrame, seed: int = 0, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mixed corpus: each document as many times as it is taken, with the columns of ``docs``."""
    both, name = _decided(docs, plan(docs, seed, weights, cap), seed)
    times = F.col(name["copies"])
    copies = both.filter(times > 0).withColumn(name["copy"], F.explode(F.sequence(F.lit(1), times.cast("int"))))
    return copies.select(*(f"`{c}`" for c in docs.columns))
