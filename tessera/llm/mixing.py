"""Mixing sources to target weights by systematic sampling.

Every source has a target in words. A document of a source is expected
``target / source_size`` times in the mix; the expected copies are summed along the
source (shortest documents first, so that every length gets its share), one offset in
[0, 1) that depends on the seed and the source is added, and the document is emitted once
for each integer boundary that its stretch of the sum crosses. Copies of a document are
therefore the expected copies rounded up or down, and never more than ``cap``.

Defined results: a null text has size 0; a null source is a source of its own, the last;
repeated rows, and rows without an id, are documents of their own; an empty table gives an empty result;
a source without words has target 0 and takes nothing. Extra columns are dropped by ``mix`` and
kept by ``mixed_documents``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import textbatch as tb
from tessera.llm.storage import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one source and size are ordered by doc_id modulo this first, so that neighbours in the table are not neighbours here.
SALTS = 64
CAP = 3.0
#: Share of its source's target above which a document is rounded first.
BIG = 0.01


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 32 bits of the MD5 digest of seed and source."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\0null")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = CAP) -> DataFrame:
    """(source, source_size, target) for a table (source, source_size) with one row for each source.

    Sources take ``weights`` in turn, ordered by code point with null last. All sizes are
    shared by weight; no target is above ``cap`` times its source's size, and what that leaves over is
    shared again among the rest. That is one level for all that are below their cap: sources sorted by
    cap over weight, the first prefix of capped ones after which the level no longer exceeds the next.
    The table is per source, so its windows are over metadata, not over documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "UTF-8"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.select("source", "source_size", w.alias("w")).withColumn("most", F.col("source_size") * F.lit(cap))
    t = t.withColumn("ratio", F.col("most") / F.col("w"))
    everything = Window.partitionBy()
    ranked = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    t = (
        t.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(ranked.rowsBetween(0, Window.unboundedFollowing)))
    )
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    return t.withColumn("level", level).select("source", "source_size", F.coalesce(F.least("most", F.col("w") * F.col("level")), F.col("most")).alias("target"))


def _numbered(sized: DataFrame) -> DataFrame:
    """Adds ``ahead``: how many rows of the row's source come before it, by size, salt, doc_id and tie.

    The rows are range-partitioned by that order and numbered within their partition as they are stored; what partitions hold of each
    source is summed along the partitions. So no window holds more than one number for each partition and source, whatever
    the sizes and sources are; rows that are alike in everything are dealt over partitions by the place they are stored at.
    """
    order = [F.col("source").asc_nulls_last(), "size", F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(SALTS)), "doc_id", "tie", "stand"]
    sized = sized.withColumn("stand", F.monotonically_increasing_id())
    dealt = sized.repartitionByRange(*order).sortWithinPartitions(*order).drop("stand", "tie")
    # the id counts the rows of a partition in its lower 33 bits
    rows = stored(dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")), "mix-order")
    parts = rows.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    along = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("source").alias("p_source"), F.col("part").alias("p_part"), (F.coalesce(F.sum("n").over(along), F.lit(0)) - F.col("first")).alias("p_more"))
    rows = rows.join(parts, rows["source"].eqNullSafe(parts["p_source"]) & (rows["part"] == parts["p_part"]))
    return rows.withColumn("ahead", F.col("at") + F.col("p_more")).drop("p_source", "p_part", "p_more", "part", "at")


def _crossed(ahead: Column, each: Column, seed: int) -> Column:
    """The integer boundaries crossed between ``ahead`` and ``ahead + 1`` expected copies, offset added."""
    u = offset(F.col("source"), seed)
    return (F.floor(u + (ahead + 1) * each) - F.floor(u + ahead * each)).cast("long")


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = CAP, seed: int = 0, row: str | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of (doc_id, text, source).

    Documents above ``BIG`` of their source's target are rounded first, as rounding one of them weighs most; what they take
    of the target is counted, and the others' expected copies share what is left. ``row`` names a column of docs that is kept.
    """
    own = [F.col(row).alias("row")] if row else []
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"), *own)
    # counting the words is the costly part; the splitters of the order would have it done twice
    sized = stored(sized, "mix")
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap).withColumnRenamed("source", "t_source")
    rows = _numbered(sized)
    rows = rows.join(goal, rows["source"].eqNullSafe(goal["t_source"])).drop("t_source")
    # the documents of a source that are rounded first are the last ones of its order
    rows = rows.withColumn("big", F.col("size") > F.lit(BIG) * F.col("target"))
    small = rows.groupBy(F.col("source").alias("s_source")).agg(F.count(F.when(~F.col("big"), 1)).alias("s_small"))
    rows = rows.join(small, rows["source"].eqNullSafe(small["s_source"])).drop("s_source")
    even = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(cap))).otherwise(F.lit(0.0))
    rows = rows.withColumn("first", F.when(F.col("big"), _crossed(F.col("ahead") - F.col("s_small"), even, seed)))
    done = rows.where("big").groupBy(F.col("source").alias("d_source")).agg(F.sum(F.col("first") * F.col("size")).alias("d_taken"), F.sum("size").alias("d_size"))
    rows = rows.join(done, rows["source"].eqNullSafe(done["d_source"]), "left")
    rest = F.col("source_size") - F.coalesce(F.col("d_size"), F.lit(0))
    left = F.col("target") - F.coalesce(F.col("d_taken"), F.lit(0))
    share = F.when(rest > 0, F.least(F.greatest(left / rest, F.lit(0.0)), F.lit(cap))).otherwise(F.lit(0.0))
    rows = rows.withColumn("copies", F.coalesce("first", _crossed(F.col("ahead"), share, seed)))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["row"] if row else []))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = CAP, seed: int = 0, name: str = "copy") -> DataFrame:
    """The mix itself: every document once for each copy, with its columns and the number of the copy from 0.

    The number's column is ``name``, with an underscore added for as long as docs has such a column. Rows are stored with a number of
    their own, so those without an id or that repeat each have their own copies.
    """
    row, copies, number = (tb.fresh(docs, x) for x in ("mix_row", "mix_copies", name))
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    plan = mix(kept, weights, cap, seed, row).where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copies))
    out = kept.join(plan, row).withColumn(number, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1)))
    return out.drop(row, copies)
