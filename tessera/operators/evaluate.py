"""Labels, recall, macro F0.5 and the threshold sweep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.textnorm import fold_of

THRESHOLDS = tuple(0.05 + 0.025 * i for i in range(37))
HOLDOUT_FOLDS = 20


def ground_truth(listed: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """(s1, tgt) row ids of listed id pairs; ids of neither side are dropped, pairs are distinct."""
    a = s1.select(F.col("rid").alias("s1"), F.col("entity_id").alias("s1_id"))
    b = targets.select(F.col("rid").alias("tgt"), F.col("entity_id").alias("tgt_id"))
    return listed.join(a, "s1_id").join(b, "tgt_id").select("s1", "tgt").distinct()


def labelled(pairs: DataFrame, gt: DataFrame) -> DataFrame:
    """Pairs with y: 1 where the pair is true."""
    return pairs.join(gt.select("s1", "tgt").withColumn("hit", F.lit(1)), ["s1", "tgt"], "left").withColumn("y", F.coalesce("hit", F.lit(0))).drop("hit")


def missed(pairs: DataFrame, gt: DataFrame) -> DataFrame:
    return gt.join(pairs, ["s1", "tgt"], "left_anti")


def recall(pairs: DataFrame, gt: DataFrame) -> DataFrame:
    """(recall): share of true pairs among the candidates; 1 if there are none."""
    hit = gt.join(pairs.select("s1", "tgt").distinct().withColumn("hit", F.lit(1)), ["s1", "tgt"], "left")
    return hit.agg(F.coalesce(F.avg(F.coalesce("hit", F.lit(0)).cast("double")), F.lit(1.0)).alias("recall"))


def subsample(pairs: DataFrame, stride: int = 3, exact: bool = True) -> DataFrame:
    """All true pairs and every ``stride``-th row.

    ``exact`` takes them by position, which puts all pairs in one order and so in one task: it is for comparing results on small
    tables. By hash, as the whole resolution does, no order is needed.
    """
    if exact:
        at = F.row_number().over(Window.orderBy("s1", "tgt")) - 1
        return pairs.withColumn("at", at).where((F.col("y") == 1) | (F.pmod(F.col("at"), F.lit(stride)) == 0)).drop("at")
    return pairs.where((F.col("y") == 1) | (F.pmod(F.xxhash64("s1", "tgt"), F.lit(stride)) == 0))


def holdout(pairs: DataFrame, folds: int = HOLDOUT_FOLDS) -> DataFrame:
    """Adds fold, and weight 0 for rows whose query entity is held out."""
    df = pairs.withColumn("fold", fold_of(F.col("s1"), folds))
    return df.withColumn("weight", F.when(F.col("fold") == 0, 0.0).otherwise(1.0))


def entity_counts(scored: DataFrame, gt: DataFrame, s1: DataFrame, threshold: float) -> DataFrame:
    """(s1, tp, fp, truth) of every query entity, zeros included; scored has prob and y."""
    pred = scored.where(F.col("prob") >= threshold).groupBy("s1").agg(F.sum("y").alias("tp"), F.sum(1 - F.col("y")).alias("fp"))
    true = gt.groupBy("s1").agg(F.count(F.lit(1)).alias("truth"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return s1.select(F.col("rid").alias("s1")).join(pred, "s1", "left").join(true, "s1", "left").select("s1", zero("tp"), zero("fp"), zero("truth"))


def f05(tp: Column, fp: Column, truth: Column) -> Column:
    """F0.5 of one entity: 1 where nothing is predicted and nothing is true."""
    fn = F.greatest(truth - tp, F.lit(0))
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    f = F.when(0.25 * p + r > 0, 1.25 * p * r / (0.25 * p + r)).otherwise(0.0)
    return F.when((tp + fp == 0) & (truth == 0), 1.0).otherwise(f)


def macro_f05(counts: DataFrame) -> DataFrame:
    return counts.agg(F.avg(f05(F.col("tp"), F.col("fp"), F.col("truth"))).alias("score"))


def threshold_curve(scored: DataFrame, gt: DataFrame, s1: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """(t, score) for each threshold.

    Each pair is counted once, at the highest threshold that it passes; sums from the top per entity give the counts at every
    threshold where they change. Entities are compared with the thresholds only where they have predictions.
    """
    steps = F.lit(list(thresholds))
    last = F.size(F.filter(steps, lambda t: t <= F.col("prob")))
    per = scored.select("s1", "y", last.alias("k")).where("k > 0").groupBy("s1", "k").agg(F.sum("y").alias("tp"), F.sum(1 - F.col("y")).alias("fp"))
    down = Window.partitionBy("s1").orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    lower = Window.partitionBy("s1").orderBy(F.desc("k"))
    per = per.select("s1", "k", F.sum("tp").over(down).alias("tp"), F.sum("fp").over(down).alias("fp"), F.coalesce(F.lead("k").over(lower), F.lit(0)).alias("below"))
    true = gt.groupBy("s1").agg(F.count(F.lit(1)).alias("truth"))
    base = s1.select(F.col("rid").alias("s1")).join(true, "s1", "left").withColumn("truth", F.coalesce("truth", F.lit(0)))
    empty = f05(F.lit(0), F.lit(0), F.col("truth"))
    total = base.agg(F.count(F.lit(1)).alias("n"), F.sum(empty).alias("idle"))
    gain = per.join(base, "s1").select(F.explode(F.sequence(F.col("below") + 1, F.col("k"))).alias("k"), (f05(F.col("tp"), F.col("fp"), F.col("truth")) - empty).alias("gain"))
    gain = gain.groupBy("k").agg(F.sum("gain").alias("gain"))
    grid = s1.sparkSession.range(1).select(F.posexplode(steps).alias("i", "t")).withColumn("k", F.col("i") + 1)
    return grid.join(gain, "k", "left").crossJoin(F.broadcast(total)).select("t", ((F.col("idle") + F.coalesce("gain", F.lit(0.0))) / F.col("n")).alias("score"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """(t, score): the lowest threshold of the best score; (0.5, -1) for an empty curve."""
    best = curve.agg(F.min(F.struct((-F.col("score")).alias("neg"), "t")).alias("b"))
    return best.select(F.coalesce("b.t", F.lit(0.5)).alias("t"), F.coalesce(-F.col("b.neg"), F.lit(-1.0)).alias("score"))


def top_thresholds(curve: DataFrame, n: int = 5) -> DataFrame:
    return curve.orderBy(F.desc("score"), "t").limit(n)


def pseudo_probability(w: Column) -> Column:
    """The squash of a blocking weight, for use where there is no model."""
    return w / (w + 8)


def recall_at(scored: DataFrame, gt: DataFrame, ms: tuple[int, ...] = (5, 10, 20, 40, 80)) -> DataFrame:
    """(m, recall): share of true pairs among the m best scored of their entity."""
    rank = F.row_number().over(Window.partitionBy("s1").orderBy(F.desc("w"), "tgt"))
    hit = gt.join(scored.select("s1", "tgt", rank.alias("rn")), ["s1", "tgt"], "left")
    cols = [F.coalesce(F.avg(F.when(F.col("rn") <= m, 1.0).otherwise(0.0)), F.lit(1.0)).alias(str(m)) for m in ms]
    return hit.agg(*cols).select(F.inline(F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.col(str(m)).alias("recall")) for m in ms])))
