"""Statistics for choosing blocking budgets and looking at the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import textnorm as N
from tessera.operators import blocking as B
from tessera.operators import evaluate as E
from tessera.operators.keys import tokens
from tessera.schema import EXACT_TYPES

BUDGETS = (10_000, 30_000, 100_000, 300_000, 1_000_000, 3_000_000)
EDGES = (0.0, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0)
# Caps of the token keys, and edges between the votes of the key types.
SOLO_CAPS = (50, 150, 300)
MISSED_EDGES = (0.5, 1.2, 1.75, 2.25, 3.0, 5.0, 8.5, 11.0)


def key_products(q_postings: DataFrame, t_postings: DataFrame) -> DataFrame:
    """(key_type, key, dfq, dft, product) of the keys on both sides."""
    q = B.key_df(q_postings).withColumnRenamed("df", "dfq")
    t = B.key_df(t_postings).withColumnRenamed("df", "dft")
    return q.join(t, B.KEY).withColumn("product", F.col("dfq") * F.col("dft"))


def least_products(pairs: DataFrame, q_postings: DataFrame, t_postings: DataFrame) -> DataFrame:
    """(s1, tgt, least): least product of document frequencies over the keys that a pair shares; null without one."""
    q = q_postings.select(F.col("rid").alias("s1"), *B.KEY).distinct()
    t = t_postings.select(F.col("rid").alias("tgt"), *B.KEY).distinct()
    shared = pairs.select("s1", "tgt").join(q, "s1").join(t, ["tgt", *B.KEY]).join(key_products(q_postings, t_postings), B.KEY)
    return pairs.select("s1", "tgt").join(shared.groupBy("s1", "tgt").agg(F.min("product").alias("least")), ["s1", "tgt"], "left")


def budget_coverage(least: DataFrame, budgets: tuple[int, ...] = BUDGETS) -> DataFrame:
    """(budget, covered): share of the pairs with a key within the budget."""
    cols = [F.coalesce(F.avg(F.when(F.col("least") <= b, 1.0).otherwise(0.0)), F.lit(0.0)).alias(str(b)) for b in budgets]
    return least.agg(*cols).select(F.inline(F.array(*[F.struct(F.lit(b).cast("long").alias("budget"), F.col(str(b)).alias("covered")) for b in budgets])))


#: Rows of each side that meet in one task.
COVERAGE_ROWS = 1024


def _least_within(budgets: tuple[int, ...]):
    """(pairs, pairs whose least product is within each budget) of each task; rows come sorted by task."""
    import numpy as np
    import pyarrow as pa

    def one(t: pa.Table) -> pa.RecordBatch:
        side = t.column("side").to_numpy()
        place = np.cumsum(side == 0) - 1, np.cumsum(side == 1) - 1
        rows = int((side == 0).sum()), int((side == 1).sum())
        keys = t.column("keys").combine_chunks()
        n = keys.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        row, flat = np.repeat(np.arange(len(side)), n), keys.flatten()
        product, code = (flat.field(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        order = np.lexsort((side[row], code, -product))  # the least product is written last
        row, code, product = row[order], code[order], product[order]
        least = np.full(rows, np.iinfo(np.int64).max)
        edge = np.append(np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (product[1:] != product[:-1]))), len(code)) if len(code) else []
        for x, y in zip(edge[:-1], edge[1:], strict=True):
            own = row[x:y]
            q, r = own[side[own] == 0], own[side[own] == 1]
            if len(q) and len(r):
                least[np.ix_(place[0][q], place[1][r])] = product[x]
        counts = [least.size, *[int((least <= b).sum()) for b in budgets]]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.int64()) for c in counts], names=["pairs", *[str(b) for b in budgets]])

    def each(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            p, i, j = (held.column(c).to_pylist() for c in ("p", "i", "j"))
            start = 0
            for x in range(1, len(p)):
                if p[x] != p[start] or i[x] != i[start] or j[x] != j[start]:
                    yield one(held.slice(start, x - start))
                    start = x
            held = held.slice(start)
        if held is not None and held.num_rows:
            yield one(held)

    return each


def grouped_coverage(queries: DataFrame, targets: DataFrame, q_postings: DataFrame, t_postings: DataFrame, budgets: tuple[int, ...] = BUDGETS, part_rows: int = COVERAGE_ROWS) -> DataFrame:
    """``budget_coverage`` of all pairs of a query and a target (rid, p) with the same p, without making a row for each pair.

    The rows of a group meet in pairs of parts, with those of their keys whose product is within the largest budget: others cover nothing.
    """
    near = key_products(q_postings, t_postings).where(F.col("product") <= max(budgets)).select(*B.KEY, "product")
    sizes = [df.where("p is not null").groupBy("p").agg(F.ceil(F.count(F.lit(1)) / F.lit(part_rows)).cast("int").alias(n)) for df, n in ((queries, "np"), (targets, "mp"))]
    groups = sizes[0].join(sizes[1], "p")

    def side(rows: DataFrame, postings: DataFrame, which: int) -> DataFrame:
        keys = postings.select("rid", *B.KEY).distinct().join(near, B.KEY).groupBy("rid").agg(F.collect_list(F.struct("product", F.xxhash64(*B.KEY).alias("code"))).alias("keys"))
        own, other = ("np", "mp") if which == 0 else ("mp", "np")
        dealt = rows.join(groups, "p").join(keys, "rid", "left").withColumns({"own": F.pmod(F.xxhash64("rid"), F.col(own)).cast("int"), "other": F.explode(F.sequence(F.lit(0), F.col(other) - 1))})
        i, j = ("own", "other") if which == 0 else ("other", "own")
        return dealt.select("p", F.col(i).alias("i"), F.col(j).alias("j"), F.lit(which).alias("side"), "keys")

    both = side(queries, q_postings, 0).unionByName(side(targets, t_postings, 1))
    both = both.repartition("p", "i", "j").sortWithinPartitions("p", "i", "j")
    counts = both.mapInArrow(_least_within(budgets), ", ".join(f"`{c}` long" for c in ("pairs", *budgets)))
    share = lambda b: F.coalesce(F.sum(str(b)) / F.sum("pairs"), F.lit(0.0)).alias(str(b))
    return counts.agg(*[share(b) for b in budgets]).select(F.inline(F.array(*[F.struct(F.lit(b).cast("long").alias("budget"), F.col(str(b)).alias("covered")) for b in budgets])))


def added_volume(products: DataFrame, above: int = 60, budgets: tuple[int, ...] = BUDGETS) -> DataFrame:
    """(budget, volume): pairs that keys above ``above`` target postings would add, each key up to the budget."""
    cols = [F.coalesce(F.sum(F.least("product", F.lit(b).cast("long"))), F.lit(0)).alias(str(b)) for b in budgets]
    return products.where(F.col("dft") > above).agg(*cols).select(F.inline(F.array(*[F.struct(F.lit(b).cast("long").alias("budget"), F.col(str(b)).alias("volume")) for b in budgets])))


def solo_recall(probed: DataFrame, gt: DataFrame) -> DataFrame:
    """(key_type, pairs, hits, recall) of each key type on its own."""
    pairs = probed.select("key_type", "s1", "tgt").distinct()
    hit = pairs.join(gt.select("s1", "tgt").withColumn("hit", F.lit(1)), ["s1", "tgt"], "left")
    n = gt.agg(F.count(F.lit(1)).alias("n_gt"))
    out = hit.groupBy("key_type").agg(F.count(F.lit(1)).alias("pairs"), F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"))
    return out.crossJoin(F.broadcast(n)).select("key_type", "pairs", "hits", F.when(F.col("n_gt") > 0, F.col("hits") / F.col("n_gt")).otherwise(1.0).alias("recall"))


def capped_solo_recall(q_postings: DataFrame, t_postings: DataFrame, gt: DataFrame, entities: DataFrame, caps: tuple[int, ...] = SOLO_CAPS) -> DataFrame:
    """(key_type, cap, pairs, per_row, recall) of each token key type on its own, at each cap of its target postings.

    Keys are probed once, at the largest cap; a pair counts at every cap that one of its keys is within.
    """
    t = t_postings.where(~F.col("key_type").isin(*EXACT_TYPES))
    stats = B.key_df(t).where(F.col("df") <= max(caps))
    probed = B.probe(q_postings, B.index(t, stats)).groupBy("key_type", "s1", "tgt").agg(F.min("df").alias("df"))
    hit = probed.join(gt.select("s1", "tgt").withColumn("hit", F.lit(1)), ["s1", "tgt"], "left")
    each = hit.withColumn("cap", F.explode(F.filter(F.lit(list(caps)), lambda c: c >= F.col("df"))))
    found = each.groupBy("key_type", "cap").agg(F.count(F.lit(1)).alias("pairs"), F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"))
    n = gt.agg(F.count(F.lit(1)).alias("n_gt")).crossJoin(F.broadcast(entities.agg(F.count(F.lit(1)).alias("n_s1"))))
    out = found.crossJoin(F.broadcast(n))
    return out.select("key_type", F.col("cap").cast("long").alias("cap"), "pairs", (F.col("pairs") / F.col("n_s1")).alias("per_row"), F.when(F.col("n_gt") > 0, F.col("hits") / F.col("n_gt")).otherwise(1.0).alias("recall"))


def predicate_coverage(gt: DataFrame, s1: DataFrame, targets: DataFrame, least: int = 4) -> DataFrame:
    """One row: share of true pairs that agree in name, signature, a word of the name or address, house number, postal code, and in any.

    House numbers and postal codes are read as for looking at the data: digits wherever they stand, six digits before five.
    """
    own = lambda df, key, n: df.select(F.col("rid").alias(key), F.col("name").alias(f"name{n}"), F.col("addr").alias(f"addr{n}"))
    r = gt.select("s1", "tgt").join(own(s1, "s1", 1), "s1").join(own(targets, "tgt", 2), "tgt")
    n1, n2, a1, a2 = (F.col(c) for c in ("name1", "name2", "addr1", "addr2"))
    words = lambda x, y: F.arrays_overlap(tokens(x, least), tokens(y, least))
    same = lambda x, y: (x != "") & (x == y)
    tests = {
        "name_exact": same(n1, n2),
        "name_sig": (n1 != "") & (N.name_sig(n1) == N.name_sig(n2)),
        "name_tok": words(n1, n2),
        "addr_tok": words(a1, a2),
        "house": same(N.house_digits(a1), N.house_digits(a2)),
        "postal": same(N.postal_six_first(a1), N.postal_six_first(a2)),
    }
    r = r.select(*[F.coalesce(c, F.lit(False)).cast("double").alias(k) for k, c in tests.items()])
    share = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return r.agg(*[share(F.col(k)).alias(k) for k in tests], share(F.greatest(*[F.col(k) for k in tests])).alias("any_key"))


def key_coverage(gt: DataFrame, probed: DataFrame) -> DataFrame:
    """One row: share of true pairs that share a key of each type, and of any."""
    from tessera.schema import KEY_TYPES

    flags = probed.groupBy("s1", "tgt").agg(*[F.max((F.col("key_type") == t).cast("int")).alias(t) for t in KEY_TYPES])
    hit = gt.join(flags, ["s1", "tgt"], "left")
    share = lambda c: F.coalesce(F.avg(F.coalesce(c, F.lit(0)).cast("double")), F.lit(0.0))
    return hit.agg(*[share(F.col(t)).alias(t) for t in KEY_TYPES], share(F.greatest(*[F.col(t) for t in KEY_TYPES])).alias("any_key"))


def weight_histogram(scored: DataFrame, edges: tuple[float, ...] = EDGES) -> DataFrame:
    """(bucket, n) of weights between the edges, the last bucket open."""
    b = F.size(F.filter(F.lit(list(edges)), lambda e: e <= F.col("w"))).cast("long")
    return scored.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def missed_by_weight(missed: DataFrame, weighted: DataFrame, edges: tuple[float, ...] = MISSED_EDGES) -> DataFrame:
    """(bucket, n): missed pairs by the largest vote of the keys that they share, in the bins between the edges (the last is closed).

    Pairs without a shared key, and votes beyond the edges, are in no bin; every bin has a row.
    """
    w = missed.select("s1", "tgt").join(weighted.select("s1", "tgt", "w"), ["s1", "tgt"])
    last = len(edges) - 2
    b = F.least(F.size(F.filter(F.lit(list(edges)), lambda e: e <= F.col("w"))) - 1, F.lit(last))
    n = w.where((F.col("w") >= edges[0]) & (F.col("w") <= edges[-1])).groupBy(b.cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return missed.sparkSession.range(len(edges) - 1).withColumnRenamed("id", "bucket").join(n, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def df_lookup(keys: DataFrame, stats: DataFrame) -> DataFrame:
    """keys' rows with the document frequency of their key in stats, 0 for a key that stats does not have."""
    return keys.join(stats.select(*B.KEY, "df"), B.KEY, "left").withColumn("df", F.coalesce("df", F.lit(0)))


def local_recall(pairs: DataFrame, gt: DataFrame, first: int) -> DataFrame:
    """(truth, covered, recall, pairs, per_row) of the first query rows only."""
    near = lambda df: df.where((F.col("s1") >= 0) & (F.col("s1") < first)).select("s1", "tgt")
    mine = near(pairs).distinct()
    hit = near(gt).join(mine.withColumn("hit", F.lit(1)), ["s1", "tgt"], "left")
    a = hit.agg(F.count(F.lit(1)).alias("truth"), F.coalesce(F.sum("hit"), F.lit(0)).alias("covered"))
    b = mine.agg(F.count(F.lit(1)).alias("pairs"))
    return a.crossJoin(F.broadcast(b)).select("truth", "covered", (F.col("covered") / F.greatest("truth", F.lit(1))).alias("recall"), "pairs", (F.col("pairs") / F.lit(first)).alias("per_row"))


def sampled_top(scored: DataFrame, n: int = 4, k: int = 3, more_than: int = 10) -> DataFrame:
    """The k best scored targets of n query rows that have more than so many; the rows with the least hash."""
    rows = scored.groupBy("s1").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than).select("s1")
    best = Window.partitionBy("s1").orderBy(F.desc("w"), "tgt")
    return scored.join(F.broadcast(sampled(rows, n, "s1")), "s1").withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k)


def weight_by_label(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.avg("w").alias("mean_w"), F.percentile("w", F.lit(0.5)).alias("median_w"))


def degrees(gt: DataFrame, s1: DataFrame) -> DataFrame:
    """(country, entities, with_match, mean_, std_, p25_, p50_, p75_ and max_degree) of true matches."""
    d = gt.groupBy("s1").agg(F.count(F.lit(1)).alias("d"))
    all_ = s1.select(F.col("rid").alias("s1"), "country").join(d, "s1", "left").withColumn("d", F.coalesce("d", F.lit(0)))
    return all_.groupBy("country").agg(F.count(F.lit(1)).alias("entities"), F.sum((F.col("d") > 0).cast("long")).alias("with_match"), F.avg("d").alias("mean_degree"), F.stddev_samp("d").alias("std_degree"), *[F.percentile("d", F.lit(q)).alias(f"p{round(100 * q)}_degree") for q in (0.25, 0.5, 0.75)], F.max("d").alias("max_degree"))


def duplicate_ratio(normal: DataFrame, column: str = "name") -> DataFrame:
    """(src, ratio): share of rows whose value has been seen before."""
    return normal.groupBy("src").agg((1 - F.count_distinct(column) / F.count(F.lit(1))).alias("ratio"))


def country_agreement(gt: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    a = s1.select(F.col("rid").alias("s1"), F.col("country").alias("c1"))
    b = targets.select(F.col("rid").alias("tgt"), F.col("country").alias("c2"))
    return gt.join(a, "s1").join(b, "tgt").agg(F.count(F.lit(1)).alias("pairs"), F.avg((F.col("c1") == F.col("c2")).cast("double")).alias("agreement"))


def pairs_per_row(pairs: DataFrame, s1: DataFrame, first: int | None = None) -> DataFrame:
    rows = s1.select(F.col("rid").alias("s1"))
    if first is not None:
        rows = rows.where(F.col("s1") < first)
    n = pairs.groupBy("s1").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(n, "s1", "left").agg(F.count(F.lit(1)).alias("entities"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"), F.avg(F.coalesce("n", F.lit(0))).alias("per_row"))


def sampled(rows: DataFrame, n: int, *key: str) -> DataFrame:
    """A fixed random sample: the n rows with the least hash."""
    return rows.orderBy(F.xxhash64(*key), *key).limit(n)


def hard_pairs(gt: DataFrame, probed: DataFrame, n: int = 12) -> DataFrame:
    return E.missed(probed, gt).orderBy("s1", "tgt").limit(n)


def prefixes(ids: DataFrame, column: str = "entity_id") -> DataFrame:
    return ids.select(F.substring(column, 1, 3).alias("prefix")).distinct()
