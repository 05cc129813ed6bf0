"""Candidate pairs: an inverted-index join over capped keys, scored by IDF.

Country is part of the join key, so pairs of different countries are never made; document frequencies and IDF are
counted before, over all countries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.schema import EXACT_TYPES

EXACT_CAP = 2000
TOKEN_CAP = 300
#: No cap: postal. Keys of the exact family have the cap of the index build.
CAPS = {**dict.fromkeys(EXACT_TYPES, EXACT_CAP), **dict.fromkeys(("name_tok", "addr_tok", "addr_bi", "name_bi", "house", "house_norm"), TOKEN_CAP)}
TOP_M = 40
PAIR_BUDGET = 400_000_000
#: Votes of the key types in the weighted variant.
WEIGHTS = {"name_exact": 10.0, "name_sig": 8.0, "name_nospace": 8.0, "name_bi": 4.0, "name_tok": 2.5, "addr_tok": 1.5, "addr_bi": 1.0, "house": 2.0, "house_norm": 2.0, "postal": 0.5}
KEY = ["key_type", "key"]


def key_df(postings: DataFrame) -> DataFrame:
    """(key_type, key, df): numbers of postings."""
    return postings.groupBy(*KEY).agg(F.count(F.lit(1)).alias("df"))


def cap_of(caps: dict[str, int]):
    out = F.lit(None).cast("long")
    for t, c in caps.items():
        out = F.when(F.col("key_type") == t, F.lit(c)).otherwise(out)
    return out


def capped(stats: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """Keys with at most as many postings as their type's cap; stays capped once."""
    if "capped" in stats.columns:
        raise ValueError("the index is capped already")
    cap = cap_of(CAPS if caps is None else caps)
    return stats.where(cap.isNull() | (F.col("df") <= cap)).withColumn("capped", F.lit(True))


def with_cap(stats: DataFrame, cap: int | None) -> DataFrame:
    """One cap for all types."""
    if cap is None:
        raise ValueError("a cap is needed")
    if "capped" in stats.columns:
        raise ValueError("the index is capped already")
    return stats.where(F.col("df") <= cap).withColumn("capped", F.lit(True))


def with_idf(stats: DataFrame, n_targets: DataFrame | int) -> DataFrame:
    """idf = log(1 + N / df), N the number of target entities."""
    if isinstance(n_targets, int):
        return stats.withColumn("idf", F.log1p(F.lit(n_targets) / F.col("df")))
    return stats.crossJoin(F.broadcast(n_targets.agg(F.count(F.lit(1)).alias("n_tgt")))).withColumn("idf", F.log1p(F.col("n_tgt") / F.col("df"))).drop("n_tgt")


def index(target_postings: DataFrame, stats: DataFrame) -> DataFrame:
    """Target postings of the keys in stats, with what stats knows of them."""
    return target_postings.join(stats, KEY)


def probe(query_postings: DataFrame, target_index: DataFrame) -> DataFrame:
    """Every query posting with every target posting of the same key and country: (s1, tgt, key_type, key, idf if known)."""
    more = [c for c in ("idf", "df") if c in target_index.columns]
    t = target_index.select(F.col("rid").alias("tgt"), "country", *KEY, *more)
    return query_postings.select(F.col("rid").alias("s1"), "country", *KEY).join(t, ["country", *KEY]).select("s1", "tgt", *KEY, *more)


def expansion(query_postings: DataFrame, target_index: DataFrame) -> DataFrame:
    """(key_type, pairs): how many pairs a probe would make, without making them."""
    q = query_postings.groupBy("country", *KEY).agg(F.count(F.lit(1)).alias("nq"))
    t = target_index.groupBy("country", *KEY).agg(F.count(F.lit(1)).alias("nt"))
    return q.join(t, ["country", *KEY]).groupBy("key_type").agg(F.sum(F.col("nq") * F.col("nt")).alias("pairs"))


def guarded_probe(query_postings: DataFrame, target_index: DataFrame, budget: int = PAIR_BUDGET) -> DataFrame:
    over = [f"{r['key_type']}: {r['pairs']}" for r in expansion(query_postings, target_index).where(F.col("pairs") > budget).collect()]
    if over:
        raise ValueError(f"more than {budget} pairs for {', '.join(over)}; lower the caps")
    return probe(query_postings, target_index)


def exact_pairs(probed: DataFrame) -> DataFrame:
    return probed.where(F.col("key_type").isin(*EXACT_TYPES)).select("s1", "tgt").distinct()


def token_scores(probed: DataFrame) -> DataFrame:
    """(s1, tgt, w): summed IDF of shared keys; repeated words count as often as they meet."""
    return probed.where(~F.col("key_type").isin(*EXACT_TYPES)).groupBy("s1", "tgt").agg(F.sum("idf").alias("w"))


def quantized(w):
    """16-bit squash of a weight, halves to even."""
    return F.rint(w / (w + 8) * 65535).cast("long")


def top_m(scored: DataFrame, m: int = TOP_M) -> DataFrame:
    """The m best targets of each query row by quantized weight, ties to the lower target."""
    best = Window.partitionBy("s1").orderBy(F.desc("q"), "tgt")
    return scored.withColumn("q", quantized(F.col("w"))).withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= m)


def max_weight(probed: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(s1, tgt, w): largest vote of the shared keys."""
    w = F.lit(None).cast("double")
    for t, v in (weights or WEIGHTS).items():
        w = F.when(F.col("key_type") == t, F.lit(v)).otherwise(w)
    return probed.groupBy("s1", "tgt").agg(F.max(w).alias("w"))


def top_m_by_weight(scored: DataFrame, m: int = TOP_M) -> DataFrame:
    best = Window.partitionBy("s1").orderBy(F.desc("w"), "tgt")
    return scored.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= m)


def block(query_postings: DataFrame, target_postings: DataFrame, targets: DataFrame | int, m: int = TOP_M, caps: dict[str, int] | None = None) -> DataFrame:
    """Candidates (s1, tgt): exact-family pairs, and the top m by summed IDF.

    One probe and one aggregation for each pair tell both; a row's pairs are ranked as in ``top_m``, those without a token key last.
    """
    stats = with_idf(capped(key_df(target_postings), caps), targets)
    exact = F.col("key_type").isin(*EXACT_TYPES)
    pairs = probe(query_postings, index(target_postings, stats)).groupBy("s1", "tgt").agg(F.max(exact).alias("exact"), F.sum(F.when(~exact, F.col("idf"))).alias("w"))
    best = Window.partitionBy("s1").orderBy(F.desc_nulls_last("q"), "tgt")
    ranked = pairs.withColumn("q", quantized(F.col("w"))).withColumn("rn", F.row_number().over(best))
    return ranked.where(F.col("exact") | (F.col("w").isNotNull() & (F.col("rn") <= m))).select("s1", "tgt")


def block_unscored(query_postings: DataFrame, target_postings: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """All pairs that share a capped key of any type."""
    return probe(query_postings, index(target_postings, capped(key_df(target_postings), caps))).select("s1", "tgt").distinct()


def save_table(table: DataFrame, path: str, *keys: str) -> DataFrame:
    """Stores document frequencies or an index, rows with the same first key next to each other, and reads them again."""
    rows = table.repartition(*keys).sortWithinPartitions(*keys) if keys else table
    rows.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.parquet(path)


def loose_index(target_postings: DataFrame, path: str, cap: int | None = None) -> DataFrame:
    """The target index with its document frequencies, stored before any cap (or with one loose cap), to be capped again and again."""
    stats = key_df(target_postings)
    return save_table(index(target_postings, stats if cap is None else stats.where(F.col("df") <= cap)), path, *KEY)
