"""The 20 features of a candidate pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.functions import textnorm as N

# Names and order of the features.
FEATURES = (
    "name_ratio", "name_tsr", "name_tsort", "name_partial", "name_jacc", "name_exact", "name_len_ratio", "name_jw", "name_sig_jacc", "name_sig_exact",
    "addr_ratio", "addr_tsr", "addr_tsort", "addr_jacc", "addr_exact", "addr_len_ratio", "house_match", "postal_match", "script_mismatch", "same_source",
)


def with_records(pairs: DataFrame, s1: DataFrame, targets: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (s1, tgt) with the normalized attributes of both sides, and those named besides, suffixed 1 and 2."""
    own = ["name", "addr", "house", "zip", "nn", "an", *also]
    left = s1.select(F.col("rid").alias("s1"), *[F.col(c).alias(f"{c}1") for c in own])
    right = targets.select(F.col("rid").alias("tgt"), "is_s3", *[F.col(c).alias(f"{c}2") for c in own])
    return pairs.join(left, "s1").join(right, "tgt")


def column_features(rows: DataFrame) -> DataFrame:
    """The features that are column expressions; they stay in the JVM."""
    n1, n2, a1, a2 = (F.col(c) for c in ("name1", "name2", "addr1", "addr2"))
    g1, g2 = N.name_sig(n1), N.name_sig(n2)
    return rows.withColumns(
        {
            "name_jacc": S.jaccard(n1, n2),
            "name_exact": S.exact(n1, n2),
            "name_len_ratio": S.length_ratio(n1, n2),
            "name_sig_jacc": S.jaccard(g1, g2),
            "name_sig_exact": S.exact(g1, g2),
            "addr_jacc": S.jaccard(a1, a2),
            "addr_exact": S.exact(a1, a2),
            "addr_len_ratio": S.length_ratio(a1, a2),
            "house_match": S.exact(F.col("house1"), F.col("house2")),
            "postal_match": S.exact(F.col("zip1"), F.col("zip2")),
            "script_mismatch": ((F.col("nn1") != F.col("nn2")) | (F.col("an1") != F.col("an2"))).cast("double"),
            "same_source": F.col("is_s3").cast("double"),
        }
    )


def pair_features(pairs: DataFrame, s1: DataFrame, targets: DataFrame, also: tuple[str, ...] = (), **more: Column) -> DataFrame:
    """(s1, tgt, 20 features) of distinct pairs; ``more`` are further columns, of the attributes named in ``also`` too."""
    rows = column_features(with_records(pairs.select("s1", "tgt").distinct(), s1, targets, also))
    n1, n2, a1, a2 = (F.col(c) for c in ("name1", "name2", "addr1", "addr2"))
    rows = rows.withColumns(
        {
            "name_ratio": S.ratio_column(n1, n2), "name_tsr": S.token_set_column(n1, n2), "name_tsort": S.token_sort_column(n1, n2),
            "name_partial": S.partial_column(n1, n2), "name_jw": S.jaro_winkler_column(n1, n2),
            "addr_ratio": S.ratio_column(a1, a2), "addr_tsr": S.token_set_column(a1, a2), "addr_tsort": S.token_sort_column(a1, a2),
        }
    )
    return rows.select("s1", "tgt", *[F.col(f).cast("float").alias(f) for f in FEATURES], *[c.alias(k) for k, c in more.items()])
