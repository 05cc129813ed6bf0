"""The whole of entity resolution: block, featurize, train, tune, predict, decide, write."""

from __future__ import annotations

import argparse
import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import blocking as B
from tessera.operators import decide as D
from tessera.operators import evaluate as E
from tessera.operators import model as M
from tessera.operators.features import pair_features
from tessera.operators.keys import normalize, postings
from tessera.sources.entities import load_split, read_ground_truth


def staged(df_of, spark: SparkSession, path: str, config: dict, force: bool = False) -> DataFrame:
    """A stage's table, made once for each configuration (its hash is part of the path)."""
    at = f"{path}-{hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()[:12]}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
    if force or not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        df_of().write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)


def candidates(s1: DataFrame, targets: DataFrame, m: int = B.TOP_M, caps: dict[str, int] | None = None) -> DataFrame:
    return B.block(postings(s1), postings(targets), targets, m, caps)


def resolve(spark: SparkSession, data: str, cache: str, out: str, limit: int | None = None, rounds: int = M.ROUNDS, rate: float = 0.08, k: int = D.TOP_K, force: bool = False, depth: int = M.DEPTH, least: int = M.LEAST, skip_cv: bool = False) -> float:
    """Trains on the ``train`` split, writes matching_results and candidate_pairs of the ``test`` split; returns the threshold.

    ``skip_cv`` takes model and threshold of a former run in ``out`` instead of training.
    """
    tables = {}
    for split in ("train", "test"):
        s1, tgt = load_split(spark, data, split, limit)
        config = {"split": split, "limit": limit, "m": B.TOP_M, "caps": B.CAPS, "unicode": True}
        s1 = staged(lambda s1=s1: normalize(s1, full_unicode=True), spark, f"{cache}/{split}_s1", config, force)
        tgt = staged(lambda tgt=tgt: normalize(tgt, full_unicode=True), spark, f"{cache}/{split}_tgt", config, force)
        pairs = staged(lambda s1=s1, tgt=tgt: candidates(s1, tgt), spark, f"{cache}/{split}_pairs", config, force)
        feats = staged(lambda p=pairs, s1=s1, tgt=tgt: pair_features(p, s1, tgt), spark, f"{cache}/{split}_features", config, force)
        tables[split] = (s1, tgt, pairs, feats)
    if skip_cv:
        final, threshold = M.load(spark, f"{out}/model")
        if threshold is None:
            raise ValueError(f"no threshold in {out}/model")
    else:
        final, threshold = fitted(spark, *tables["train"][:2], tables["train"][3], data, rounds, rate, depth, least)
        M.save(final, f"{out}/model", threshold)
    s1, tgt, pairs, feats = tables["test"]
    matches = D.decide(M.predict(final, feats), threshold, k)
    D.write_lists(D.id_lists(matches, s1, tgt), f"{out}/matching_results.tsv")
    D.write_candidates(D.id_lists(pairs, s1, tgt, "candidate_entity_ids"), f"{out}/candidate_pairs.tsv")
    return threshold


def fitted(spark: SparkSession, s1: DataFrame, tgt: DataFrame, feats: DataFrame, data: str, rounds: int, rate: float, depth: int, least: int):
    """(model of all rows, threshold): the threshold is the best on one query entity in twenty, by a model that has not seen them."""
    gt = E.ground_truth(read_ground_truth(spark, f"{data}/train_ground_truth.tsv"), s1, tgt)
    rows = E.holdout(E.labelled(feats, gt))
    sample = E.subsample(rows, exact=False)
    first = M.train(sample.where("fold <> 0"), rounds, rate, depth, least)
    held = M.predict(first, rows.where("fold = 0")).join(rows.select("s1", "tgt", "y"), ["s1", "tgt"])
    entities = E.holdout(s1.select(F.col("rid").alias("s1"))).where("fold = 0").select(F.col("s1").alias("rid"))
    best = E.best_threshold(E.threshold_curve(held, gt.join(entities, gt["s1"] == entities["rid"], "left_semi"), entities)).first()
    return M.train(sample, rounds, rate, depth, least), best["t"]


def main() -> None:
    p = argparse.ArgumentParser()
    for name in ("data", "cache", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--limit", type=int)
    p.add_argument("--rounds", type=int, default=M.ROUNDS)
    p.add_argument("--depth", type=int, default=M.DEPTH)
    p.add_argument("--min-leaf", type=int, default=M.LEAST)
    p.add_argument("--skip-cv", action="store_true", help="take model and threshold of a former run")
    p.add_argument("--lr", type=float, default=0.08)
    p.add_argument("--topk", type=int, default=D.TOP_K)
    p.add_argument("--force", action="store_true")
    a = p.parse_args()
    spark = SparkSession.builder.appName("resolution").getOrCreate()
    print(resolve(spark, a.data, a.cache, a.out, a.limit, a.rounds, a.lr, a.topk, a.force, a.depth, a.min_leaf, a.skip_cv))


if __name__ == "__main__":
    main()
