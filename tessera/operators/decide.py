"""From scores to decisions and result lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.schema import CANDIDATE_HEADER, MATCH_HEADER

TOP_K = 10


def top_k(scored: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k most probable targets of each query row, ties to the higher target; the others are removed."""
    best = Window.partitionBy("s1").orderBy(F.desc("prob"), F.desc("tgt"))
    return scored.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k).drop("rn")


def decide(scored: DataFrame, threshold: float, k: int = TOP_K) -> DataFrame:
    return top_k(scored, k).where(F.col("prob") >= threshold)


def id_lists(pairs: DataFrame, s1: DataFrame, targets: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """(rid, source1_entity_id, list): one row for every query row, its target ids in row order, joined by commas."""
    ids = targets.select(F.col("rid").alias("tgt"), F.col("entity_id").alias("tgt_id"))
    lists = pairs.select("s1", "tgt").join(ids, "tgt").groupBy("s1").agg(F.array_sort(F.collect_list(F.struct("tgt", "tgt_id"))).alias("own"))
    out = s1.select("rid", F.col("entity_id").alias("source1_entity_id")).join(lists, F.col("rid") == F.col("s1"), "left")
    return out.select("rid", "source1_entity_id", F.coalesce(F.array_join(F.transform("own", lambda x: x["tgt_id"]), ","), F.lit("")).alias(column))


def write_lists(lists: DataFrame, path: str, header: tuple[str, str] = MATCH_HEADER) -> None:
    """One tab-separated text file in the order of the query rows, with a header.

    Rows are range-partitioned and written in parallel; the parts are then joined in order, byte for byte, by the file system's client.
    """
    spark = lists.sparkSession
    parts = f"{path}.parts"
    line = F.concat_ws("\t", *[F.col(c) for c in lists.columns[1:3]]).alias("value")
    lists.select("rid", line).orderBy("rid").select("value").write.mode("overwrite").text(parts)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    if fs.exists(target):
        fs.delete(target, True)
    out = fs.create(target, True)
    try:
        out.write(bytearray(("\t".join(header) + "\n").encode()))
        names = sorted(x.getPath().toString() for x in fs.listStatus(folder) if x.getPath().getName().startswith("part-"))
        for name in names:
            part = fs.open(jvm.org.apache.hadoop.fs.Path(name))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
            part.close()
    finally:
        out.close()
    fs.delete(folder, True)


def write_candidates(lists: DataFrame, path: str) -> None:
    write_lists(lists, path, CANDIDATE_HEADER)
