"""Findings of round 2."""

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import jaccard_join, storage


def test_sketches_lose_no_link():
    """sketches of all lengths, in one part and across two, connect all sets that link, and few others."""
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, rng.integers(2, 700), dtype=np.uint64)
        for rate in (0, 0.02, 0.05, 0.08, 0.1):
            own = base.copy()
            new = rng.random(len(own)) < rate
            own[new] = rng.integers(0, 1 << 63, new.sum(), dtype=np.uint64)
            sets.append(np.unique(own))
    n = np.array([len(x) for x in sets])
    sketch = jaccard_join.sketches(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]))
    part, rows = rng.integers(0, 2, len(sets)), np.arange(len(sets))
    whole, _ = jaccard_join._near_pairs(n, sketch, rows, rows, 85)
    across, _ = jaccard_join._near_pairs(n, sketch, rows[part == 0], rows[part == 1], 85)
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 85 * (n[a] + n[b] - both):
                assert whole[a] == whole[b]
                assert part[a] == part[b] or across[a] == across[b]
    assert len(set(whole.tolist())) >= 60


def test_chained_block_is_cut(spark):
    """of a block of unrelated sets only those go to the join of whole sets that are near another one."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64)) for _ in range(300)]
    sets += [np.delete(sets[7], 3), np.delete(sets[7], 9)]
    sketch = jaccard_join.sketches(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]))
    rows = [(bytes([i // 256, i % 256]), i, len(s), bytearray(sketch[i])) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "rid binary, s1 long, n long, sketch binary")
    member = df.select("rid", "s1", F.lit(0).cast("long").alias("s2"), F.col("rid").alias("id"), "n", F.lit(1).cast("long").alias("mult"), F.lit(-5).cast("long").alias("block"))
    for sketch_rows in (16_384, 40):
        out = jaccard_join._refined(member, df.select("rid", "sketch"), 85, 100, 1 << 20, sketch_rows).collect()
        assert sorted(r["s1"] for r in out) == [7, 300, 301] and len({r["block"] for r in out}) == 1, sketch_rows
    whole = jaccard_join._refined(member, df.select("rid", "sketch"), 85, 2000, 12 << 20, 16_384)
    assert whole.count() == len(sets)


def test_shuffle_files_go_with_what_they_were_for(spark):
    """a stored table leaves no shuffle files behind."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()

    def files():
        found = env.blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before = files()
    out = storage.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition("count"), "test-files")
    assert out.count() == 7
    after = files() - before
    storage.stored(spark.range(1000).repartition("id"), "test-files")
    assert files() - before <= after
    with_own = spark.conf.get(storage._CLEANUP, None)
    assert with_own in (None, "false")
