"""Findings of round 2."""

from pyspark.sql import functions as F

from tessera.operators import calibrate as C


def test_grouped_coverage_equals_pairs(spark):
    """the same shares as with a row for each pair, in one part and in several, without a join that makes the pairs."""
    rows = [(i, f"p{i % 7 % 3}" if i % 11 else None) for i in range(90)]
    keys = [(i, "a" if (i + k) % 2 else "b", f"k{(i * k) % (5 + 3 * k)}") for i, _ in rows for k in range(1, 5)]
    ids, posts = spark.createDataFrame(rows, "rid long, p string"), spark.createDataFrame(keys, "rid long, key_type string, key string")
    q, t = ids.where("rid % 3 = 0"), ids.where("rid % 3 > 0")
    qp, tp = posts.where("rid % 3 = 0"), posts.where("rid % 3 > 0")
    gt = q.select(F.col("rid").alias("s1"), "p").join(t.select(F.col("rid").alias("tgt"), "p"), "p").select("s1", "tgt")
    budgets = (5, 20, 60, 150, 400)
    want = sorted(map(tuple, C.budget_coverage(C.least_products(gt, qp, tp), budgets).collect()))
    assert len({c for _, c in want}) > 2
    for part_rows in (1024, 3):
        got = sorted(map(tuple, C.grouped_coverage(q, t, qp, tp, budgets, part_rows).collect()))
        assert [b for b, _ in got] == [b for b, _ in want]
        assert all(abs(x - y) < 1e-12 for (_, x), (_, y) in zip(got, want, strict=True))
    none = C.grouped_coverage(q.where("false"), t, qp, tp, budgets).collect()
    assert [r["covered"] for r in none] == [0.0] * 5


def test_ml_score_works_features_out_once(spark, monkeypatch):
    """the rows that are trained on and scored come from a stored table."""
    from tessera import catalog
    from tessera.operators import model

    seen = []
    monkeypatch.setattr(model, "train", lambda rows, **_: seen.append(rows))
    monkeypatch.setattr(model, "predict", lambda fit, rows: rows)
    scored = catalog.queries()["ml_score"](spark, "/root/testdata/sf0.001")
    assert all("ml-rows" in f for rows in (seen[0], scored) for f in rows.inputFiles())
