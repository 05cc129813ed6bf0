"""Findings of round 3."""

import random

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.operators import evaluate as E
from tessera.operators import model
from tessera.operators.features import FEATURES, pair_features


def test_ml_score_makes_no_list_of_true_pairs(spark, monkeypatch):
    """the same pairs, features and labels as with a row for each true pair, which is no longer made; blocking is worked out once."""
    from tessera import catalog

    d, seen = "/root/testdata/sf0.001", []
    v = catalog.View(spark, d)
    want = E.holdout(E.labelled(pair_features(v.pairs(), v.s1, v.tgt), v.gt())).persist()
    assert {r["y"] for r in want.select("y").distinct().collect()} == {0, 1}
    gt, blocked = catalog.View.gt, []
    monkeypatch.setattr(catalog.View, "gt", lambda self: seen.append("gt") or gt(self))
    pairs = catalog.View.pairs
    monkeypatch.setattr(catalog.View, "pairs", lambda self: blocked.append(self) or pairs(self))
    monkeypatch.setattr(model, "train", lambda rows, **_: None)
    monkeypatch.setattr(model, "predict", lambda fit, rows: rows)
    got = catalog.queries()["ml_score"](spark, d)
    assert not seen and len(blocked) == 1
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_alike_rows_train_as_one_with_their_number(spark, monkeypatch):
    """the rounds pass over a row for each different one; a leaf needs as many rows as before."""
    rows = spark.range(600).select(*[(F.col("id") % 2 if f == "name_ratio" else F.lit(0)).cast("float").alias(f) for f in FEATURES], (F.col("id") % 2).cast("int").alias("y"))
    seen, fit = [], model.Pipeline.fit
    monkeypatch.setattr(model.Pipeline, "fit", lambda self, df: seen.append((df.count(), df.agg(F.sum("n")).first()[0])) or fit(self, df))
    kinds = [r[0] for r in model.train(rows, rounds=2, least=300).stages[-1].transform(vectors(rows)).groupBy("prediction", "y").count().select("count").collect()]
    assert seen == [(2, 600)] and kinds == [300, 300]
    for least in (301, 100_000):
        alone = model.train(rows, rounds=2, least=least).stages[-1]
        assert all(t.numNodes == 1 for t in alone.trees)


def vectors(rows):
    return model.VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def test_windows_cut_short_by_an_end(monkeypatch):
    """all windows that an end cuts short take one search and not one each, with the same ratios."""
    r = random.Random(3)
    word = lambda n, letters: "".join(r.choice(letters) for _ in range(n))
    pairs = [(word(r.randrange(1, 90), "abc "), word(r.randrange(1, 90), "abc ")) for _ in range(300)]
    pairs += [(word(n, "abcdef"), word(n, "abcdef")) for n in (1, 2, 60, 64, 65) for _ in range(20)]
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    assert np.array_equal(S.partial_many(a, b), [S.partial(x, y) for x, y in pairs])
    lanes, step = [], S._step
    monkeypatch.setattr(S, "_step", lambda v, at: lanes.append(v[0].size) or step(v, at))
    S.partial_many([word(60, "abc")] * 50, [word(60, "bcd")] * 50)
    assert sum(lanes) <= 100 * 60 * 4


def test_many_different_characters():
    """The padding of a batch with more than 254 characters is none of them."""
    a = ["".join(chr(0x4E00 + i) for i in range(k, k + 40)) for k in range(0, 400, 20)]
    b = [x[: 10 + k] for k, x in enumerate(a)]
    pairs = [(x, y) for x in a for y in b]
    x, y = [p[0] for p in pairs], [p[1] for p in pairs]
    for many, one in ((S.ratio_many, S.ratio), (S.partial_many, S.partial), (S.jaro_winkler_many, S.jaro_winkler)):
        assert np.allclose(many(x, y), [one(p, q) for p, q in pairs], atol=1e-12)
