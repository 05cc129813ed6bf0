import pytest
from pyspark.sql import functions as F

from tessera.operators import blocking as B
from tessera.operators import decide as D
from tessera.operators import evaluate as E
from tessera.operators import keys as K
from tessera.operators import validate as V
from tessera.sources.entities import load_split, read_ground_truth, read_tsv


def entities(spark, rows):
    return spark.createDataFrame(rows, "rid long, src int, is_s3 boolean, entity_id string, business_name string, business_address string, country string")


ROWS = [
    (0, 0, False, "S1-0", "Alpha Works Ltd", "12 Main St", "US"),
    (1, 0, False, "S1-1", "Beta Tools", "007 Oak Rd 12345", "US"),
    (0, 1, False, "S2-0", "alpha works ltd", "12 Main Street", "US"),
    (1, 1, False, "S2-1", "works alpha", "9 Elm", "US"),
    (2, 2, True, "S3-0", "Alpha Works Ltd", "12 Main St", "FR"),
]


def test_postings_keep_repeats(spark):
    n = K.normalize(entities(spark, [(0, 0, False, "S1-0", "tango tango ab", "", "US")]))
    got = sorted((r["key_type"], r["key"]) for r in K.postings(n).collect())
    assert got.count(("name_tok", "tango")) == 2
    assert ("name_bi", "tango tango") in got
    assert not [g for g in got if g[0].startswith("addr")]


def test_blocking_keeps_country_apart(spark):
    n = K.normalize(entities(spark, ROWS))
    s1, tgt = n.where("src = 0"), n.where("src > 0")
    got = {tuple(r) for r in B.block(K.postings(s1), K.postings(tgt), tgt).collect()}
    assert (0, 0) in got and (0, 1) in got
    assert (0, 2) not in got


def test_caps_and_guard(spark):
    stats = spark.createDataFrame([("name_tok", "a", 5), ("postal", "b", 9999)], "key_type string, key string, df long")
    assert {r["key"] for r in B.capped(stats, {"name_tok": 4}).collect()} == {"b"}
    with pytest.raises(ValueError):
        B.with_cap(stats, None)
    with pytest.raises(ValueError):
        B.capped(B.with_cap(stats, 5))
    n = K.normalize(entities(spark, ROWS))
    with pytest.raises(ValueError):
        B.guarded_probe(K.postings(n.where("src = 0")), K.postings(n.where("src > 0")), 0)


def test_top_m_ties_to_lower_and_top_k_to_higher(spark):
    s = spark.createDataFrame([(1, 5, 2.0), (1, 3, 2.0), (1, 4, 1.0)], "s1 long, tgt long, w double")
    assert [r["tgt"] for r in B.top_m(s, 1).collect()] == [3]
    assert [r["tgt"] for r in D.top_k(s.withColumnRenamed("w", "prob"), 1).collect()] == [5]


@pytest.mark.parametrize(("tp", "fp", "truth", "want"), [(2, 1, 2, 0.7142857), (0, 0, 0, 1.0), (0, 1, 0, 0.0), (0, 0, 3, 0.0), (1, 0, 1, 1.0)])
def test_f05(spark, tp, fp, truth, want):
    got = spark.range(1).select(E.f05(F.lit(tp), F.lit(fp), F.lit(truth))).first()[0]
    assert abs(got - want) < 1e-6


def test_sweep_matches_each_threshold(spark):
    scored = spark.createDataFrame([(0, 1, 0.9, 1), (0, 2, 0.4, 0), (1, 1, 0.3, 1), (1, 3, 0.05, 0), (2, 2, 0.01, 0)], "s1 long, tgt long, prob double, y int")
    gt = spark.createDataFrame([(0, 1), (1, 1), (3, 1)], "s1 long, tgt long")
    s1 = spark.createDataFrame([(i,) for i in range(5)], "rid long")
    curve = {round(r["t"], 6): r["score"] for r in E.threshold_curve(scored, gt, s1).collect()}
    assert len(curve) == 37
    for t in E.THRESHOLDS[::6]:
        want = E.macro_f05(E.entity_counts(scored, gt, s1, t)).first()[0]
        assert abs(curve[round(t, 6)] - want) < 1e-9
    assert E.recall(scored, gt.limit(0)).first()[0] == 1.0


def test_sources_and_lists(spark, tmp_path):
    for k, rows in ((1, ["S1-a\tOne\t1 A St\tUS", "S1-b\tNA\t\tUS"]), (2, ["S2-a\tone\t1 A St\tUS"]), (3, ["S3-a\tTwo\tx\tUS"])):
        (tmp_path / f"t_source{k}.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "\n".join(rows) + "\n")
    s1, tgt = load_split(spark, str(tmp_path), "t")
    assert [(r["rid"], r["business_name"]) for r in s1.orderBy("rid").collect()] == [(0, "One"), (1, "")]
    assert [(r["rid"], r["is_s3"]) for r in tgt.orderBy("rid").collect()] == [(0, False), (1, True)]
    assert read_tsv(spark, str(tmp_path / "t_source1.tsv"), 1).count() == 1
    (tmp_path / "gt.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-a\tS2-a,S3-zz\nS1-b\t\n")
    gt = E.ground_truth(read_ground_truth(spark, str(tmp_path / "gt.tsv")), s1, tgt)
    assert [tuple(r) for r in gt.collect()] == [(0, 0)]
    lists = D.id_lists(gt, s1, tgt)
    D.write_lists(lists, str(tmp_path / "m"))
    D.write_candidates(D.id_lists(gt, s1, tgt, "candidate_entity_ids"), str(tmp_path / "c"))
    assert (tmp_path / "m").read_text() == "source1_entity_id\tmatched_entity_ids\nS1-a\tS2-a\nS1-b\t\n"


def check(spark, tmp_path, matches, candidates="source1_entity_id\tcandidate_entity_ids\nS1-a\tS2-a\nS1-b\t\n", ids=False):
    sources = []
    for k, own in ((1, "S1-a\nS1-b"), (2, "S2-a"), (3, "S3-a")):
        (tmp_path / f"s{k}.tsv").write_text(f"entity_id\n{own}\n")
        sources.append(str(tmp_path / f"s{k}.tsv"))
    (tmp_path / "m.tsv").write_bytes(matches if isinstance(matches, bytes) else matches.encode())
    (tmp_path / "c.tsv").write_text(candidates)
    return {r["rule"]: r["level"] for r in V.validate(spark, str(tmp_path / "m.tsv"), str(tmp_path / "c.tsv"), sources, ids).collect()}


HEAD = "source1_entity_id\tmatched_entity_ids\n"


@pytest.mark.parametrize(
    ("body", "ids", "rules"),
    [
        (HEAD + "S1-a\tS2-a\nS1-b\t\n", True, set()),
        ("", False, {"matches: empty"}),
        ("a,b\n", False, {"matches: header has commas, no tab"}),
        ("a\tb\n", False, {"matches: header"}),
        (HEAD + "S1-a\tS2-a\nS1-b\t\nrubbish\n", False, {"no tab"}),
        (HEAD + "S1-a\tS2-a\nS1-a\tS2-a\nS1-b\t\n", False, {"duplicate query row"}),
        (HEAD + "S1-a\tS2-a,S2-a\nS1-b\t\n", False, {"repeated id in a list"}),
        (HEAD + "S1-a\tS1-a\nS1-b\t\n", False, {"query id in a list", "matches not among candidates"}),
        (HEAD + "S1-a\tQ-a\nS1-b\t\n", False, {"id of no source", "matches not among candidates"}),
        (HEAD + "S1-a\tS2-q\nS1-b\t\n", True, {"id not in the sources", "matches not among candidates"}),
        (HEAD + "S1-a\tS2-a\n", False, {"missing query row"}),
        (HEAD + "S1-a\tS2-a\nS1-b\t\nS1-c\t\n", False, {"unknown query row"}),
        (HEAD.encode() + b"S1-a\t\xff\xfe\n", False, {"matches: not UTF-8"}),
    ],
)
def test_each_rule_alone(spark, tmp_path, body, ids, rules):
    assert set(check(spark, tmp_path, body, ids=ids)) == rules


def test_missing_files(spark, tmp_path):
    check(spark, tmp_path, HEAD + "S1-a\tS2-a\nS1-b\t\n")
    sources = [str(tmp_path / f"s{k}.tsv") for k in (1, 2, 3)]
    got = V.validate(spark, str(tmp_path / "none.tsv"), str(tmp_path / "c.tsv"), sources)
    assert not V.passed(got)
    assert V.passed(V.validate(spark, str(tmp_path / "m.tsv"), str(tmp_path / "none.tsv"), sources))


def test_model_round_trip(spark, tmp_path):
    from tessera.operators import model as M
    from tessera.operators.features import FEATURES

    rows = spark.range(200).select(F.col("id").alias("s1"), F.col("id").alias("tgt"), *[(F.pmod(F.col("id") * (i + 3), F.lit(7)) / 7).cast("float").alias(f) for i, f in enumerate(FEATURES)], (F.pmod("id", F.lit(7)) > 3).cast("int").alias("y"))
    fit = M.train(rows, rounds=3, depth=2)
    M.save(fit, str(tmp_path / "fit"), 0.4)
    back, t = M.load(spark, str(tmp_path / "fit"))
    assert t == 0.4
    assert M.predict(back, rows).select("prob").collect() == M.predict(fit, rows).select("prob").collect()


def test_stream_against_static_index(spark, tmp_path):
    from tessera.streaming.blocking import stream_candidates

    data = entities(spark, ROWS)
    n = K.normalize(data.where("src > 0"))
    stats = B.with_idf(B.capped(B.key_df(K.postings(n))), 3)
    data.where("src = 0").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(data.schema).parquet(str(tmp_path / "in"))
    q = stream_candidates(source, B.index(K.postings(n), stats), lambda df, e: df.write.mode("append").parquet(str(tmp_path / "out")), str(tmp_path / "state"))
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(0, 0), (0, 1)}


def test_registered_queries_have_oracles():
    from tessera import catalog

    rows_only = {"sample_pairs", "sampled_top", "ml_score"}
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == rows_only


def test_numbers_follow_the_file(spark, tmp_path):
    from tessera.sources.entities import numbered

    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        (tmp_path / "f.txt").write_text("".join(f"{i}\n" for i in range(2000)))
        got = numbered(spark.read.text(str(tmp_path / "f.txt")), "at")
        assert got.rdd.getNumPartitions() > 1 and got.where("cast(value as long) <> at").count() == 0 and got.count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_long_lists_are_one_file_in_order(spark, tmp_path):
    lists = spark.range(0, 5000, 1, 7).select((4999 - F.col("id")).alias("rid")).select("rid", F.concat(F.lit("S1-"), "rid").alias("source1_entity_id"), F.lit("S2-1").alias("matched_entity_ids"))
    D.write_lists(lists, str(tmp_path / "out.tsv"))
    lines = (tmp_path / "out.tsv").read_text().splitlines()
    assert lines[1:] == [f"S1-{i}\tS2-1" for i in range(5000)]
    assert not (tmp_path / "out.tsv.parts").exists()


def test_validator_command(spark, tmp_path):
    check(spark, tmp_path, HEAD + "S1-a\tS2-a\nS1-b\t\n")
    for k in (1, 2, 3):
        (tmp_path / f"s{k}.tsv").rename(tmp_path / f"test_source{k}.tsv")
    run = lambda m: V.main(["-m", m, "-c", str(tmp_path / "c.tsv"), "-t", str(tmp_path), "--check-ids"])
    assert run(str(tmp_path / "m.tsv")) == 0
    assert run(str(tmp_path / "none.tsv")) == 1
    assert V.main(["-m", str(tmp_path / "m.tsv"), "-t", str(tmp_path / "nowhere")]) == 1


def test_missing_keys_count_as_zero(spark):
    from tessera.operators import calibrate as C

    keys = spark.createDataFrame([(1, "name_tok", "a"), (1, "name_tok", "b")], "s1 long, key_type string, key string")
    stats = spark.createDataFrame([("name_tok", "a", 3)], "key_type string, key string, df long")
    assert {(r["key"], r["df"]) for r in C.df_lookup(keys, stats).collect()} == {("a", 3), ("b", 0)}


def test_stored_tables(spark, tmp_path):
    n = K.normalize(entities(spark, ROWS)).where("src > 0")
    p = K.postings(n)
    assert B.save_table(B.key_df(p), str(tmp_path / "df"), *B.KEY).count() == B.key_df(p).count()
    loose = B.loose_index(p, str(tmp_path / "index"))
    assert loose.count() == p.count() and "df" in loose.columns


def test_whole_resolution(spark, tmp_path):
    """Full-width names meet plain ones; a second run takes the stored model."""
    from tessera.plans.resolution import resolve

    wide = lambda s: "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in s)
    words = ["alder", "birch", "cedar", "dogwood", "elder", "fir", "gum", "hazel"]
    for split in ("train", "test"):
        names = [f"{words[i % 8]} {words[i // 8 % 8]} works {i}" for i in range(60)]
        rows = lambda k, f: "entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join(f"S{k}-{i}\t{f(n)}\t{i} {n.split()[0]} st\tUS\n" for i, n in enumerate(names))
        for k, f in ((1, str), (2, wide), (3, str.upper)):
            (tmp_path / f"{split}_source{k}.tsv").write_text(rows(k, f))
    (tmp_path / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\tS2-{i},S3-{i}\n" for i in range(60)))
    out = [str(tmp_path), str(tmp_path / "cache"), str(tmp_path / "out")]
    t = resolve(spark, *out, rounds=2, depth=2, least=1)
    lines = (tmp_path / "out" / "matching_results.tsv").read_text().splitlines()
    assert len(lines) == 61
    assert sum(set(x.split("\t")[1].split(",")) >= {f"S2-{i}", f"S3-{i}"} for i, x in enumerate(lines[1:])) >= 55
    assert resolve(spark, *out, skip_cv=True) == t


def test_one_aggregation_gives_the_union(spark):
    n = K.normalize(entities(spark, ROWS + [(i, i % 3, False, f"S{i % 3 + 1}-{i}", f"alpha works {'ltd' if i % 2 else 'tools'} {i % 5}", f"{i % 4} main street", "US") for i in range(10, 60)]))
    s1, tgt = n.where("src = 0"), n.where("src > 0")
    q, t = K.postings(s1), K.postings(tgt)
    probed = B.probe(q, B.index(t, B.with_idf(B.capped(B.key_df(t)), tgt)))
    for m in (1, 3, 40):
        want = B.exact_pairs(probed).union(B.top_m(B.token_scores(probed), m).select("s1", "tgt")).distinct()
        assert sorted(map(tuple, B.block(q, t, tgt, m).collect())) == sorted(map(tuple, want.collect()))


def test_package_can_be_shipped():
    import zipfile

    from tessera.session import packed

    names = zipfile.ZipFile(packed()).namelist()
    assert "tessera/session.py" in names and all(n.endswith(".py") for n in names)


def test_out_of_fold_scores_every_row(spark):
    from tessera.operators import model as M
    from tessera.operators.features import FEATURES

    rows = spark.range(120).select((F.col("id") % 30).alias("s1"), F.col("id").alias("tgt"), *[(F.pmod(F.col("id") * (i + 3), F.lit(7)) / 7).cast("float").alias(f) for i, f in enumerate(FEATURES)], (F.pmod("id", F.lit(7)) > 3).cast("int").alias("y"))
    rows = rows.withColumn("fold", (F.col("s1") % 3).cast("int"))
    got = M.out_of_fold(rows, 3, rounds=2, depth=2, least=1)
    assert got.count() == 120 and got.where("prob < 0 or prob > 1").count() == 0
    alone = M.predict(M.train(rows.where("fold <> 1"), 2, depth=2, least=1), rows.where("fold = 1"))
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, got.join(rows.where("fold = 1").select("s1", "tgt"), ["s1", "tgt"]).collect()))


def test_role_cache_missing_columns_and_stages(spark, tmp_path):
    from tessera.plans.resolution import staged
    from tessera.sources.entities import load_role, save_role

    (tmp_path / "x.tsv").write_text("entity_id\tcountry\nS1-a\tUS\n")
    one = read_tsv(spark, str(tmp_path / "x.tsv")).first()
    assert (one["rid"], one["business_name"], one["business_address"], one["country"]) == (0, "", "", "US")
    n = K.normalize(entities(spark, ROWS))
    save_role(n, str(tmp_path / "role"))
    assert load_role(spark, str(tmp_path / "role")).count() == 5
    assert "name" not in load_role(spark, str(tmp_path / "role"), with_text=False).columns
    made = []
    for config in ({"a": 1}, {"a": 1}, {"a": 2}):
        staged(lambda: made.append(1) or n, spark, str(tmp_path / "stage"), config)
    assert len(made) == 2


def test_sample_is_of_the_rows_and_fixed(spark):
    from tessera.operators import calibrate as C

    rows = spark.range(500).withColumnRenamed("id", "s1")
    a, b = ({r["s1"] for r in C.sampled(rows.repartition(k), 15, "s1").collect()} for k in (1, 5))
    assert a == b and len(a) == 15 and a <= set(range(500))
    top = C.sampled_top(spark.createDataFrame([(i, j, float(j % 7)) for i in range(9) for j in range(3 * i)], "s1 long, tgt long, w double"), 4, 3, 10).collect()
    assert len(top) == 12 and len({r["s1"] for r in top}) == 4 and {r["w"] for r in top} == {6.0, 5.0}.union(r["w"] for r in top) and min(r["s1"] for r in top) >= 4


def test_pairs_of_the_first_rows(spark):
    from tessera.operators import calibrate as C

    s1 = spark.range(6).withColumnRenamed("id", "rid")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (4, 1)], "s1 long, tgt long")
    assert tuple(C.pairs_per_row(pairs, s1, first=3).first()) == (3, 2, 2 / 3)
    assert tuple(C.local_recall(pairs, spark.createDataFrame([(0, 1), (1, 1), (5, 5)], "s1 long, tgt long"), 3).first()) == (2, 1, 0.5, 2, 2 / 3)
