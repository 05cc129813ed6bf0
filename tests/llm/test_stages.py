"""Each stage of the pipeline against brute force, on nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import mixing, quality, storage
from tessera.llm import decontaminate as D
from tessera.llm import textbatch as tb
from tests.llm.test_advice_r01 import brute
from tests.llm.test_operators import WORD, words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, p_good string, k_rid string, k_empty string, rid string, spans string, tagged string, copy string, mix_row string"
CLASHES = ["p", "k", "e", "r", "s", "t", "c", "m"]


def sentence(n, seed):
    w = words(n, seed).split()
    return " ".join(x.capitalize() + ("." if i % 7 == 6 else "") if i % 7 in (0, 6) else x for i, x in enumerate(w))


def texts():
    base, passage, item = sentence(120, 1), words(70, 2), words(20, 3)
    near = base.split()
    near[60] = "changed"
    edited = item.split()
    edited[4], edited[9] = edited[4][:-1] + "q", "x" + edited[9]
    return [
        (0, base, "a"), (1, " ".join(near), "a"), (2, base, "b"), (2, base, "b"), (3, None, None), (4, "", "c"), (5, " \n\t ", "c"), (6, "one two", "b"),
        (7, sentence(90, 4) + " " + passage + " \u00e9 " + sentence(80, 5), "a"), (8, sentence(50, 6) + " " + passage + " \u00fc " + sentence(70, 7), "a"),
        (9, sentence(6000, 8), "a"), (10, sentence(40, 9) + " " + item + " " + sentence(40, 10), "b"), (11, sentence(30, 11) + " " + " ".join(edited), "b"), (12, item, "b"),
        (None, sentence(60, 12), None), (None, sentence(60, 13), "a"), (13, "BUY!!! NOW!!! $$$ ### " * 30, "c"), (14, sentence(200, 14), "b"), (14, sentence(200, 15), "b"), (15, sentence(100, 16), None),
    ]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *CLASHES) for i, t, s in texts()], COLUMNS)


@pytest.fixture
def folder(spark, tmp_path):
    item = words(20, 3)
    rng = np.random.default_rng(0)
    spark.createDataFrame([(1, item), (2, None), (3, words(30, 99))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(rng.integers(0, 2)) if i > 9 else 1, 0) for i in range(15)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def key(r):
    return (r["doc_id"] is None, r["doc_id"] or 0, r["text"] is None, r["text"] or "")


def same_columns(out, docs):
    assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
    assert all(list(r)[5:] == CLASHES for r in out.collect())


def test_quality_stage(spark, docs, folder):
    out = corpus_pipeline.keep_good(spark, docs, folder)
    same_columns(out, docs)
    w = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet").where(~quality.held_out(F.col("doc_id"))))
    want = []
    for i, t, _ in texts():
        raw, off = tb.text_bytes(pa.array([t], pa.string()))
        if min(max((1 + float(quality.features(raw, off)[0] @ w)) / 2, 0), 1) >= 0.3:
            want.append((i, t))
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(want, key=str)
    assert corpus_pipeline.keep_good(spark, docs.limit(0), folder).count() == 0


def test_near_duplicates_stage(spark, docs, folder):
    rows = sorted({(i, t) for i, t, _ in texts()}, key=str)
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").lower())
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    groups = collections.defaultdict(list)
    for k, r in enumerate(root):
        groups[r].append(rows[k])
    out = corpus_pipeline.keep_one_of_near(spark, docs, folder)
    same_columns(out, docs)
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(got) == len(set(got)) == len(groups)
    for members in groups.values():
        least = min((i for i, _ in members), key=lambda i: (i is not None, i or 0))
        assert [x for x in got if x in members and x[0] == least], members
    assert corpus_pipeline.keep_one_of_near(spark, docs.limit(0), folder).count() == 0


def test_repeats_stage(spark, docs, folder):
    n = 200
    every = [(t or "").encode() for _, t, _ in texts()]
    seen = collections.Counter(b[p : p + n] for b in every for p in range(len(b) - n + 1))
    want = []
    for (i, t, _), b in zip(texts(), every, strict=True):
        mark = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if seen[b[p : p + n]] > 1:
                mark[p : p + n] = b"\1" * n
        parts = [b[m.start() : m.end()] for m in re.finditer(rb"\x00+", bytes(mark))]
        left = None if t is None else "".join(p.decode("utf-8", "ignore") for p in parts)
        if left or not t:
            want.append((i, left, len(left) if left is not None else None))
    out = corpus_pipeline.cut_repeats(spark, docs, folder)
    same_columns(out, docs)
    assert sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()), key=str) == sorted(want, key=str)
    assert corpus_pipeline.cut_repeats(spark, docs.limit(0), folder).count() == 0


def test_leaks_stage(spark, docs, folder):
    item = words(20, 3)
    plain = lambda t: re.sub(r"\s+", " ", (t or "").lower())
    want = [(i, t) for i, t, _ in texts() if len(t or "") > 5000 or brute(item, plain(t)) > D.allowed(len(item))]
    out = corpus_pipeline.drop_leaks(spark, docs, folder)
    same_columns(out, docs)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(want, key=str)
    assert corpus_pipeline.drop_leaks(spark, docs.limit(0), folder).count() == 0


def brute_mix(rows, seed=0):
    """(doc_id, size, source, copies) by the definition: along each source, large documents first."""
    import hashlib

    sized = [(i, len(WORD.findall(t or "")), s, t) for i, t, s in rows]
    sources = sorted({s for _, _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(sources)}
    size = {s: sum(n for _, n, x, _ in sized if x == s) for s in sources}
    target, open_, left = {}, set(sources), float(sum(size.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 3 * size[s]}
        target |= {s: 3.0 * size[s] if s in over else share * weight[s] for s in (over or open_)}
        left -= sum(3 * size[s] for s in over)
        open_ = open_ - over if over else set()
    out = []
    for s in sources:
        own = sorted((x for x in sized if x[2] == s), key=lambda x: (x[1], (x[0] or 0) % 64, x[0] is not None, x[0] or 0))
        u = int(hashlib.md5(f"{seed}:{s if s is not None else chr(0) + 'null'}".encode()).hexdigest()[:8], 16) / 2**32
        big = [x for x in own if x[1] > 0.01 * target[s]]
        small = [x for x in own if x[1] <= 0.01 * target[s]]
        e = min(target[s] / size[s], 3.0) if size[s] else 0.0
        taken = 0
        for k, x in enumerate(big):
            c = math.floor(u + (k + 1) * e) - math.floor(u + k * e)
            taken += c * x[1]
            out.append((x[0], x[1], s, c))
        rest = size[s] - sum(x[1] for x in big)
        e = min(max((target[s] - taken) / rest, 0.0), 3.0) if rest else 0.0
        out += [(x[0], x[1], s, math.floor(u + (k + 1) * e) - math.floor(u + k * e)) for k, x in enumerate(small)]
    return out


def test_mix_stage(spark, docs, folder):
    out = corpus_pipeline.mix_sources(spark, docs, folder)
    got = sorted(((r["doc_id"], r["size"], r["source"], r["copies"]) for r in out.collect()), key=str)
    assert got == sorted(brute_mix(texts()), key=str)
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), folder).count() == 0


def test_mix_of_one_hot_source_and_size(spark):
    rows = [(i if i % 3 else None, "w " * 5, "hot") for i in range(900)] + [(1000 + i, "w " * (i % 40), f"s{i % 5}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = collections.Counter((r["size"], r["source"], r["copies"]) for r in mixing.mix(docs).collect())
    assert got == collections.Counter(x[1:] for x in brute_mix(rows))


def test_mixed_documents_have_the_planned_copies(spark, docs):
    plan = collections.Counter()
    for r in mixing.mix(docs).collect():
        plan[r["doc_id"], r["size"], r["source"]] += r["copies"]
    out = mixing.mixed_documents(docs)
    assert out.columns == [*docs.columns, "copy_"]
    got = collections.Counter()
    for r in out.collect():
        assert list(r)[5:13] == CLASHES
        got[r["doc_id"], len(WORD.findall(r["text"] or "")), r["source"]] += 1
    assert +plan == got
    same = spark.createDataFrame([(1, "a b c", "s")] * 4 + [(2, "d e f g", "t")] * 3, "doc_id long, text string, source string")
    assert mixing.mixed_documents(same).count() == mixing.mix(same).agg(F.sum("copies")).first()[0]


def test_whole_pipeline_leaves_only_its_last_tables(spark):
    before = set(storage._MADE.get(spark.sparkContext.applicationId, []))
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "leaks", "mix"]
    kept = {x.rsplit("/", 1)[1].rsplit("-", 1)[0] for x in storage._MADE[spark.sparkContext.applicationId] if x not in before}
    assert kept == {"pipeline-quality", "pipeline-near_duplicates", "pipeline-repeats", "pipeline-leaks", "mix", "mix-order"}


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().get()
    assert storage.shared_dir(spark) == named.rstrip("/")

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False), "isEmpty": staticmethod(lambda: True)})())})())})()

        def getConf(self):
            return Conf()

    with pytest.raises(RuntimeError):
        storage.shared_dir(type("Session", (), {"conf": Conf(), "sparkContext": Context()})())
