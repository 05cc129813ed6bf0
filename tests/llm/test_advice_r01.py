"""Cases of the review's first round."""

import numpy as np

import corpus_pipeline
from tessera.llm import chat_tree, decontaminate, toxicity
from tessera.llm import textbatch as tb
from tests.llm.test_operators import decoded, words


def raw_of(texts):
    return tb.text_bytes(tb.pa.array(texts))


def one_letter(text, share, rng):
    """One letter changed in that share of the words."""
    out = text.split()
    for i in rng.choice(len(out), round(share * len(out)), replace=False).tolist():
        at = int(rng.integers(0, len(out[i])))
        out[i] = out[i][:at] + ("q" if out[i][at] != "q" else "z") + out[i][at + 1 :]
    return " ".join(out)


def test_scattered_letter_edits_are_found():
    rng = np.random.default_rng(3)
    for n in (8, 15, 20, 40):
        for share in (0.4, 0.6, 1.0):
            items = [words(n, 1000 * n + t) for t in range(60)]
            docs = [words(30, 7 * t + 1) + " " + one_letter(x, share, rng) + " " + words(30, 7 * t + 2) for t, x in enumerate(items)]
            index = decontaminate.Index(list(range(60)), items)
            found = index.search(*raw_of(docs))
            assert len({(r, i) for r, i, *_ in found if r == i}) >= 57, (n, share)
            assert all(first == 30 and d == round(share * n) for r, i, first, _, d in found if r == i and d == round(share * n))


def brute(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row, best = new, min(best, new[-1])
    return best


def test_edit_distance_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = ("".join("abc"[c] for c in rng.integers(0, 3, int(rng.integers(lo, 80)))) for lo in (1, 0))
        assert decontaminate.edit_distance_within(*(np.array([ord(c) for c in x], np.int32) for x in (a, b))) == brute(a, b)


def test_short_items_are_found_in_longer_text():
    rng = np.random.default_rng(9)
    for n, edited in ((5, 0), (6, 0), (8, 2), (10, 2)):
        items = [words(n, 5000 * n + t) for t in range(100)]
        docs = []
        for t, x in enumerate(items):
            w = x.split()
            for i in rng.choice(n, edited, replace=False).tolist():
                w[i] = "other" if i % 2 else "thing"
            docs.append(" ".join([words(40, 9 * t + 1), *w, words(40, 9 * t + 2)]))
        found = decontaminate.Index(list(range(100)), items).search(*raw_of(docs))
        near = sum(brute(x, y) <= decontaminate.allowed(len(x)) for x, y in zip(items, docs, strict=True)) if edited else 100
        hit = len({r for r, i, *_ in found if r == i})
        assert hit == 100 if not edited else hit >= 0.95 * near, (n, hit, near)


def test_simulated_recall_is_reached_at_every_length():
    for m in (*range(1, 130, 7), 238, 394, 1000):
        walk, times, least = decontaminate.plan(m)
        k = decontaminate.allowed(m)
        if walk[1]:
            fresh = sum(decontaminate.survivors(m, k, walk, draw, seed=m + 100) for draw in range(times))
            assert (np.mean(fresh >= least, axis=1) >= 0.93).all(), m
        else:
            assert k == 0 or walk[0] <= max(1, m // (k + 1))


def test_items_of_few_words_without_spaces_or_id(spark):
    chinese = "人工智能是计算机科学的一个分支它企图了解智能的实质"
    bench = spark.createDataFrame([(1, chinese), (2, "forty two"), (None, "an item that has no id at all"), (4, " "), (5, None), (6, "")], "item_id long, text string")
    edited = chinese[:7] + "很" + chinese[8:]
    rows = [(0, "前面的话" + chinese + "后面的话"), (1, "前面" + edited), (2, "the answer is Forty\ntwo."), (3, "here: an item that has no id at all"), (4, "clean text"), (5, " "), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {(0, 1), (1, 1), (2, 2), (3, None)}
    assert sorted(r["doc_id"] for r in decontaminate.clean_documents(docs, bench).collect()) == [4, 5, 6]


def test_unlike_documents_without_or_under_one_id_stay(spark):
    texts = [(None, words(40, 1)), (None, words(40, 2)), (None, words(40, 3)), (7, words(40, 4)), (7, words(40, 5)), (8, words(40, 1)), (9, words(40, 9)), (10, words(40, 9) + " more"), (11, ""), (12, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = [r["text"] for r in corpus_pipeline.keep_one_of_near(spark, docs, "").collect()]
    assert sorted(x for x in got if x) == sorted([*(words(40, i) for i in (1, 2, 3, 4, 5)), words(40, 9)])
    assert len(got) == 8


def test_documents_empty_before_the_cut_stay(spark):
    same = words(100, 1)
    docs = spark.createDataFrame([(1, same), (2, same), (3, ""), (4, None), (5, words(60, 2))], "doc_id long, text string")
    left = {r["doc_id"] for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    assert {3, 4, 5} <= left and not {1, 2} <= left


def test_small_marginals_do_not_add_up():
    p, row = np.append(np.full(20_000, 0.01), [0.3, 0.9]), np.append(np.zeros(20_000, int), [1, 1])
    total = np.exp(toxicity._summary(p, row, 2)[:, 2]) - 1e-3
    assert np.allclose(total, [0, 1.2])


def test_a_long_shared_start_is_packed_once(spark):
    start = words(100, 1)
    turns = [(c, t, "user", start if t == 0 else f"own {c}") for c in range(20) for t in (0, 1)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").coalesce(1)
    packs = chat_tree.pack_conversations(df, pack_tokens=100)
    texts = [decoded(r["tokens"]) for r in packs.collect()]
    # a pack is filled by the first conversation with the start only, then by what the others add
    assert sum(x.count(start) for x in texts) <= 2 * len({r["pack"].split("-")[0] for r in packs.collect()}) + 1
    back = chat_tree.read_back(chat_tree.conversations(packs)).collect()
    assert sorted(r["conv_id"] for r in back) == list(range(20))


def test_ml_score_trains_the_whole_model(spark, monkeypatch):
    from tessera import catalog
    from tessera.operators import model

    seen = {}
    monkeypatch.setattr(model, "train", lambda rows, **settings: seen.update(settings))
    monkeypatch.setattr(model, "predict", lambda fit, rows: rows)
    catalog.queries()["ml_score"](spark, "/root/testdata/sf0.001")
    assert not seen.keys() & {"rounds", "rate", "depth", "least"}
