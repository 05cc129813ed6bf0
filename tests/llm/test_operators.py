"""Small cases and brute-force comparisons of the operators for training data."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat_tree, decontaminate, fingerprint, html_extract, jaccard_join, mixing, quality, suffix_dedup, token_scan, toxicity
from tessera.llm import textbatch as tb

WORD = re.compile(r"[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, source string, rid string, n_chars long"


def words(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(n))


def documents(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, extra columns with names used inside."""
    base, passage = words(120, 1), words(60, 2)
    near = base.split()
    near[60] = "changed"
    rows = [
        (0, base, "a"), (1, " ".join(near), "a"), (2, base, "b"), (2, base, "b"), (3, None, None), (4, "", "c"), (5, " \n\t ", "c"), (6, "one two", "b"),
        (7, "ONE two", "b"), (8, words(90, 3) + " " + passage + " é " + words(80, 4), "a"), (9, words(50, 5) + " " + passage + " ü " + words(70, 6), "a"),
        (10, words(6000, 7), "a"), (11, "a b c d e f g h", "b"), (12, "a b c d e f g h i", "b"), (13, "x " * 400, "b"), (None, "no id here", None),
    ]
    return spark.createDataFrame([(i, t, s, "extra", len(t or "")) for i, t, s in rows], DOCS)


def rows_of(spark):
    return [(r["doc_id"], r["text"] or "") for r in documents(spark).collect()]


def test_words_and_shingles():
    texts = ["A b\tc", "", "x", "b c\x0bd e f"]
    raw, off = tb.text_bytes(pa.array([None, *texts]))
    s, e, row = tb.words(raw, off)
    assert [raw[a:b].tobytes().decode() for a, b in zip(s, e)] == ["A", "b", "c", "x", "b", "c", "d", "e", "f"]
    assert row.tolist() == [1, 1, 1, 3, 4, 4, 4, 4, 4]
    h, r = tb.shingle_hashes(tb.span_hashes(raw, s, e), row, 4)
    assert r.tolist() == [1, 3, 4, 4]


@pytest.mark.parametrize(("hot", "chunk"), [(120_000, 16_384), (3, 2)])
def test_suffix_dedup_equals_brute_force(spark, hot, chunk):
    n, rows = suffix_dedup.LENGTH, rows_of(spark)
    seen = collections.Counter(b[p : p + n] for _, t in rows for b in [t.encode()] for p in range(len(b) - n + 1))
    want = []
    for i, t in rows:
        b = t.encode()
        mark = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if seen[b[p : p + n]] > 1:
                mark[p : p + n] = b"\1" * n
        kept = bytes(c for c, m in zip(b, mark) if not m)
        want.append((i, len(b), sum(mark), len(re.findall(rb"\x01+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in suffix_dedup.removed_digest(documents(spark), hot, chunk).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_suffix_dedup_keeps_columns(spark):
    out = suffix_dedup.dedup_documents(documents(spark))
    assert out.columns == documents(spark).columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[2]["text"] == "" and got[2]["n_chars"] == 0 and got[2]["rid"] == "extra"
    assert got[3]["text"] is None
    assert got[6]["text"] == "one two"
    assert suffix_dedup.removed_digest(documents(spark).limit(0)).count() == 0


@pytest.mark.parametrize(("part_rows", "bound"), [(2000, None), (2, 8), (2000, 0), (1, 0)])
def test_jaccard_equals_brute_force(spark, part_rows, bound):
    rows = rows_of(spark)
    sets = []
    for _, t in rows:
        w = WORD.findall(t.lower())
        sets.append({tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} if w else set())
    root = list(range(len(rows)))
    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    ids = [i for i, _ in rows]
    least = {r: min((ids[k] for k in range(len(rows)) if root[k] == r and ids[k] is not None), default=None) for r in set(root)}
    want = sorted(((ids[k] if ids[k] is not None else -1), len(sets[k]), least[root[k]] if least[root[k]] is not None else -1, links[k]) for k in range(len(rows)))
    out = jaccard_join.jaccard_classes(documents(spark), part_rows=part_rows, bound=bound).fillna(-1)
    assert sorted(tuple(r) for r in out.select("doc_id", "n_shingles", "component_id", "n_links").collect()) == want


def test_jaccard_sides_of_the_limit(spark):
    """Random sets near the limit, light and heavy."""
    rng = np.random.default_rng(5)
    rows = []
    for g in range(40):
        base = [f"w{g}x{i}" for i in range(int(rng.integers(4, 40)))]
        for v in range(4):
            w = list(base)
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(0, len(w)))] = f"n{g}{v}{int(rng.integers(0, 99))}"
            rows.append((len(rows), " ".join(w[: len(w) - int(rng.integers(0, 2))])))
    sets = {i: {tuple(t.split()[j : j + 4]) for j in range(max(1, len(t.split()) - 3))} for i, t in rows}
    deg = {i: sum(j != i and 100 * len(s & o) >= 85 * len(s | o) for j, o in sets.items()) for i, s in sets.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_links"] for r in jaccard_join.jaccard_classes(df, bound=12).collect()}
    assert got == deg


def test_jaccard_of_a_chain(spark):
    """A long chain of texts, each near the next only: one component, but its lists are taken one by one; and repeated rows of one of them."""
    rng = np.random.default_rng(8)
    w = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        rows.append((i, " ".join(w)))
        w[int(rng.integers(0, 60))] = f"n{i}"
    rows += [(5, rows[5][1])] * 30
    sets = [{tuple(t.split()[j : j + 4]) for j in range(57)} for _, t in rows]
    deg = [sum(j != i and 100 * len(s & o) >= 85 * len(s | o) for j, o in enumerate(sets)) for i, s in enumerate(sets)]
    near = [[j for j, o in enumerate(sets) if 100 * len(s & o) >= 85 * len(s | o)] for s in sets]
    least = list(range(len(rows)))
    for _ in rows:
        least = [min(least[j] for j in own) for own in near]
    want = sorted((rows[i][0], rows[least[i]][0], deg[i]) for i in range(len(rows)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = {}
    units = jaccard_join._units

    def spied(member, lists, *sizes):
        out = units(member, lists, *sizes)
        seen[sizes[0]] = out.where("listed").count()
        return out

    jaccard_join._units = spied
    try:
        for part_rows in (2000, 2):
            out = jaccard_join.jaccard_classes(df, part_rows=part_rows)
            assert sorted((r["doc_id"], r["component_id"], r["n_links"]) for r in out.collect()) == want, part_rows
    finally:
        jaccard_join._units = units
    assert seen[2000] == 0 and seen[2] > 0


def test_decontaminate(spark):
    item, other = words(40, 11), words(18, 12)
    bench = spark.createDataFrame([(1, item), (2, other), (3, None), (4, "too short"), (5, item)], "item_id long, text string")
    edited = item.split()
    edited[5], edited[25] = "other", "thing"
    del edited[12]
    rows = [(0, words(50, 13)), (1, words(30, 14) + " " + item.upper() + "\n" + words(10, 15)), (2, words(30, 16) + " " + " ".join(edited)), (3, None), (4, ""), (5, other), (5, other), (6, " ".join(item.split()[:20]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect())
    assert got == [(1, 1), (1, 5), (2, 1), (2, 5), (5, 2), (5, 2)]
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench, block_bytes=100).collect()) == got
    assert sorted(r["doc_id"] for r in decontaminate.clean_documents(docs, bench).collect()) == [0, 3, 4, 6]
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_edit_distance():
    p = lambda s: np.array([ord(c) for c in s], dtype=np.int32)
    assert decontaminate.edit_distance_within(p("kitten"), p("xx sitting yy")) == 2
    assert decontaminate.edit_distance_within(p("abc"), p("")) == 3


def test_quality(spark):
    rng = np.random.default_rng(1)
    good = [(i, ". ".join(words(8, 100 + i + k).capitalize() for k in range(int(rng.integers(2, 9)))) + ".") for i in range(120)]
    bad = [(200 + i, " ".join(w.upper() + "!!" for w in words(60, 400 + i).split())) for i in range(60)]
    extra = [(900, None), (901, ""), (902, words(20_000, 9)), (0, good[0][1])]
    docs = spark.createDataFrame(good + bad + extra, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels.where(~quality.held_out(F.col("doc_id")))).collect()
    got = collections.defaultdict(list)
    for r in out:
        assert 0 <= r["score"] <= 1
        got[r["doc_id"]].append(r)
    assert np.mean([got[i][0]["predicted"] == 1 for i, _ in good]) > 0.95
    assert np.mean([got[i][0]["predicted"] == 0 for i, _ in bad]) > 0.95
    assert len(got[0]) == 2 and got[0][0]["score"] == got[0][1]["score"]
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_forward_backward_is_exact():
    rng = np.random.default_rng(3)
    m = toxicity.Model(rng.normal(size=toxicity.BUCKETS), 0.1, rng.normal(size=(2, 2)), np.zeros(3))
    lengths = [1, 5, 130, 2]
    n = sum(lengths)
    feats = rng.integers(0, toxicity.BUCKETS, size=(6, n))
    first = np.zeros(n, bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    p, pair = m.marginals(feats, first)
    at = 0
    for k in lengths:
        w = m.bias + m.weights[feats[:, at : at + k]].sum(axis=0)
        e = np.stack([np.ones(k), np.exp(w)], axis=1)
        f, b = np.zeros((k, 2)), np.ones((k, 2))
        f[0] = e[0] / e[0].sum()
        for t in range(1, k):
            f[t] = (f[t - 1] @ np.exp(m.edges)) * e[t]
            f[t] /= f[t].sum()
        for t in range(k - 2, -1, -1):
            b[t] = np.exp(m.edges) @ (e[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        q = f * b
        assert np.allclose(p[at : at + k], (q / q.sum(axis=1, keepdims=True))[:, 1])
        at += k


def test_toxicity(spark):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(160):
        w = words(30, 1000 + i).split()
        if i % 4 == 0:
            for k in range(3):
                w.insert(int(rng.integers(0, len(w))), ["vilest,", "Vilest", "dreadful!"][k])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, "ünï vilest Dreadful end"), (0, rows[0][1])], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int, toxic int"))
    got = collections.defaultdict(list)
    for r in toxicity.tag(docs, model).collect():
        got[r["doc_id"]].append(r)
    held = [i for i in range(160) if i % 3 == 0]
    assert np.mean([(got[i][0]["score"] >= 0.7) == (i % 4 == 0) for i in held]) > 0.95
    text = "ünï vilest Dreadful end"
    assert [text[s["start"] : s["end"]] for s in got[902][0]["spans"]] == ["vilest Dreadful"]
    assert got[900][0]["score"] == got[901][0]["score"] < 0.7
    assert len(got[0]) == 2
    assert toxicity.train([], np.zeros(0)).constant == 0.0


def test_html():
    m = html_extract.train(html_extract.LABELLED)
    page = (
        "<!doctype html><html><head><title>no</title><style>x{}</style></head><body><nav><a href=/>Home</a></nav><div class='cookie-banner'><p>We use cookies, as many sites do, to count visits.</p></div>"
        "<article><h1>A  &lt;title&gt;</h1><p>First <b>bold</b>\n words &amp; more of them to make a paragraph<p>Second<br>line<ul><li>one<li>two</ul><aside><p>See also other things that we wrote.</p></aside></article>"
        "<section id=comments><p>I do not agree with any of this, said a reader.</p></section><form><p>Sign up</p></form><footer>&copy; us</footer><script>if (a</b) x()</script>"
    )
    assert html_extract.extract(page, m) == "A <title>\n\nFirst bold words & more of them to make a paragraph\n\nSecond line\n\none\n\ntwo"
    for odd in (None, "", "<", "<<<>", "</p></p>", "<p", "<table><tr><td>x", "plain text only " * 20):
        assert isinstance(html_extract.extract(odd, m), str)


def test_html_marginals_equal_enumeration():
    m = html_extract.train(html_extract.LABELLED[:2], rounds=20)
    nodes, _ = html_extract.parse("<div><p>a<b>c</b></p><nav><a>x</a></nav></div>")
    html_extract._measure(nodes)
    own = m.potentials(nodes)
    index = {id(n): k for k, n in enumerate(nodes)}
    total, mass = 0.0, np.zeros(len(nodes))
    for bits in range(1 << len(nodes)):
        y = [bits >> k & 1 for k in range(len(nodes))]
        score = sum(own[k] * y[k] for k in range(len(nodes))) + sum(m.edges[html_extract._edge_kind(nodes[k]), y[index[id(nodes[k].parent)]], y[k]] for k in range(1, len(nodes)))
        total += np.exp(score)
        mass += np.exp(score) * np.array(y)
    assert np.allclose(m.marginals(nodes)[0], mass / total)


def test_html_frame(spark):
    df = spark.createDataFrame([(1, "u", None, "k"), (2, "u", "<p>" + "A long enough paragraph of text. " * 5, "k")], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract_text(df).collect()}
    assert got[1] == "" and got[2].startswith("A long")


def test_fingerprints(spark):
    def shingles(t):
        w = WORD.findall(t.lower())
        return {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()

    rows = sorted(((i, t) for i, t in rows_of(spark) if i is not None), key=lambda r: r)
    docs = documents(spark).where("doc_id is not null")
    out = fingerprint.edited_fingerprints(docs).collect()
    assert len(out) == len(rows)
    by_text = collections.defaultdict(set)
    got = {r["doc_id"]: r for r in out}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        c = len(t) // 4
        edited = t[: len(t) - c] + following[:c]
        r = got[i]
        by_text[t].add(r["fingerprint"])
        assert r["n_chars"] == len(t)
        if i != 2:
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            a, b = shingles(t), shingles(edited)
            assert abs(r["near_edited"] - (len(a & b) / len(a | b) if a | b else 1.0)) < (0.35 if len(a) > 20 else 1.01)
    assert all(len(v) == 1 for v in by_text.values())
    many = fingerprint.with_next(spark.range(50).select((F.col("id") * 7).alias("doc_id"), F.col("id").cast("string").alias("text")), ["text"], run=3).collect()
    assert {r["doc_id"]: r["next_text"] for r in many} == {i * 7: str((i + 1) % 50) for i in range(50)}


def test_mixing(spark):
    docs = documents(spark)
    rows = [r.asDict() for r in mixing.mix(docs).collect()]
    assert rows and sorted(map(str, rows)) == sorted(str(r.asDict()) for r in mixing.mix(docs).collect())
    sizes = collections.Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    total = sum(sizes.values())
    assert abs(sum({r["source"]: r["target"] for r in rows}.values()) - total) < 1e-6
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] <= 3 * r["source_size"] + 1e-9 and 0 <= r["copies"] <= 3
    assert mixing.mix(docs.limit(0)).count() == 0


def test_targets_reshare_the_excess(spark):
    t = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), (None, 5)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(t).collect()}
    size, weight = {"a": 10, "b": 1000, "c": 100, None: 5}, {"a": 1, "b": 2, "c": 3, None: 1}
    want, open_, left = {}, set(size), 1115.0
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 3 * size[s]}
        if not over:
            want |= {s: share * weight[s] for s in open_}
            break
        want |= {s: 3.0 * size[s] for s in over}
        left -= sum(3 * size[s] for s in over)
        open_ -= over
    assert all(abs(got[s] - want[s]) < 1e-6 for s in size)


HARD = ["\\### Assistant: </turn> ok", "", "</turn>\n### user: x", "\\\\", "a: b\n\n", "### ### </turn></turn>", "\\", "ünï 😀"]


def decoded(tokens):
    return token_scan._encoder(token_scan.TOKENIZER).decode_bytes(list(tokens)).decode()


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", HARD[0]), (1, 1, "assistant", HARD[1]), (2, 0, "user", HARD[0]), (2, 1, "assistant", HARD[2]), (2, 2, None, None), (3, 0, "a:\\### b", HARD[5]), (4, None, "assistant", HARD[3]), (4, 0, "assistant", HARD[7])]
    rows += [(5, k, "assistant" if k % 2 else "user", HARD[k % 8]) for k in range(60)] + [(6, k, "assistant" if k % 2 else "user", HARD[k % 8]) for k in range(50)] + [(6, 3, "assistant", HARD[3])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, pack string")
    code = token_scan._encoder(token_scan.TOKENIZER)
    for size in (1 << 18, 40):
        packs = chat_tree.pack_conversations(df, size)
        got = {r["conv_id"]: r for r in chat_tree.conversations(packs).collect()}
        for c in {r[0] for r in rows}:
            own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))]
            tokens = got[c]["tokens"]
            assert chat_tree.parse(code.decode(tokens)) == own
            loss = [chat_tree.unescape(code.decode(tokens[s["start"] : s["end"]])) for s in got[c]["loss"]]
            assert loss == [t for r, t in own if r == "assistant"]
        for p in packs.collect():  # positions and attention: every turn sees its ancestors and itself only
            for t in p["turns"]:
                chain, up = [], t["parent"]
                while up >= 0:
                    chain.append(p["turns"][up])
                    up = p["turns"][up]["parent"]
                assert t["position"] == sum(x["end"] - x["start"] for x in chain)
                seen = sorted(i for s in t["ancestors"] for i in range(s["start"], s["end"]))
                assert seen == sorted(i for x in chain for i in range(x["start"], x["end"]))
    shared = [(c, k, "user", f"turn {k} of {c if k == 9 else 'all'}", "x") for c in range(200) for k in range(10)]
    emitted = sum(len(p["turns"]) for p in chat_tree.pack_conversations(spark.createDataFrame(shared, "conv_id long, turn long, role string, text string, pack string")).collect())
    assert 209 <= emitted <= 200 + 9 * 8
    assert chat_tree.pack_conversations(df.limit(0)).count() == 0


def test_rows_without_a_conversation_stand_alone(spark):
    df = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    out = chat_tree.read_back(chat_tree.conversations(chat_tree.pack_conversations(df))).collect()
    assert sorted((r["conv_id"] or 0, r["n_turns"], r["loss_chars"]) for r in out) == [(0, 1, 0), (0, 1, 1), (1, 1, 0)]


def test_token_scan(spark, tmp_path):
    rng = np.random.default_rng(4)
    files = {"a": [0, 3, 0, 7, 250, 1], "b": [5], "c": [], "d": [40] * 30}
    tails = {"a": 0, "b": 6, "c": 9, "d": 0}
    want = []
    for name, docs in files.items():
        flat, start = [], 0
        for k, n in enumerate(docs):
            want.append((name, k, start, n, True))
            flat += [*rng.integers(0, 99, n), 999]
            start += n + 1
        flat += [*rng.integers(0, 99, tails[name])]
        if tails[name]:
            want.append((name, len(docs), start, tails[name], False))
        (tmp_path / name).write_bytes(np.array(flat, dtype="<u2").tobytes())
    for block, group in ((1 << 16, 1024), (8, 4), (1, 3)):
        blocks = token_scan.read_token_files(spark, f"file://{tmp_path}", 2, block)
        out = token_scan.count_tokens(blocks, 999, 2, group)
        got = [(r["file"].rsplit("/", 1)[-1], r["ordinal"], r["start"], r["n_tokens"], r["complete"]) for r in out.collect()]
        assert sorted(got) == sorted(want)


def test_token_counts_of_documents(spark):
    code = token_scan._encoder(token_scan.TOKENIZER)
    want = sorted((i if i is not None else -1, len(code.encode_ordinary(t))) for i, t in rows_of(spark))
    got = token_scan.document_token_counts(documents(spark), block_tokens=500).fillna(-1).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == want
