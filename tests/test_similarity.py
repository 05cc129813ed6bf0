from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions import similarity as S

text = st.text(alphabet="abc d", max_size=14)


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(text, text)
def test_ratio_is_lcs_ratio(a, b):
    want = float(a == b) if not a or not b else 2 * brute_lcs(a, b) / (len(a) + len(b))
    assert abs(S.ratio(a, b) - want) < 1e-12


@settings(max_examples=150, deadline=None)
@given(text, text)
def test_ranges_and_symmetry(a, b):
    for f in (S.ratio, S.token_sort, S.token_set, S.partial, S.jaro_winkler):
        assert 0 <= f(a, b) <= 1
    assert S.ratio(a, b) == S.ratio(b, a)
    assert S.token_sort(a, b) == S.token_sort(b, a)


def brute_partial(a, b):
    if not a or not b:
        return float(a == b)
    ratio = lambda x, y: 2 * brute_lcs(x, y) / (len(x) + len(y))
    return max(ratio(s, t[max(i, 0) : max(i, 0) + len(s) + min(i, 0)]) for s, t in ((a, b), (b, a)) if len(s) <= len(t) for i in range(1 - len(s), len(t)))


def brute_token_set(a, b):
    if not a or not b:
        return float(a == b)
    x, y = set(a.split()), set(b.split())
    both = sorted(x & y)
    if both and (x <= y or y <= x):
        return 1.0
    ratio = lambda p, q: 2 * brute_lcs(p, q) / (len(p) + len(q)) if p and q else float(p == q)
    one, two = (" ".join(both + sorted(s)) for s in (x - y, y - x))
    return max([ratio(one, two)] + [ratio(" ".join(both), s) for s in (one, two) if both])


@settings(max_examples=150, deadline=None)
@given(text, text)
def test_partial_and_tokens_equal_brute_force(a, b):
    assert abs(S.partial(a, b) - brute_partial(a, b)) < 1e-12
    assert abs(S.token_set(a, b) - brute_token_set(a, b)) < 1e-12
    x, y = (" ".join(sorted(s.split())) for s in (a, b))
    assert abs(S.token_sort(a, b) - (2 * brute_lcs(x, y) / (len(x) + len(y)) if x and y else float(x == y))) < 1e-12


MANY = {"ratio": S.ratio_many, "token_sort": S.token_sort_many, "token_set": S.token_set_many, "partial": S.partial_many, "jaro_winkler": S.jaro_winkler_many}
long = st.text(alphabet="abcé d日", max_size=150)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.one_of(text, long), st.one_of(text, long)), max_size=12))
def test_many_pairs_at_once_equal_one_by_one(pairs):
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    for name, many in MANY.items():
        got = many(a, b)
        assert len(got) == len(pairs)
        for x, y, v in zip(a, b, got, strict=True):
            assert abs(v - getattr(S, name)(x, y)) < 1e-9, (name, x, y)


def test_columns_with_nulls(spark):
    rows = spark.createDataFrame([("ab", "abc"), (None, "x"), (None, None), ("ab", "abc")], "a string, b string")
    got = [r[0] for r in rows.select(S.ratio_column(rows.a, rows.b)).collect()]
    assert got == [0.8, 0.0, 1.0, 0.8]


def test_known_values():
    assert S.ratio("", "") == 1.0
    assert S.ratio("a", "") == 0.0
    assert S.token_set("a b", "b a c") == 1.0
    assert S.partial("abc", "xxabcxx") == 1.0
    assert abs(S.jaro_winkler("martha", "marhta") - 0.9611111) < 1e-6
    assert abs(S.jaro_winkler("dixon", "dicksonx") - 0.8133333) < 1e-6
