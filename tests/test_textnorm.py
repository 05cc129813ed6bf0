import pytest
from pyspark.sql import functions as F

from tessera.functions import textnorm as N


def one(spark, build, *values):
    row = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(build(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Café & Co._Ltd", "cafe and co ltd"), (None, ""), ("", ""), ("  A\t B  ", "a b"), ("Straße", "strasse"), ("Ærø þing", "aero thing")],
)
def test_norm_text(spark, raw, want):
    assert one(spark, N.norm_text, raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("St Johns Rd, New York", "st johns road ny"), ("5 Main St null Suite 2", "5 main street apt 2"), ("1 Elm Connecticut", "1 elm court"), ("9 A Ave West Virginia", "9 a avenue wv"), (None, "")],
)
def test_norm_addr(spark, raw, want):
    assert one(spark, N.norm_addr, raw) == want


def test_signatures_and_numbers(spark):
    assert one(spark, N.name_sig, "zeta alpha ltd") == "alpha zeta"
    assert one(spark, N.name_sig, "pvt ltd") == ""
    assert one(spark, N.house, "12b main street 94107") == "12b"
    assert one(spark, N.house, "main street 94107") == "94107"
    assert one(spark, N.house_norm, "007") == "7"
    assert one(spark, N.house_norm, "000") == ""
    assert one(spark, N.postal, "12345 x 560001") == "12345"
    assert one(spark, N.postal_six_first, "12345 x 560001") == "560001"
    assert one(spark, lambda c: N.norm_text(c, full_unicode=True), "ﬁne Ⅷ ẞ") == "fine viii ss"


def test_folds(spark):
    got = [r[0] for r in spark.range(10).orderBy("id").select(N.fold_of(F.col("id"), 20)).collect()]
    assert got == [0, 4, 1, 6, 2, 19, 4, 1, 5, 2]


def test_packing(spark):
    a, b = N.unpack_pair(N.pack_pair(F.lit(7).cast("long"), F.lit(9).cast("long")))
    assert tuple(spark.range(1).select(a, b).first()) == (7, 9)


def test_fixed_tables():
    assert len(N.LEGAL_TOKENS) == 60
    assert len(N.US_STATES) == 51
    assert len(N.STREET) == 23
