"""Document fingerprints: a threshold-scaled sketch, by DataFrame functions only.

A text's sketch keeps every hash of its word shingles that is below a fixed fraction of the hash range, whatever the
length of the text. Sketches of one fraction merge by union, and estimate Jaccard likeness and containment of texts of
very unequal length. A fingerprint is printed as the number of shingles, a checksum of all of their hashes, and
the kept hashes in order (hexadecimal), so equal texts have equal fingerprints. The checksum tells whether two
sets are the same where no hash is kept.

Shingles are runs of ``WORDS`` words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; a text with fewer words gives one shingle, its
whole sequence; one without words gives none. Nulls are empty. Two fingerprints without shingles are alike (1), one without is
unlike any other (0). Repeated rows have equal fingerprints; an empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 5
#: Kept share of the hash range.
FRACTION = 0.25
#: Rows of the table that stand next to each other in one window of ``edited_fingerprints``.
RUN = 2000
MOST_RUNS = 200_000

_SPACES = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, _SPACES), lambda w: w != "")


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once: higher-order functions would work it out again for each element."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Distinct 64-bit hashes of the shingles."""

    def shingles(h: Column) -> Column:
        n = F.size(h)
        full = F.transform(F.slice(h, 1, F.greatest(n - (words - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, words)]))
        return F.array_distinct(F.when(n >= words, full).when(n > 0, F.array(F.xxhash64(F.array_join(h.cast("array<string>"), " ")))).otherwise(F.array().cast("array<bigint>")))

    return _let(F.transform(_words(text), lambda w: F.xxhash64(w)), shingles)


def sketch(text: Column, fraction: float = FRACTION, words: int = WORDS) -> Column:
    """struct(n shingles, checksum, kept hashes in order)."""
    bound = int(-(2**63) + fraction * 2**64)
    checksum = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s.bitwiseXOR(F.xxhash64(x)))  # noqa: E731  a sum would overflow
    return _let(shingle_hashes(text, words), lambda a: F.struct(F.size(a).alias("n"), checksum(a).alias("sum"), F.array_sort(F.filter(a, lambda x: x < F.lit(bound))).alias("kept")))


def printed(s: Column) -> Column:
    return F.concat_ws(":", s["n"].cast("string"), F.hex(s["sum"]), F.array_join(F.transform(s["kept"], lambda x: F.hex(x)), ","))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two sketches of one fraction."""
    both, same = F.size(F.array_intersect(a["kept"], b["kept"])), (a["n"] == b["n"]) & (a["sum"] == b["sum"])
    either = F.size(a["kept"]) + F.size(b["kept"]) - both
    return F.when(same, F.lit(1.0)).when(either == 0, F.lit(0.0)).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; null if a keeps none and the sets differ."""
    same = (a["n"] == b["n"]) & (a["sum"] == b["sum"])
    return F.when(same, F.lit(1.0)).when(F.size(a["kept"]) > 0, F.size(F.array_intersect(a["kept"], b["kept"])) / F.size(a["kept"]))


def merged(a: Column, b: Column) -> Column:
    """Kept hashes of the union of two texts' shingles."""
    return F.array_sort(F.array_union(a["kept"], b["kept"]))


def fingerprints(docs: DataFrame, fraction: float = FRACTION, words: int = WORDS) -> DataFrame:
    """docs' doc_id, sketch and fingerprint; no shuffle."""
    out = docs.select("doc_id", sketch(F.col("text"), fraction, words).alias("sketch"))
    return out.withColumn("fingerprint", printed(F.col("sketch")))


def _halved(at: Column, step: int, n: int, cuts: Column, c: Column) -> Column:
    return _let(at, lambda x: F.when((x + step <= n) & (F.get(cuts, x + (step - 1)) < c), x + step).otherwise(x))


def with_next(docs: DataFrame, columns: list[str], run: int = RUN) -> DataFrame:
    """Adds next_<column> of the next row by doc_id (ties by text); the last row's next is the first.

    Rows are dealt into runs of about ``run`` rows by quantiles of doc_id. The first row of every run is also dealt,
    as a guest, to the end of the run before it, so each run is one window and no window holds more than a run. The
    driver sees the quantiles and the least doc_id of each run, at most ``MOST_RUNS`` numbers.
    """
    ids = docs.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low")).first()
    runs = max(1, min(MOST_RUNS, ids["n"] // run))
    # arrays of figures are written as one text each and folded to literals, not built from single ones
    figures = lambda xs, kind="bigint": F.split(F.lit(",".join(map(str, xs))), ",").try_cast(f"array<{kind}>")
    steps = figures([i / runs for i in range(1, runs)], "double")
    cuts = docs.agg(F.percentile_approx("doc_id", steps, max(10_000, 4 * runs)).alias("q")).first()["q"] if runs > 1 else []
    cuts = sorted(set(cuts or []))
    pieces = figures(cuts or [2**63 - 1])

    def number(c: Column) -> Column:
        """Cuts below c, by halves; each step is bound once, so the expression grows with the logarithm of the cuts."""
        at, step = F.lit(0), 1 << max(len(cuts).bit_length() - 1, 0)
        while step:
            at = _halved(at, step, len(cuts), pieces, c)
            step //= 2
        return F.when(c.isNull(), 0).otherwise(at)

    own = docs.withColumn("run_at", number(F.col("doc_id")).cast("int"))
    heads = own.groupBy("run_at").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("head")).orderBy("run_at").collect()
    order = [r["run_at"] for r in heads]
    # by number of the run: the run before it that has rows, and its least doc_id (none where that is null)
    before, first = [0] * (len(cuts) + 1), [""] * (len(cuts) + 1)
    for k, r in enumerate(heads):
        before[r["run_at"]] = order[k - 1]
        first[r["run_at"]] = "" if r["head"]["doc_id"] is None else r["head"]["doc_id"]
    at_head = F.col("doc_id").eqNullSafe(F.get(figures(first), F.col("run_at")))
    prior = F.get(figures(before), F.col("run_at")).cast("int")
    dealt = own.withColumn("deal", F.explode(F.when(at_head, F.array(F.struct(F.col("run_at").alias("run"), F.lit(0).alias("guest")), F.struct(prior.alias("run"), F.lit(1).alias("guest")))).otherwise(F.array(F.struct(F.col("run_at").alias("run"), F.lit(0).alias("guest"))))))
    dealt = dealt.withColumn("run", F.col("deal.run")).withColumn("guest", F.col("deal.guest")).drop("deal", "run_at")
    along = Window.partitionBy("run").orderBy("guest", "doc_id", "text")
    for c in columns:
        dealt = dealt.withColumn(f"next_{c}", F.lead(c).over(along))
    return dealt.where("guest = 0").drop("run", "guest")


def edited_fingerprints(docs: DataFrame, fraction: float = FRACTION, words: int = WORDS) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, whose last quarter of code points gives way to the next text's first."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("sketch", sketch(F.col("text"), fraction, words))
    rows = with_next(rows, ["text", "sketch"])
    n = F.char_length("text").cast("long")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (n - cut).cast("int")), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.select("doc_id", n.alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "sketch", "next_sketch", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), sketch(F.col("edited"), fraction, words).alias("edited_sketch"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
