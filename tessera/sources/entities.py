"""Entity sources: tab-separated files, tables of this engine's own, and views over the driver's tables.

An entity is (rid, src, is_s3, entity_id, business_name, business_address, country); src 0 is the query side,
1 and 2 are the two target sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.schema import ENTITY_COLUMNS

#: Texts that the reader takes for a missing value.
NA_STRINGS = ("", "NA", "N/A", "n/a", "NaN", "nan", "NULL", "null", "None", "<NA>", "#N/A", "-NaN", "-nan", "#NA")


def numbered(df: DataFrame, column: str = "rid") -> DataFrame:
    """Row numbers in file order, for rows read straight from files: how many rows each split of a file holds, then places within it.

    The table of splits is all that is ordered; rows stay where they are read.
    """
    file, start, at = "_split_file", "_split_start", "_split_at"
    rows = df.withColumns({file: F.input_file_name(), start: F.input_file_block_start(), at: F.monotonically_increasing_id()})
    splits = rows.groupBy(file, start).agg(F.count(F.lit(1)).alias("_split_rows"), F.min(at).alias("_split_first"))
    before = F.coalesce(F.sum("_split_rows").over(Window.orderBy(file, start).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select(file, start, (before - F.col("_split_first")).alias("_split_more"))
    return rows.join(splits, [file, start]).select(*df.columns, (F.col(at) + F.col("_split_more")).alias(column))


def read_tsv(spark: SparkSession, path: str, limit: int | None = None, na_strings: tuple[str, ...] = NA_STRINGS, quote: str = "") -> DataFrame:
    """A source file as (rid, entity columns): all strings, missing columns and values empty, the first ``limit`` rows."""
    header = spark.read.option("sep", "\t").option("header", True).option("quote", quote).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in header])
    raw = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", quote).option("enforceSchema", True).csv(path)
    value = lambda c: F.when(F.col(c).isin(*na_strings), "").otherwise(F.coalesce(F.col(c), F.lit("")))
    df = numbered(raw).select("rid", *[value(c).alias(c) if c in header else F.lit("").alias(c) for c in ENTITY_COLUMNS])
    return df.where(F.col("rid") < limit) if limit is not None else df


def load_split(spark: SparkSession, folder: str, split: str, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(query side, targets) of ``<split>_source{1,2,3}.tsv``; rows of source 3 are numbered after those of source 2."""
    one, two, three = (read_tsv(spark, f"{folder}/{split}_source{k}.tsv", limit) for k in (1, 2, 3))
    n2 = two.count()
    s1 = one.withColumn("src", F.lit(0)).withColumn("is_s3", F.lit(False))
    t2 = two.withColumn("src", F.lit(1)).withColumn("is_s3", F.lit(False))
    t3 = three.withColumn("rid", F.col("rid") + n2).withColumn("src", F.lit(2)).withColumn("is_s3", F.lit(True))
    return s1, t2.unionByName(t3)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed ids in the first column of a source file."""
    lines = spark.read.text(path)
    first = F.trim(F.split("value", "\t")[0])
    return lines.select(first.alias("id")).where((F.col("id") != "") & (F.lower("id") != "entity_id")).distinct()


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, tgt_id), one row for each listed match."""
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    a, b = raw.columns[:2]
    return raw.select(F.col(a).alias("s1_id"), F.explode(F.split(F.coalesce(F.col(b), F.lit("")), ",")).alias("tgt_id")).select("s1_id", F.trim("tgt_id").alias("tgt_id")).where("tgt_id <> ''")


def save_role(entities: DataFrame, path: str) -> None:
    """The normalized role as a table; Spark's success marker tells a finished one."""
    entities.write.mode("overwrite").parquet(path)


def load_role(spark: SparkSession, path: str, with_text: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return df if with_text else df.drop("business_name", "business_address", "name", "addr")


def document_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities made of the first characters of ``documents``, dealt to the sources by id."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    src = (F.col("doc_id") % 3).cast("int")
    return d.select(
        F.col("doc_id").alias("rid"), src.alias("src"), (src == 2).alias("is_s3"),
        F.concat(F.lit("S"), src + 1, F.lit("-"), F.col("doc_id")).alias("entity_id"),
        F.substring("text", 1, 60).alias("business_name"), F.substring("text", 61, 60).alias("business_address"), F.col("lang").alias("country"),
    )


def trade_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities made of ``customer`` and ``supplier``, with house numbers, states and postal codes."""
    t = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    nation = t("nation").select(F.col("n_nationkey"), F.col("n_name").alias("country"))

    def side(df: DataFrame, key: str, src: int, name: str, nation_key: str, middle) -> DataFrame:
        addr = F.concat((F.col(key) % 997).cast("string"), *middle, (F.col(key) % 500 + 10000).cast("string"))
        return df.join(nation, F.col(nation_key) == F.col("n_nationkey")).select(
            F.col(key).alias("rid"), F.lit(src).alias("src"), F.lit(False).alias("is_s3"), F.concat(F.lit(f"S{src + 1}-"), F.col(key)).alias("entity_id"),
            F.col(name).alias("business_name"), addr.alias("business_address"), "country",
        )

    one = side(t("customer"), "c_custkey", 0, "c_name", "c_nationkey", [F.lit(" "), F.lower("c_mktsegment"), F.lit(" st texas ")])
    two = side(t("supplier"), "s_suppkey", 1, "s_name", "s_nationkey", [F.lit(" main st texas ")])
    return one.unionByName(two)
