"""Normalized entities and their blocking keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import textnorm as N
from tessera.schema import EXACT_TYPES, KEY_TYPES

MIN_TOKEN = 4


def normalize(entities: DataFrame, full_unicode: bool = False, keep_marks: bool = False) -> DataFrame:
    """Entities with name, addr, house, zip, and the non-ASCII flags of the raw texts."""
    df = entities.withColumn("name", N.norm_name(F.col("business_name"), full_unicode, keep_marks)).withColumn("addr", N.norm_addr(F.col("business_address"), full_unicode, keep_marks))
    return (
        df.withColumn("house", N.house(F.col("addr")))
        .withColumn("zip", N.postal(F.col("addr")))
        .withColumn("nn", N.non_ascii(F.col("business_name")))
        .withColumn("an", N.non_ascii(F.col("business_address")))
    )


def tokens(s: Column, least: int = MIN_TOKEN) -> Column:
    return F.filter(F.split(s, " "), lambda t: F.char_length(t) >= least)


def bigrams(s: Column) -> Column:
    t = F.filter(F.split(s, " "), lambda x: x != "")
    return F.when(F.size(t) >= 2, F.transform(F.slice(t, 1, F.size(t) - 1), lambda x, i: F.concat(x, F.lit(" "), F.get(t, i + 1)))).otherwise(F.array().cast("array<string>"))


def key_lists(least: int = MIN_TOKEN) -> dict[str, Column]:
    """An array of keys for each key type; words that repeat give keys that repeat."""
    one = lambda c: F.filter(F.array(c), lambda x: x != "")
    name, addr = F.col("name"), F.col("addr")
    return {
        "name_exact": one(name),
        "name_sig": one(N.name_sig(name)),
        "name_nospace": one(N.name_nospace(name)),
        "name_bi": bigrams(name),
        "name_tok": tokens(name, least),
        "addr_tok": tokens(addr, least),
        "addr_bi": bigrams(addr),
        "house": one(F.col("house")),
        "house_norm": one(N.house_norm(F.col("house"))),
        "postal": one(F.col("zip")),
    }


def postings(normal: DataFrame, types: tuple[str, ...] = KEY_TYPES, least: int = MIN_TOKEN) -> DataFrame:
    """(rid, country, key_type, key): all keys of every entity in one pass over the entities."""
    lists = key_lists(least)

    def tagged(t: str) -> Column:
        return F.transform(lists[t], lambda k: F.struct(F.lit(t).alias("key_type"), k.alias("key")))

    kinds = F.concat(*[tagged(t) for t in types])
    return normal.select("rid", "country", F.inline(kinds))


def exact_postings(normal: DataFrame) -> DataFrame:
    return postings(normal, EXACT_TYPES)
