"""Normalization of names and addresses as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# Legal-form words that a name signature leaves out.
LEGAL_TOKENS = (
    "ltd", "limited", "llc", "llp", "lp", "inc", "incorporated", "corp", "corporation", "co", "company", "pvt", "pvtl", "private", "plc", "and",
    "gmbh", "kg", "ag", "ohg", "sarl", "sas", "eurl", "srl", "spa", "sa", "bv", "nv", "oy", "ab", "as", "oyj", "pty", "pte", "ltda", "eirl", "ets",
    "ste", "sci", "प्राइवेट", "लिमिटेड", "प्रा", "लि", "प्रा।", "लि।", "ലിമിറ്റഡ്", "പ്രൈവറ്റ്", "പ്രാ", "லிமிடெட்", "பிரைவேட்", "లిమిటెడ్",
    "ప్రైవేట్", "ಲಿಮಿಟೆಡ್", "ಪ್ರೈವೇಟ್", "লিমিটেড", "প্রাইভেট", "લિમિટેડ", "પ્રાઇવેટ", "ਲਿਮਿਟੇਡ", "ਪ੍ਰਾਈਵੇਟ",
)

# US states and their postal codes.
US_STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct",
    "delaware": "de", "district of columbia": "dc", "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il",
    "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md",
    "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms", "missouri": "mo", "montana": "mt", "nebraska": "ne",
    "nevada": "nv", "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm", "new york": "ny", "north carolina": "nc",
    "north dakota": "nd", "ohio": "oh", "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa", "rhode island": "ri",
    "south carolina": "sc", "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt", "virginia": "va",
    "washington": "wa", "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy",
}

# Street types and units, written out.
STREET = {
    "rd": "road", "road": "road", "st": "street", "ave": "avenue", "av": "avenue", "avenue": "avenue", "dr": "drive",
    "blvd": "boulevard", "ln": "lane", "ct": "court", "cir": "circle", "pkwy": "parkway", "hwy": "highway", "ter": "terrace",
    "trl": "trail", "sq": "square", "expy": "expressway", "fwy": "freeway", "pl": "place", "plz": "plaza", "ste": "apt",
    "suite": "apt", "unit": "apt",
}

#: What is no letter, digit, underscore or white space.
PUNCTUATION = r"[^\p{L}\p{N}_\s]+"
#: The same, leaving combining marks (Indic vowel signs) where they are.
PUNCTUATION_KEEPING_MARKS = r"[^\p{L}\p{N}\p{M}_\s]+"
HOUSE = r"\b(\d{1,7}[a-z]?)\b"
POSTAL = r"(?<!\d)(\d{6}|\d{5})(?!\d)"


def accent_pairs() -> tuple[str, str]:
    """Letters U+00C0 to U+00FF with one ASCII letter as their base, and these letters; also o and d with stroke."""
    src, dst = "", ""
    for c in map(chr, range(0xC0, 0x100)):
        parts = unicodedata.normalize("NFD", c)
        if len(parts) > 1 and parts[0].isascii():
            src, dst = src + c, dst + parts[0]
    return src + "øð", dst + "od"


#: Letters that become two.
WIDE = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}


def nfkc(s: Column) -> Column:
    """Unicode NFKC and full case folding (no built-in has them), in Arrow batches; ASCII batches pass unchanged but for case."""

    @pandas_udf("string")
    def fold(x: pd.Series) -> pd.Series:
        return x.map(lambda t: t.lower() if t is not None and t.isascii() else None if t is None else unicodedata.normalize("NFKC", t).casefold())

    return fold(s)


def collapse(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def fold_accents(s: Column) -> Column:
    out = F.translate(s, *accent_pairs())
    for a, b in WIDE.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def norm_text(s: Column, full_unicode: bool = False, keep_marks: bool = False) -> Column:
    """Case folded, accents folded, ``&`` written out, punctuation and underscores to spaces, white space collapsed."""
    s = F.coalesce(s, F.lit(""))
    s = fold_accents(nfkc(s) if full_unicode else F.lower(s))
    s = F.replace(s, F.lit("&"), F.lit(" and "))
    s = F.regexp_replace(s, PUNCTUATION_KEEPING_MARKS if keep_marks else PUNCTUATION, " ")
    return collapse(F.replace(s, F.lit("_"), F.lit(" ")))


norm_name = norm_text


def _mapped(t: Column, values: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, t), t)


def fold_states(s: Column) -> Column:
    """Names of states to codes, longest first; one-word names by a look-up of each word."""
    long = sorted((k for k in US_STATES if " " in k), key=len, reverse=True)
    for k in long:
        s = F.regexp_replace(s, rf"\b{k}\b", US_STATES[k])
    short = {k: v for k, v in US_STATES.items() if " " not in k}
    return F.array_join(F.transform(F.split(s, " "), lambda t: _mapped(t, short)), " ")


def expand_streets(s: Column) -> Column:
    """Street types written out; the first word is left alone."""
    return F.array_join(F.transform(F.split(s, " "), lambda t, i: F.when(i == 0, t).otherwise(_mapped(t, STREET))), " ")


def norm_addr(s: Column, full_unicode: bool = False, keep_marks: bool = False) -> Column:
    s = F.regexp_replace(norm_text(s, full_unicode, keep_marks), r"\bnull\b", " ")
    return expand_streets(collapse(fold_states(collapse(s))))


def name_tokens(name: Column) -> Column:
    """Words of a normalized name that are no legal forms."""
    return F.filter(F.split(name, " "), lambda t: ~t.isin(*LEGAL_TOKENS) & (t != ""))


def name_sig(name: Column) -> Column:
    return F.array_join(F.array_sort(name_tokens(name)), " ")


def name_nospace(name: Column) -> Column:
    return F.replace(name, F.lit(" "), F.lit(""))


def house(addr: Column) -> Column:
    return F.regexp_extract(addr, HOUSE, 1)


def house_digits(addr: Column) -> Column:
    """First run of up to 7 digits, wherever it stands."""
    return F.regexp_extract(addr, r"(\d{1,7})", 1)


def postal(addr: Column) -> Column:
    """First run of exactly 6 or 5 digits."""
    return F.regexp_extract(addr, POSTAL, 1)


def postal_six_first(addr: Column) -> Column:
    """First run of exactly 6 digits, else of exactly 5."""
    six = F.regexp_extract(addr, r"(?<!\d)(\d{6})(?!\d)", 1)
    return F.when(six != "", six).otherwise(F.regexp_extract(addr, r"(?<!\d)(\d{5})(?!\d)", 1))


def house_norm(h: Column) -> Column:
    return F.regexp_replace(h, "^0+", "")


def non_ascii(s: Column) -> Column:
    return F.coalesce(s, F.lit("")).rlike(r"[^\x00-\x7F]")


def country_code(country: Column, countries: list[str]) -> Column:
    """Position among the sorted labels; joins use the label itself."""
    return F.array_position(F.lit(sorted(countries)), country) - 1


def fold_of(rid: Column, folds: int) -> Column:
    """Fold by multiplicative hashing modulo 2**64, in decimals, which do not overflow."""
    d = rid.cast("decimal(20,0)") * F.lit("11400714819323198485").cast("decimal(20,0)")
    m = d % F.lit("18446744073709551616").cast("decimal(38,0)")
    return F.pmod(F.floor(m / F.lit(8589934592).cast("decimal(38,0)")).cast("long"), F.lit(folds)).cast("int")


def pack_pair(s1: Column, tgt: Column) -> Column:
    return F.shiftleft(s1, 32).bitwiseOR(tgt)


def unpack_pair(key: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(0xFFFFFFFF))
