"""Normalization of names and addresses, as column expressions.

Only folding non-ASCII text to ASCII needs Python, and it runs for non-ASCII rows alone.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftlink.functions import lexicon as lx
from weftlink.functions.phonetic import metaphone_udf

NON_ASCII = r"[^\x00-\x7F]"
# Patterns of domains, trade-name markers and landmarks, and Latin letters without a decomposition.
_DOMAIN_TEST = r"(?i)\b[\w.-]+\.(com|net|org|in|co\.in|fr|io|biz|info)\b"
TRADE_NAME = r"(?i)\bdba\b|\bd/b/a\b|\btrading as\b"
LANDMARK = r"(?i)\b(?:" + "|".join(lx.LANDMARK_WORDS) + r")\b\.?\s+([^,]+)"
POSTPOSED = r"(?i)([^,]+?)\s+ke\s+pas\b"
_LATIN = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th", "ð": "d", "’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-"}


@lru_cache(maxsize=65536)
def romanize_char(c: str) -> str:
    """A character without regard to its neighbours, by its Unicode name.

    Indic consonants lose their inherent vowel, signs follow their sound, long vowels
    become short and doubled letters single.
    """
    if ord(c) < 128:
        return c
    if c in _LATIN:
        return _LATIN[c]
    base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
    if base and base.isascii():
        return base
    name = unicodedata.name(c, "")
    if "DIGIT" in name or unicodedata.category(c) == "Nd":
        return str(unicodedata.digit(c, ""))
    if "VIRAMA" in name or "NUKTA" in name:
        return ""
    if "ANUSVARA" in name or "CANDRABINDU" in name or "BINDI" in name or "TIPPI" in name:
        return "m"
    sound = name.rpartition(" ")[2].lower() if "LETTER" in name or "VOWEL SIGN" in name else ""
    if not sound:
        return ""
    if "LETTER" in name and len(sound) > 1 and sound.endswith("a") and sound[0] not in "aeiou":
        sound = sound[:-1]
    out = ""
    for letter in sound:
        if letter.isalpha() and (not out or out[-1] != letter):
            out += letter
    return out


def fold(text: str | None, romanize: bool = True) -> str:
    """Compatibility form with known native words replaced; if romanize, in ASCII without accents."""
    out = unicodedata.normalize("NFKC", text or "")
    if not out.isascii():
        for table in (lx.NATIVE_LEGAL, lx.NATIVE_STATES):
            for native, known in table.items():
                out = out.replace(native, f" {known} ")
        if romanize:
            out = "".join(map(romanize_char, out))
    if romanize:
        out = "".join(c for c in unicodedata.normalize("NFKD", out) if not unicodedata.combining(c))
    return out


@F.pandas_udf(T.StringType())
def _fold_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else fold(t))


@F.pandas_udf(T.StringType())
def _compose_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else fold(t, romanize=False))


def bound(df: DataFrame, **columns: Column) -> DataFrame:
    """df with these columns, each computed once.

    A generator of one row: projections are not merged across it, so what reads a column
    does not repeat its expression.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def is_foreign(text: Column) -> Column:
    return text.rlike(NON_ASCII)


def folded(text: Column) -> Column:
    return F.coalesce(_fold_udf(F.when(is_foreign(text), text)), text, F.lit(""))


def composed(text: Column) -> Column:
    return F.coalesce(_compose_udf(F.when(is_foreign(text), text)), F.lit(""))


def strip_junk(text: Column) -> Column:
    """Without a tail behind |, without brackets, and without junk at the ends."""
    return F.btrim(F.regexp_replace(F.regexp_replace(text, r"\s*\|.*$", ""), r"[\[\](){}]", " "), F.lit(lx.JUNK))


def squeeze(text: Column, others: str = "[^a-z0-9\\s]") -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), others, " "), r"\s+", " "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda t: t != "")


def mapped(values: Column, table: dict[str, str]) -> Column:
    """Every element replaced where the table has it."""
    if not table:
        return values
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.transform(values, lambda t: F.coalesce(F.try_element_at(known, t), t))


def _within(table: list[str]):
    known = F.array(*map(F.lit, table))
    return lambda t: F.array_contains(known, t)


def run_lengths(values: Column) -> Column:
    """Without elements that equal the one before."""
    return F.filter(values, lambda t, i: (i == 0) | (t != F.try_element_at(values, F.when(i > 0, i).otherwise(1))))


def first_cut(text: Column, pattern: str) -> tuple[Column, Column]:
    """Head before and tail behind the first match; without one the text and null."""
    at = F.regexp_instr(text, F.lit(pattern))
    size = F.length(F.regexp_extract(text, pattern, 0))
    return F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text), F.when(at > 0, F.substring(text, at + size, F.length(text)))


def collapse_domains(text: Column) -> Column:
    return F.regexp_replace(text, r"(?i)\b([\w-]*)[\w.-]*\.(?:com|net|org|in|co\.in|fr|io|biz|info)\b", "$1")


def with_names(df: DataFrame, name: str = "business_name") -> DataFrame:
    """df with name_norm, name_core, name_alt, legal_forms, is_domain, translit, first_token and metaphone_key."""
    raw = F.coalesce(F.col(name), F.lit(""))
    out = df.withColumn("_f", folded(raw))
    out = bound(out, translit=is_foreign(raw), _n=F.replace("_f", F.lit("&"), F.lit(" and ")))
    out = bound(out, is_domain=F.col("_n").rlike(_DOMAIN_TEST), _d=collapse_domains(F.col("_n")))
    head, tail = first_cut(F.col("_d"), TRADE_NAME)
    out = bound(out, _head=head, _alt=F.coalesce(tail, F.lit("")))
    out = bound(out, _t=mapped(F.filter(tokens(squeeze(strip_junk(F.col("_head")))), lambda t: ~_within(lx.HONORIFICS)(t)), lx.LEGAL_FORMS), _fa=squeeze(strip_junk(F.col("_alt"))))
    out = bound(out, _w=run_lengths(F.col("_t")))
    out = bound(out, _core=F.filter("_w", lambda t: ~_within(lx.LEGAL_CODES)(t)), name_norm=F.array_join("_w", " "))
    core = F.array_join("_core", " ")
    out = bound(
        out,
        legal_forms=F.array_sort(F.array_distinct(F.filter("_w", _within(lx.LEGAL_CODES)))),
        name_core=F.when(core == "", F.col("name_norm")).otherwise(core),
        first_token=F.coalesce(F.try_element_at("_core", F.lit(1)), F.try_element_at("_w", F.lit(1)), F.lit("")),
    )
    return out.withColumn("name_alt", F.col("_fa")).withColumn("metaphone_key", metaphone_udf("first_token")).drop("_f", "_n", "_d", "_head", "_alt", "_t", "_fa", "_w", "_core")


def postal_code(text: Column, country: Column) -> Column:
    india = F.replace(F.regexp_extract(text, r"(?U)(?<!\d)([1-9]\d{2}\s?\d{3})(?!\d)", 1), F.lit(" "), F.lit(""))
    us = F.regexp_extract(text, r"(?U)\b(\d{5})(?:-\d{4})?\b", 1)
    france = F.regexp_extract(text, r"(?U)\b(\d{5})\b", 1)
    return F.when(country == "India", india).when(country == "US", us).when(country == "France", france).otherwise("")


def state_code(text: Column, country: Column) -> Column:
    """State by name in table order, else by two-letter code in alphabetical order; regions of France as substrings."""
    padded = F.concat(F.lit(" "), F.regexp_replace(text, r"([^\w ])", " \u0001 "), F.lit(" "))

    def of(names: dict[str, str]) -> Column:
        rows = [F.struct(F.lit(f" {k} ").alias("k"), F.lit(v).alias("v")) for k, v in names.items()]
        rows += [F.struct(F.lit(f" {c.lower()} ").alias("k"), F.lit(c).alias("v")) for c in sorted(set(names.values()))]
        return F.get(F.filter(F.array(*rows), lambda r: F.instr(padded, r["k"]) > 0), F.lit(0))["v"]

    regions = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in lx.FRANCE_REGIONS.items()))
    france = F.get(F.filter(regions, lambda r: F.instr(text, r["k"]) > 0), F.lit(0))["v"]
    return F.coalesce(F.when(country == "US", of(lx.US_STATES)).when(country == "India", of(lx.INDIA_STATES)).when(country == "France", france), F.lit(""))


def address_tokens(text: Column, country: Column) -> Column:
    """Canonical words of a squeezed address: ordinals, then the country's short forms, then cities; no leading zeros."""
    kept = mapped(F.filter(tokens(text), lambda t: ~_within(lx.EMPTY_WORDS)(t)), lx.ORDINALS)
    short = kept
    for name, table in lx.ADDRESS_WORDS.items():
        short = F.when(country == name, mapped(kept, table)).otherwise(short)
    return F.transform(mapped(short, lx.CITIES), lambda t: F.when(t.rlike("^0[0-9]+$"), F.regexp_replace(t, "^0+(?=[0-9])", "")).otherwise(t))


def with_addresses(df: DataFrame, address: str = "business_address", country: str = "country") -> DataFrame:
    """df with addr_norm, addr_core, pincode, house_number, numeric_tokens, state_code, city and landmark."""
    raw, where = F.coalesce(F.col(address), F.lit("")), F.col(country)
    out = df.withColumn("_f", folded(raw))
    out = bound(out, _a=F.regexp_replace("_f", r"(?i)\b(?:city|town|village)\s+of\s+", ""))
    out = bound(out, _found=F.col("_a").rlike(LANDMARK), _post=F.col("_a").rlike(POSTPOSED))
    found, post = F.col("_found"), F.col("_post")
    front, back = first_cut(F.col("_a"), LANDMARK)
    front2, back2 = first_cut(F.col("_a"), POSTPOSED)
    out = bound(
        out,
        landmark=F.lower(F.trim(F.when(found, F.regexp_extract("_a", LANDMARK, 1)).when(post, F.regexp_extract("_a", POSTPOSED, 1)).otherwise(""))),
        _rest=F.when(found, F.concat_ws(" ", front, back)).when(post, F.concat_ws(" ", front2, back2)).otherwise(F.col("_a")),
    )
    words = F.when(F.trim(raw) == "", F.array().cast("array<string>")).otherwise(address_tokens(squeeze(F.col("_rest")), where))
    out = bound(out, pincode=postal_code(raw, where), _low=F.lower("_rest"), _t=words)
    out = bound(out, state_code=state_code(F.col("_low"), where), _digits=F.filter("_t", lambda t: t.rlike("^[0-9]+$")))
    cities = F.array(*map(F.lit, lx.CITIES.values()))
    out = bound(
        out,
        addr_norm=F.array_join("_t", " "),
        addr_core=F.array_join(F.filter("_t", lambda t: ~t.rlike("^[0-9]+$")), " "),
        numeric_tokens=F.array_sort(F.array_distinct("_digits")),
        house_number=F.coalesce(F.get("_digits", F.lit(0)), F.lit("")),
        city=F.coalesce(F.get(F.filter(cities, lambda c: F.array_contains("_t", c)), F.lit(0)), F.lit("")),
    )
    return out.drop("_f", "_a", "_found", "_post", "_rest", "_low", "_t", "_digits")


def _native(text: Column, others: str = r"[^\p{L}\p{N}\p{M}_\s]") -> Column:
    return squeeze(text, others)


def normalize(df: DataFrame) -> DataFrame:
    """All normalized columns of records(entity_id, business_name, business_address, country)."""
    name, address = F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit(""))
    out = parallel(df).withColumn("_cn", composed(name)).withColumn("_ca", composed(address))
    out = bound(out, _cd=collapse_domains(F.replace("_cn", F.lit("&"), F.lit(" and "))))
    head, _ = first_cut(F.col("_cd"), TRADE_NAME)
    out = bound(out, _ch=head)
    out = bound(out, native_name=_native(strip_junk(F.col("_ch"))), native_addr=_native(F.regexp_replace("_ca", r"(?i)\b(?:city|town|village)\s+of\s+", "")))
    out = with_names(with_addresses(out.drop("_cn", "_ca", "_cd", "_ch")))
    half = lambda native, plain: F.when(F.col(native) != "", F.col(native)).otherwise(F.col(plain))
    return (
        out.withColumn("embed_text", F.trim(F.concat("name_core", F.lit(" | "), "addr_core")))
        .withColumn("embed_text_native", F.when((F.col("native_name") == "") & (F.col("native_addr") == ""), "").otherwise(F.trim(F.concat(half("native_name", "name_core"), F.lit(" | "), half("native_addr", "addr_core")))))
        .withColumn("sn_key_a", F.col("name_core"))
        .withColumn("sn_key_b", F.array_join(F.array_sort(F.split("name_core", " ")), " "))
    )


def parallel(df: DataFrame) -> DataFrame:
    """df, dealt over all cores if it is too small to be read in that many parts: a record costs far more than its shuffle."""
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    part = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * part else df
