"""Normalization of names and addresses as column expressions."""

from __future__ import annotations

import unicodedata
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import vocabulary as V

#: A word boundary that counts letters and digits of every script.
_NOT_WORD_BEFORE, _NOT_WORD_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
_SPACES = r"[\s\p{Z}]"


def clean(c: Column) -> Column:
    """Text without blanks at its ends; '' for null."""
    return F.coalesce(F.regexp_replace(c, rf"^{_SPACES}+|{_SPACES}+$", ""), F.lit(""))


def _words(texts: pd.Series) -> pd.Series:
    kept = lambda t: "".join(c if c.isalnum() or c == "_" else " " for c in t.replace("&", " and "))
    return texts.map(lambda t: " ".join(kept(unicodedata.normalize("NFKC", t).lower()).split()) if t else t)


def normal_words(c: Column) -> Column:
    """Lower case of the compatibility form, ampersands spelled out, all but letters, digits and underscores turned to
    blanks, runs of blanks to one.

    Pure ASCII stays in the JVM; other texts visit Python once, whose Unicode tables
    know letters the JVM does not.
    """
    odd = c.rlike(r"[^\x00-\x7F]")
    spelled = F.regexp_replace(F.replace(F.lower(c), F.lit("&"), F.lit(" and ")), r"[^a-z0-9_]", " ")
    return F.when(odd, F.pandas_udf(_words, "string")(F.when(odd, c))).otherwise(F.trim(F.regexp_replace(spelled, r" +", " ")))


def tokens(c: Column) -> Column:
    """Words of a normalized text; an empty array for ''."""
    return F.filter(F.split(c, " "), lambda t: t != "")


def sorted_words(c: Column) -> Column:
    return F.array_join(F.array_sort(tokens(c)), " ")


def _table(values: dict[str, str]) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(values.items())))


def legal_suffix(name: Column) -> Column:
    """Short form of the first legal form in the name, '' if there is none or it has no short form."""
    found = F.regexp_extract(name, f"{_NOT_WORD_BEFORE}({V.LEGAL_FORMS}){_NOT_WORD_AFTER}", 1)
    return F.coalesce(_table(V.SHORT_FORMS)[found], F.lit(""))


def core_name(name: Column) -> Column:
    """The name without any of its legal forms; may be ''."""
    bare = F.regexp_replace(name, f"{_NOT_WORD_BEFORE}({V.LEGAL_FORMS}){_NOT_WORD_AFTER}", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def expanded(address: Column, table: dict[str, str] = V.ADDRESS_WORDS) -> Column:
    """Address with abbreviations written out word by word; no expansion is itself an abbreviation."""
    full = _table(table)
    return F.array_join(F.transform(F.split(address, " "), lambda t: F.coalesce(full[t], t)), " ")


def postcode(address: Column) -> Column:
    return F.regexp_extract(address, r"(?U)\b(\d{5,6})\b", 1)


def street_number(address: Column) -> Column:
    return F.regexp_extract(address, r"(?U)\b(\d+[a-z]?)\b", 1)


def has_landmark(address: Column) -> Column:
    return address.rlike(rf"(?U)\b(?:{'|'.join(V.LANDMARKS)})\b").cast("int")


def first_token(c: Column) -> Column:
    return F.split_part(c, F.lit(" "), F.lit(1))


def token_count(c: Column) -> Column:
    return F.when(c == "", 0).otherwise(F.size(F.split(c, " ")))


def normalized(records: DataFrame, indian: bool = False) -> DataFrame:
    """Records with all derived columns of names and addresses.

    Null texts count as ''. Other columns of ``records`` are kept unless a
    derived column has their name, which then replaces them.
    """
    raw = {c: clean(F.col(c)) for c in ("business_name", "business_address", "country")}
    df = records.withColumns(raw)
    df = df.withColumns({
        "has_name": (F.length("business_name") > 0).cast("int"),
        "has_address": (F.length("business_address") > 0).cast("int"),
        "name_norm": normal_words(F.col("business_name")),
        "address_norm": normal_words(F.col("business_address")),
        "country_norm": F.upper("country"),
    })
    address = expanded(F.col("address_norm"))
    df = df.withColumns({
        "name_core": core_name(F.col("name_norm")),
        "legal_suffix": legal_suffix(F.col("name_norm")),
        "address_norm": expanded(address, V.INDIAN_WORDS) if indian else address,
    })
    return df.withColumns({
        "name_sorted": sorted_words(F.col("name_norm")),
        "core_sorted": sorted_words(F.col("name_core")),
        "pincode": postcode(F.col("address_norm")),
        "street_num": street_number(F.col("address_norm")),
        "has_landmark": has_landmark(F.col("address_norm")),
        "addr_token1": first_token(F.col("address_norm")),
        "name_len": F.length("name_norm"),
        "name_ntoken": token_count(F.col("name_norm")),
    }).withColumn("has_pincode", (F.length("pincode") > 0).cast("int"))


def text_for_retrieval(name: Column, address: Column) -> Column:
    """The name twice and the address once."""
    return F.trim(F.concat_ws(" ", name, name, address))


def parse_id_list(c: Column) -> Column:
    """Distinct ids of a comma-separated list, blanks removed, empty ones dropped; [] for null."""
    return F.coalesce(F.array_distinct(F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")), F.array().cast("array<string>"))


def join_id_list(c: Column) -> Column:
    return F.array_join(F.array_sort(c), ",")
