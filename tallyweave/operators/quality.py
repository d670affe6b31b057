"""Flags of records whose fields look wrong or carry little."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import vocabulary as V
from tallyweave.functions.text import tokens

# Postal codes of American states and names of Indian ones.
STATES = """al ak az ar ca co ct de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy
gujarat karnataka kerala maharashtra rajasthan punjab haryana bihar assam odisha telangana goa"""


def without_control(c: Column) -> Column:
    """Text without control characters."""
    return F.regexp_replace(c, r"\p{Cc}", "")


def has_state(address: Column) -> Column:
    """Whether a word of a normalized address is a state."""
    return F.arrays_overlap(tokens(address), F.array(*map(F.lit, STATES.split()))).cast("int")


def record_flags(records: DataFrame) -> DataFrame:
    """``entity_id`` and flags of normalized records: control characters, fields that seem swapped, a state, a house
    number, a core name that tells nothing."""
    name, address = F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit(""))
    swapped = F.col("name_norm").rlike(r"\b\d{5,6}\b") & ~F.col("address_norm").rlike(r"\d")
    return records.select(
        "entity_id",
        (name.rlike(r"\p{Cc}") | address.rlike(r"\p{Cc}")).cast("int").alias("has_control"),
        swapped.cast("int").alias("fields_swapped"),
        has_state(F.col("address_norm")).alias("has_state"),
        (F.col("street_num") != "").cast("int").alias("has_street_number"),
        (F.length("name_core") < 3).cast("int").alias("low_information"),
    )


def quarantine(lines: DataFrame, columns: int = 4) -> tuple[DataFrame, DataFrame]:
    """Numbered text lines with and without the wanted number of tab-separated fields."""
    good = F.size(F.split("value", "\t")) == columns
    return lines.filter(good), lines.filter(~good)


def raw_suffix(name: Column) -> Column:
    """The first legal form of a normalized name as it was written."""
    return F.regexp_extract(name, r"(?<![\p{L}\p{N}_])(" + V.LEGAL_FORMS + r")(?![\p{L}\p{N}_])", 1)


def raw_suffix_agreement(a: Column, b: Column) -> Column:
    """1 where both names carry a legal form and it is the same one, literally."""
    return ((raw_suffix(a) != "") & (raw_suffix(a) == raw_suffix(b))).cast("int")


def landmarks(address: Column) -> Column:
    """The words that follow the landmark words of a normalized address, two after each."""
    words = "|".join(V.LANDMARKS)
    after = F.regexp_extract_all(address, F.lit(rf"(?U)\b(?:{words}) (\w+(?: \w+)?)"), F.lit(1))
    return F.array_distinct(F.flatten(F.transform(after, lambda t: F.split(t, " "))))


def landmark_overlap(a: Column, b: Column) -> Column:
    """Common over all words of the landmarks of two normalized addresses; 0 where one names none."""
    from tallyweave.functions.similarity import set_jaccard

    return set_jaccard(landmarks(a), landmarks(b))
