"""Similarities of two texts as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyweave.functions import vocabulary as V
from tallyweave.functions.text import tokens


#: Length of the second text from which the library's matcher leaves out popular characters.
POPULAR = 200
#: Pairs of characters that are compared at once, about.
CELLS = 1 << 16


def matching_ratio(a: str, b: str) -> float:
    """Twice the matching characters over all characters of both, as the library's sequence matcher counts them.

    The longest common run is taken, the one that starts first in ``a`` and then in
    ``b``, and both sides of it alike. Below :data:`POPULAR` characters runs are
    grown by substring search, which gives the library's result sooner.
    """
    if not a and not b:
        return 1.0
    if len(b) >= POPULAR:
        return SequenceMatcher(None, a, b).ratio()
    matched, parts = 0, [(0, len(a), 0, len(b))]
    while parts:
        alo, ahi, blo, bhi = parts.pop()
        size = i = j = 0
        at = alo
        while at + size < ahi:
            where = b.find(a[at : at + size + 1], blo, bhi)
            if where < 0:
                at += 1
            else:
                size, i, j = size + 1, at, where
        if size:
            matched += size
            if alo < i and blo < j:
                parts.append((alo, i, blo, j))
            if i + size < ahi and j + size < bhi:
                parts.append((i + size, ahi, j + size, bhi))
    return 2.0 * matched / (len(a) + len(b))


def _spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, one after another, and the places where texts end, from 0."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return chars, np.cumsum([0, *map(len, texts)])


def _longest_runs(a: np.ndarray, b: np.ndarray, alo: np.ndarray, la: np.ndarray, blo: np.ndarray, lb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(size, i, j)`` of the longest common run of each stretch of ``a`` with its stretch of ``b``, by its distance from their starts.

    Of equal ones the first in ``a`` and then in ``b``. Runs that end at a pair of
    characters are one longer than those that end at the pair before.
    """
    n, rows, columns = len(alo), int(la.max()), int(lb.max())

    def laid(chars: np.ndarray, low: np.ndarray, size: np.ndarray, most: int, fill: int) -> np.ndarray:
        at = np.arange(most)[:, None]
        return np.where(at < size, chars[np.minimum(low + at, len(chars) - 1)], chars.dtype.type(fill))

    x, y = laid(a, alo, la, rows, 0), laid(b, blo, lb, columns, 1)
    runs = np.empty((rows + 1, columns + 1, n), np.uint8)
    runs[0] = runs[:, 0] = 0
    equal = np.empty((columns, n), bool)
    longest, best = np.empty(n, np.uint8), np.zeros(n, np.uint16)
    for i in range(rows):
        own = runs[i + 1, 1:]
        np.equal(y, x[i], out=equal)
        np.add(runs[i, :-1], 1, out=own)
        np.multiply(own, equal.view(np.uint8), out=own)
        np.maximum.reduce(own, axis=0, out=longest)
        # The greater number is the longer run or, of equal ones, the one that ends sooner.
        np.maximum(best, longest * np.uint16(256) + np.uint16(255 - i), out=best)
    size, end = (best >> 8).astype(np.int64), 255 - (best & 255).astype(np.int64)
    cells = ((end + 1) * (columns + 1) + 1) * n + np.arange(n)
    met = runs.reshape(-1).take(cells + np.arange(columns)[:, None] * n) == size
    last = 255 - np.maximum.reduce(met * np.arange(255, 255 - columns, -1, np.uint8)[:, None], axis=0).astype(np.int64)
    return size, end + 1 - size, last + 1 - size


def matching_ratios(pairs: Iterable[tuple[str, str]]) -> np.ndarray:
    """:func:`matching_ratio` of many pairs: stretches that are still to be matched are compared together, those of like lengths at a time."""
    pairs = list(pairs)
    out = np.ones(len(pairs))
    short = []
    for k, (x, y) in enumerate(pairs):
        if max(len(x), len(y)) >= POPULAR:
            out[k] = matching_ratio(x, y)
        elif x or y:
            short.append(k)
    (a, a_ends), (b, b_ends) = (_spans([pairs[k][side] for k in short]) for side in (0, 1))
    # The codes 0 and 1 fill up shorter stretches.
    most = max(int(a.max(initial=0)), int(b.max(initial=0))) + 2
    a, b = ((z + np.uint32(2)).astype(np.uint8 if most < 256 else np.uint16 if most < 65536 else np.uint32) for z in (a, b))
    matched = np.zeros(len(short), np.int64)
    parts = np.stack([np.arange(len(short)), a_ends[:-1], np.diff(a_ends), b_ends[:-1], np.diff(b_ends)])
    while True:
        parts = parts[:, (parts[2] > 0) & (parts[4] > 0)]
        if not parts.shape[1]:
            break
        width = np.where(parts[4] > 32, -(-parts[4] // 8) * 8, -(-parts[4] // 4) * 4)
        order = np.argsort(width * POPULAR + parts[2])
        parts, width = parts[:, order], width[order]
        more = []
        first = 0
        while first < len(width):
            last = min(first + max(1, CELLS // int(width[first])), int(np.searchsorted(width, width[first], "right")))
            last = first + max(min(last - first, 512), int(np.searchsorted(parts[2, first:last], 2 * parts[2, first] + 4)))
            which, alo, la, blo, lb = parts[:, first:last]
            size, i, j = _longest_runs(a, b, alo, la, blo, lb)
            np.add.at(matched, which, size)
            found = size > 0
            which, alo, la, blo, lb, size, i, j = (z[found] for z in (which, alo, la, blo, lb, size, i, j))
            more += [np.stack([which, alo, i, blo, j]), np.stack([which, alo + i + size, la - i - size, blo + j + size, lb - j - size])]
            first = last
        parts = np.concatenate(more, axis=1)
    out[short] = 2.0 * matched / (np.diff(a_ends) + np.diff(b_ends)) if short else out[short]
    return out


def distinct_ratios(pairs: Iterable[tuple[str | None, str | None]]) -> np.ndarray:
    """Twice the matching characters over all characters of both, each pair of different texts counted once; 0 if one is empty or missing."""
    seen: dict[tuple[str, str], int] = {}
    at = np.array([-1 if not x or not y else -2 if x == y else seen.setdefault((x, y), len(seen)) for x, y in pairs], np.int64)
    return np.r_[matching_ratios(seen), 1.0, 0.0][at]


def _matching_ratios(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(distinct_ratios(zip(left, right, strict=True)), dtype="float64")


def sequence_ratio(a: Column, b: Column, equal_first: bool = True) -> Column:
    """Twice the matching characters over all characters of both; 0 if one is empty.

    Asymmetric, and with the library's rule for popular characters from 200 on,
    so ``a`` has to be the left text. Only pairs that need it visit Python.
    """
    open_ = (a != "") & (b != "") & (a != b) if equal_first else (a != "") & (b != "")
    value = F.coalesce(F.pandas_udf(_matching_ratios, "double")(F.when(open_, a), F.when(open_, b)), F.lit(0.0))
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(value)


def sequence_ratios(pairs: dict[str, tuple[Column, Column]]) -> dict[str, Column]:
    """:func:`sequence_ratio` of several pairs of texts, matched together in one visit of Python."""
    names = list(pairs)

    def each(*texts: pd.Series) -> pd.DataFrame:
        rows = len(texts[0])
        found = distinct_ratios(x for k in range(len(names)) for x in zip(texts[2 * k], texts[2 * k + 1], strict=True))
        return pd.DataFrame(found.reshape(len(names), rows).T, columns=names)

    out = F.pandas_udf(each, ", ".join(f"{n} double" for n in names))(*(c for pair in pairs.values() for c in pair))
    return {n: out[n] for n in names}


def token_sort_ratio(a_sorted: Column, b_sorted: Column) -> Column:
    return sequence_ratio(a_sorted, b_sorted)


def _share(common: Column, either: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(common).cast("double"), F.size(either)), F.lit(0.0))


def token_jaccard(a: Column, b: Column) -> Column:
    """Common over all distinct words; 0 if one text is empty."""
    x, y = tokens(a), tokens(b)
    return F.when((a == "") | (b == ""), 0.0).otherwise(_share(F.array_intersect(x, y), F.array_union(x, y)))


def token_set_ratio(a: Column, b: Column) -> Column:
    """Best sequence ratio of the common words against either sorted set; 0 without a common word."""
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    common = F.array_join(F.array_sort(F.array_intersect(x, y)), " ")
    left, right = (F.array_join(F.array_sort(z), " ") for z in (x, y))
    best = F.greatest(sequence_ratio(common, left), sequence_ratio(common, right), sequence_ratio(left, right))
    return F.when(common == "", 0.0).otherwise(best)


def char_ngrams(a: Column, n: int = 3) -> Column:
    """Distinct character n-grams, blanks included; [] for texts shorter than n."""
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(a) - (n - 1), F.lit(1))), lambda i: F.substr(a, i, F.lit(n)))
    return F.when(F.length(a) < n, F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def char_jaccard(a: Column, b: Column, n: int = 3) -> Column:
    x, y = char_ngrams(a, n), char_ngrams(b, n)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(_share(F.array_intersect(x, y), F.array_union(x, y)))


def length_ratio(a: Column, b: Column) -> Column:
    """Shorter over longer length; 1 if both are empty, 0 if one is."""
    return number_ratio(F.length(a), F.length(b))


def number_ratio(x: Column, y: Column) -> Column:
    return F.when((x == 0) & (y == 0), 1.0).otherwise(F.coalesce(F.try_divide(F.least(x, y).cast("double"), F.greatest(x, y)), F.lit(0.0)))


def token_count_ratio(x: Column, y: Column) -> Column:
    """Length ratio of two texts of that many one-letter words, one word at least."""
    a, b = F.greatest(x, F.lit(1)) * 2 - 1, F.greatest(y, F.lit(1)) * 2 - 1
    return F.least(a, b).cast("double") / F.greatest(a, b)


def hashed(items: Column) -> Column:
    """Distinct 64-bit digests of an array of texts: sets that are cheap to move and to intersect."""
    return F.array_distinct(F.transform(items, lambda x: F.xxhash64(x)))


def set_jaccard(a: Column, b: Column) -> Column:
    """Common over all members of two arrays without repeats; 0 if one is empty."""
    common = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - common
    return F.coalesce(F.try_divide(common.cast("double"), either), F.lit(0.0))


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Weight of common over weight of all words of two ``struct(words, idfs, total)`` without repeated words; 0 if one is empty."""
    idf = lambda word: F.element_at(a["idfs"], F.array_position(a["words"], word).cast("int"))
    common = F.aggregate(F.array_intersect(a["words"], b["words"]), F.lit(0.0), lambda s, word: s + idf(word))
    return F.coalesce(F.try_divide(common, a["total"] + b["total"] - common), F.lit(0.0))


def variant_rewritten(a: Column, b: Column) -> Column:
    """``b`` with the spelling variants it shares with ``a`` rewritten towards ``a``, one after another.

    A fold over the table: nested conditions would repeat themselves at every step.
    """
    table = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y, _ in V.VARIANTS))
    return F.aggregate(table, b, lambda z, v: F.when(a.contains(v["x"]) & z.contains(v["y"]), F.replace(z, v["y"], v["x"])).otherwise(z))


def jaro_winkler(a: str, b: str) -> float:
    """Jaro-Winkler similarity with a prefix weight of 0.1 over four letters."""
    if a == b:
        return 1.0 if a else 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used = [False] * len(b)
    matched = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                matched.append(x)
                break
    if not matched:
        return 0.0
    moved = sum(x != y for x, y in zip(matched, (y for y, u in zip(b, used, strict=True) if u), strict=True)) // 2
    m = len(matched)
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro


def _jaro_winkler_each(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else jaro_winkler(a, b) for a, b in zip(left, right, strict=True)], dtype="float64")


def jaro_winkler_ratio(a: Column, b: Column) -> Column:
    return F.pandas_udf(_jaro_winkler_each, "double")(a, b)
