"""Parse names and addresses typed by people into comparable parts.

``parse_name`` gives the words of an organisation's own name, its trade and its
number; ``parse_address`` gives house, street, town, postcode and unit. Which words
are trades, given names or no places says a :class:`Vocabulary`, learnt from the tables
in :mod:`vocabulary`. Both are pure functions of one text and it, and never fail: a null, an empty text and a
placeholder give ``None``.
"""

from __future__ import annotations

import re
from functools import lru_cache

import xxhash

from tallyweave.llm.lookalikes import fold

# Placeholders that stand for a missing text.
PLACEHOLDERS = frozenset("n/a na n.a. n.a - -- --- . ? none null nil unknown not available not known tbd xxx".split()) | {"not available", "not known", ""}

# Legal forms, joining words and other words that do not tell organisations apart.
FORMS = """inc incorporated llc ltd limited pvt private company co corp corporation group grp sons son bros brothers
traders trading trdrs enterprises enterprise entp sarl sas sa et fils and n p the dba ms messrs branch outlet unit main br no number de"""

# Kinds of street and their abbreviations, directions, units, labels of house numbers, words before a landmark.
STREET_KINDS = """street st str road rd lane ln la drive dr drv avenue ave av boulevard blvd boul bd court ct crt highway hwy hiway parkway pkwy pky
colony col cly marg mg chowk chk chauk nagar ngr ng sector sec sect galli rue chemin chem ch place pl"""
DIRECTIONS = "north south east west n s e w so no"
UNITS = "unit apt suite ste flat shop"
LABELS = "no plot door h hno house number plotno"
BESIDE = "near nr opp opposite behind beside adj adjacent next to above facing floor flr"
# Country names and their short forms.
COUNTRIES = """
us usa
in india ind bharat
fr france fra
"""

FORM_WORDS = frozenset(FORMS.split())
_kinds, _directions, _units, _labels, _beside = (frozenset(x.split()) for x in (STREET_KINDS, DIRECTIONS, UNITS, LABELS, BESIDE))
_country_of = {w: line.split()[0] for line in COUNTRIES.strip().split("\n") for w in line.split()}
#: Words of addresses whose kind is not learnt.
FIXED_WORDS = frozenset([*_kinds, *_directions, *_units, *_labels])


def deletions(word: str) -> set[str]:
    return {word[:k] + word[k + 1 :] for k in range(len(word))}


def within_one(a: str, b: str) -> bool:
    """Whether one insertion, deletion, substitution or swap of neighbours at most leads from ``a`` to ``b``."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1 :] == b[k + 1 :] or a[k : k + 2] == b[k : k + 2][::-1] and a[k + 2 :] == b[k + 2 :]
    return a[k + 1 :] == b[k:] if len(a) > len(b) else a[k:] == b[k + 1 :]


def _near_index(words) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for w in words:
        if len(w) >= 5:
            for d in {w} | deletions(w):
                found.setdefault(d, []).append(w)
    return found


def _nearest(word: str, near: dict[str, list[str]]) -> str:
    found = near.get(word)
    if found is None:
        for k in range(len(word)):
            found = near.get(word[:k] + word[k + 1 :])
            if found is not None:
                for w in found:
                    if within_one(word, w):
                        return w
        return word
    for w in found:
        if within_one(word, w):
            return w
    return word


_double = re.compile(r"(.)\1+")
_letters = str.maketrans({"w": "v", "z": "j", "x": "ks", "q": "k", "c": "k"})


def sound(word: str) -> str:
    """``word`` with the usual variants of spelling one sound made the same."""
    if "oo" in word or "ee" in word or "aa" in word or "ou" in word:
        word = word.replace("oo", "u").replace("ou", "u").replace("ee", "i").replace("aa", "a")
    if "h" in word:
        word = word.replace("ph", "f").replace("sh", "S").replace("ch", "C")
    word = word.translate(_letters).lower()
    return _double.sub(r"\1", word) if _double.search(word) else word


def is_missing(text: str | None) -> bool:
    """Null, empty, blank or a placeholder."""
    return text is None or fold(text).strip().strip(".") in PLACEHOLDERS or fold(text).strip() in PLACEHOLDERS


_initials = re.compile(r"\b([a-z])\.(?=[a-z]\b)")
_name_split = re.compile(r"[a-z]+|\d+")
_camel = re.compile(r"([a-z])([A-Z][a-z]{2})")
_ms = re.compile(r"\W*m\s*/\s*s\b")

# Kinds of words, found once for each distinct word of a worker.
_OWN, _TRADE, _GIVEN, _FORM, _LETTER = range(5)
_KIND, _UNIT, _LABEL, _DIRECTION, _OTHER, _PLACE = range(5, 11)


class Vocabulary:
    """Kinds of words, found once for each distinct word of a worker: trades and given names by class, words of addresses that name no place.

    Misspelt longer words count as the word they are one edit away from. Without
    learnt words every word is an own word or a place.
    """

    MOST = 400_000  # words remembered at once

    def __init__(self, trades: tuple, givens: tuple, spread: tuple):
        self.trades, self.givens = dict(trades), dict(givens)
        self.other = frozenset([*spread, *_beside, "cedex", *(w for w in _country_of if len(w) > 2)])
        self.name_near = _near_index([*self.trades, *self.givens, *(w for w in FORM_WORDS if len(w) > 6)])
        self.address_near = _near_index([*(w for w in _kinds if len(w) > 5), *(w for w in self.other if len(w) > 5)])
        self.names: dict[str, tuple] = {}
        self.places: dict[str, tuple] = {}
        self.made = trades, givens, spread

    @classmethod
    def of(cls, trades: dict[str, str], givens: dict[str, str], spread=()) -> Vocabulary:
        return _vocabulary(tuple(sorted(trades.items())), tuple(sorted(givens.items())), tuple(sorted(spread)))

    def __reduce__(self):
        return _vocabulary, self.made

    def name_word(self, word: str) -> tuple[int, str]:
        found = self.names.get(word)
        if found is None:
            if len(self.names) >= self.MOST:
                self.names.clear()
            found = self.names[word] = self._name_word(word)
        return found

    def _name_word(self, word: str) -> tuple[int, str]:
        for x in (word,) if len(word) < 5 else (word, _nearest(word, self.name_near)):
            if x in FORM_WORDS:
                return _FORM, x
            if x in self.trades:
                return _TRADE, self.trades[x]
            if x in self.givens:
                return _GIVEN, self.givens[x]
        return (_LETTER if len(word) == 1 else _OWN), sound(word)

    def address_word(self, word: str) -> tuple[int, str]:
        found = self.places.get(word)
        if found is None:
            if len(self.places) >= self.MOST:
                self.places.clear()
            found = self.places[word] = self._address_word(word)
        return found

    def _address_word(self, word: str) -> tuple[int, str]:
        for x in (word,) if len(word) < 6 else (word, _nearest(word, self.address_near)):
            if x in _units:
                return _UNIT, x
            if x in _labels:
                return _LABEL, x
            if x in _kinds:
                return _KIND, x
            if x in _directions:
                return _DIRECTION, x
            if x in self.other:
                return _OTHER, sound(x)
        return (_OTHER if len(word) < 3 else _PLACE), sound(word)


@lru_cache(maxsize=16)
def _vocabulary(trades: tuple, givens: tuple, spread: tuple) -> Vocabulary:
    """One vocabulary of the same words in a process, so that its tasks share what was found."""
    return Vocabulary(trades, givens, spread)


NOTHING = Vocabulary.of({}, {})


def parse_name(text: str | None, vocabulary: Vocabulary = NOTHING) -> tuple[list[str], str, str, str] | None:
    """``(words, trade, number, given)`` of a name; '' for a part that is not there.

    ``words`` are the own words in order, in sound form, single letters included
    where they stand for a word. A name of given names only has those for own words.
    """
    if text is None:
        return None
    if _camel.search(text):
        text = _camel.sub(r"\1 \2", text)
    low = fold(text).strip()
    if low in PLACEHOLDERS or low.strip(".") in PLACEHOLDERS:
        return None
    if "/" in low:
        low = _ms.sub(" ", low, count=1) if _ms.match(low) else low
    if "." in low:
        low = _initials.sub(r"\1", low)
    if "'" in low:
        low = low.replace("'", "")
    words, trade, number, givens, shorts = [], "", "", [], []
    name_word = vocabulary.name_word
    for w in _name_split.findall(low):
        if w[0] <= "9":
            number = w.lstrip("0") or "0"
            continue
        kind, x = name_word(w)
        if kind == _OWN:
            words.append(x)
        elif kind == _TRADE:
            trade = x
        elif kind == _GIVEN:
            givens.append(x)
        elif kind == _LETTER:
            shorts.append((len(words), x))
    if len(words) < 2 and shorts:
        for at, x in shorts[::-1]:
            words.insert(at, x)
    if not words and givens:
        words, givens = [sound(x) for x in givens], []
    return words, trade, number, givens[-1] if givens else ""


_address_split = re.compile(r"[a-z]+|\d+[a-z]?\b|\d+|[,;/#()]|-")
_ordinal = re.compile(r"\b\d+\s?(?:st|nd|rd|th)\s+(?:floor|flr|fl)\b|\b(?:gr|ground)\s+(?:floor|flr|fl)\b")
_apostrophe = re.compile(r"\b([ld])['’]")


def _ordinal_hint(low: str) -> bool:
    return "fl" in low


def parse_address(text: str | None, vocabulary: Vocabulary = NOTHING) -> tuple[str, list[str], str, str, str] | None:
    """``(house, street words, town, postcode, unit)`` in sound form; '' or [] for a part that is not there.

    Words that name no place part the others into runs; where no run is left, they stand for the street themselves.
    """
    if text is None:
        return None
    low = fold(text).strip()
    if low in PLACEHOLDERS or low.strip(".") in PLACEHOLDERS:
        return None
    if "'" in low or "’" in low:
        low = _apostrophe.sub(r"\1 ", low)
    if "." in low:
        low = _initials.sub(r"\1", low).replace(".", " ")
    if "sur-loue" in low:
        low = low.replace("sur-loue", "surloue")
    if _ordinal_hint(low):
        low = _ordinal.sub(",", low)
    post = unit = ""
    idle: list[str] = []
    address_word = vocabulary.address_word
    runs: list[tuple[str, list[str], bool]] = []  # number before, words, whether a kind of street follows
    run: list[str] = []
    before = number = label = ""
    tokens = _address_split.findall(low)
    for k, w in enumerate(tokens):
        first = w[0]
        if first >= "a":
            kind, x = address_word(w)
            if kind == _PLACE:
                if not run:
                    before, number = number, ""
                run.append(x)
                label = ""
                continue
            if run:
                runs.append((before, run, kind == _KIND))
                run = []
            if kind == _UNIT:
                label = "unit"
            elif kind == _LABEL:
                if label != "unit":
                    label = "label"
            elif kind == _OTHER:
                number = label = ""
                if len(x) > 2 and w not in _beside:
                    idle.append(x)
            continue
        if run:
            runs.append((before, run, False))
            run = []
        if "0" <= first <= "9":
            if len(w) == 3 and number == tokens[k - 1] and len(number) == 3 and k and w.isdigit() and number.isdigit():
                post, number, label = number + w, "", ""  # a postcode written in two groups
            elif len(w) in (5, 6) and w.isdigit():
                post, number, label = w, "", ""
            elif label == "unit":
                unit, label, number = w, "", ""
            elif label == "#" and number == "" and any(t[0].isdigit() and len(t) < 5 for t in tokens[k + 1 : k + 3]):
                unit, label = w, ""
            else:
                if number and not unit:
                    unit = number
                number, label = w, ""
        elif first == "#":
            label = "#"
    if run:
        runs.append((before, run, False))
    if not runs:
        return number, idle[:2], "", post, unit
    # The street is the run after the house number, else one before a kind of street, else the first pair.
    best = max(range(len(runs)), key=lambda k: (bool(runs[k][0]) * 2 + runs[k][2] + (len(runs[k][1]) > 1), -k)) if len(runs) > 1 else 0
    before, street, kind = runs[best]
    rest = runs[:best] + runs[best + 1 :]
    if not before and not kind and len(street) < 2 and not number:
        street, rest = [], runs  # a lone word is a town
    house = before or number
    town = rest[-1][1][-1] if rest else ""
    if not rest and len(street) > 2:
        street, town = street[:-1], street[-1]
    return house, street, town, post, unit


@lru_cache(maxsize=4_096)
def country_code(text: str | None) -> str:
    """Short code of a country label; '' for none or a placeholder, an unknown label folded."""
    low = re.sub(r"[^a-z]", "", fold(text or ""))
    return "" if low in PLACEHOLDERS else _country_of.get(low, low)


def name_code(text: str | None, vocabulary: Vocabulary = NOTHING) -> str:
    """Parsed name as ``words|trade|number|given`` in sound form; '' for a missing name."""
    x = parse_name(text, vocabulary)
    if x is None or not x[0] and not x[1] and not x[2]:
        return ""
    return f"{' '.join(x[0])}|{x[1]}|{x[2]}|{x[3]}"


def address_code(text: str | None, vocabulary: Vocabulary = NOTHING) -> str:
    """Parsed address as ``house|street|town|postcode|unit`` in sound form; '' for a missing one."""
    x = parse_address(text, vocabulary)
    if x is None or not any(x):
        return ""
    return f"{x[0]}|{' '.join(x[1])}|{x[2]}|{x[3]}|{x[4]}"


@lru_cache(maxsize=200_000)
def letters_of(word: str) -> int:
    """The set of the letters of a word as bits."""
    mask = 0
    for ch in word:
        mask |= 1 << (ord(ch) & 31)
    return mask


def edits(a: str, b: str, most: int = 4) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours between two words, ``most`` at most."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) >= most:
        return most
    if within_one(a, b):
        return 1
    # An edit changes at most two letters of the difference between the sets of letters.
    if most <= 2 or (letters_of(a) ^ letters_of(b)).bit_count() > 2 * (most - 1):
        return most
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = [i + 1]
        for j, y in enumerate(b):
            d = last[j] if x == y else 1 + min(last[j], last[j + 1], row[j])
            if i and j and x == b[j - 1] and a[i - 1] == y and before[j - 1] + 1 < d:
                d = before[j - 1] + 1
            row.append(d)
        if min(row) >= most:
            return most
        before, last = last, row
    return min(most, last[-1])


def _typos(a: str, b: str, reach: float = 1.45) -> float:
    """Cost of reading ``a`` as a misspelt ``b`` by length: 0 equal, up to ``reach`` misspelt, 3 another word."""
    unit = max(1.0, 0.3 * max(len(a), len(b)))
    most = int(reach * unit) + 1
    d = edits(a, b, most)
    return 3.0 if d == most else d / unit


@lru_cache(maxsize=100_000)
def split_code(code: str) -> tuple[str, ...]:
    return tuple(code.split("|"))


def words_cost(a: str, b: str) -> float:
    """Cost between two lists of name words: 0 equal, below 1 the same with typos, swapped, joined or shortened words."""
    if a == b:
        return 0.0
    x, y = a.split(), b.split()
    if len(x) == 2 == len(y):
        straight, crossed = _pair_cost(x[0], y[0], x[1], y[1]), _pair_cost(x[0], y[1], x[1], y[0]) + 0.1
        if min(straight, crossed) < 1.5 or min(map(len, (*x, *y))) > 3:
            return min(straight, crossed)
    elif len(x) == 1 or len(y) == 1:
        short, long = (x, y) if len(x) == 1 else (y, x)
        if short and short[0] in long and len(short[0]) > 3:
            return 0.55  # a word is missing
    joined = "".join(x)
    best = _typos(joined, "".join(y)) + 0.1
    if len(y) > 1:
        best = min(best, _typos(joined, "".join(y[1:] + y[:1])) + 0.2)
    if len(x) > 1:
        best = min(best, _typos("".join(x[1:] + x[:1]), "".join(y)) + 0.2)
    return best


def _pair_cost(a: str, b: str, c: str, d: str) -> float:
    if a == b and len(a) > 3 and min(len(c), len(d)) > 2:
        two = 0.55 * _typos(c, d, 1.7)  # next to an equal word a bad misspelling is likelier
        return two if two < 1 else 2.0
    if c == d and len(c) > 3 and min(len(a), len(b)) > 2:
        one = 0.55 * _typos(a, b, 1.7)
        return one if one < 1 else 2.0
    one = _word_cost(a, b)
    if one >= 1:
        return 2.0
    two = _word_cost(c, d)
    return one + two if two < 1 else 2.0


def _word_cost(a: str, b: str) -> float:
    if a == b:
        return 0.0
    if len(a) == 1 or len(b) == 1:
        return 0.35 if a[:1] == b[:1] or {a[:1], b[:1]} in ({"c", "k"}, {"p", "f"}) else 1.0
    return 0.7 * _typos(a, b) if min(len(a), len(b)) > 2 else 1.0


def name_cost(a: str, b: str) -> float | None:
    """Cost between two name codes; None if one is missing, 9 for another trade or number."""
    if not a or not b:
        return None
    x, y = split_code(a), split_code(b)
    if x[2] != y[2] or x[1] and y[1] and x[1] != y[1]:
        return 9.0
    if not x[0] or not y[0]:
        return None
    cost = words_cost(x[0], y[0])
    if x[3] and y[3] and x[3] != y[3]:
        cost += 0.15
    return cost + 0.1 * (x[1] != y[1])


def same_post(a: str, b: str) -> bool:
    """Equal postcodes, or such with two neighbouring digits swapped or one digit wrong."""
    return within_one(a, b)


def address_evidence(a: str, b: str) -> tuple[float, int] | None:
    """``(evidence, shared parts)`` that two address codes name one place; None if one is missing.

    Evidence is positive for agreement and below 0 for a contradiction.
    """
    if not a or not b:
        return None
    x, y = split_code(a), split_code(b)
    shared, score = 0, 0.0
    if x[0] and y[0]:
        if x[0] != y[0]:
            return -3.0, 0
        score, shared = score + 1, shared + 1
    if x[1] and y[1]:
        cost = words_cost(x[1], y[1])
        if cost >= 1:
            return -3.0, shared
        score, shared = score + 2 - cost, shared + 1
    post = x[3] and y[3] and same_post(x[3], y[3])
    if x[2] and y[2]:
        if _typos(x[2], y[2]) >= 1:
            if not post:
                return -2.0, shared
        else:
            score, shared = score + 0.7, shared + 1
    if x[3] and y[3]:
        if not post:
            if not (x[2] and y[2]) or x[3][:2] != y[3][:2] and sorted(x[3]) != sorted(y[3]):
                return -1.5, shared
            score -= 0.5
        else:
            score, shared = score + 1, shared + 1
    return score, shared


# Kinds of keys, so that equal texts of different kinds stay apart.
_KEY_WORD, _KEY_OUTER, _KEY_HOUSE, _KEY_STREET, _KEY_PLACE = range(5)


def _key(kind: int, text: str) -> int:
    return xxhash.xxh64_intdigest(text, kind) - (1 << 63)


def name_keys(n: str, outer: bool = True) -> list[int]:
    """Keys of a name code: each word, and the outer letters of its joined words in both orders."""
    words = [w for w in n.partition("|")[0].split() if len(w) > 2]
    keys = [_key(_KEY_WORD, w) for w in words]
    if outer and words:
        turned = "".join(words[1:] + words[:1])
        joined = "".join(words)
        keys += {_key(_KEY_OUTER, joined[:3] + joined[-3:]), _key(_KEY_OUTER, turned[:3] + turned[-3:])}
    return keys


def address_keys(a: str, bare: bool = True) -> list[int]:
    """Keys of an address code: the house with each word of the street; the bare street too, or only where the house is missing."""
    if not a:
        return []
    house, street = split_code(a)[:2]
    words = [w for w in street.split() if len(w) > 2]
    keys = [_key(_KEY_HOUSE, f"{house} {w}") for w in words] if house else []
    if words and (bare or not house):
        keys.append(_key(_KEY_STREET, " ".join(sorted(words))))
    return keys


def place_tokens(a: str) -> tuple[list[int], list[int]]:
    """Tokens of an address code: the words of the street; the house with the town and with the postcode."""
    house, street, town, post = split_code(a)[:4]
    return [_key(_KEY_WORD, w) for w in street.split() if len(w) > 2], [_key(_KEY_PLACE, f"{house} {x}") for x in (town, post) if house and x]
