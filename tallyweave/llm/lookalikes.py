"""One consistent form for characters that look alike on the screen.

Two characters look alike here when one is a compatibility form of the other
that differs in width or in being a ligature or a number letter, when they are
letters of different scripts with the same shape, or when they are blanks of
different width. Case, accents and punctuation are visible. Ignorable characters
(zero width, soft hyphens, directional marks, variation selectors) do not show.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Letters of other scripts that have the shape of Latin letters,
# from the public confusables data of Unicode; each line maps one text to another.
SHAPES = (
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ABEZHIKMNOPTYXCJ"),
    ("ανορυιϲϳ", "avopuicj"),
    ("АВЕЅІЈКМНОРСТУХҮҺӀԌԚԜ", "ABESIJKMHOPCTYXYHIGQW"),
    ("аԁеһіјорԛѕсуүхԝ", "adehijopqscyyxw"),
    ("ԀՕՏՍ", "dOSU"),
    ("օոսցհ", "onugh"),
    ("ɡƖɑıƠꞬ", "glaiƠG"),
    ("‐‑", "--"),
)
# Letters with the shape of a capital I, which stand for a small l as well.
READINGS = {"Ι": "l", "І": "l", "Ӏ": "l"}
_shape = {a: b for left, right in SHAPES for a, b in zip(left, right, strict=True)}
_visible_format = {*range(0x600, 0x606), 0x6DD, 0x70F, 0x8E2, 0x110BD, 0x110CD}
_also_ignorable = {0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
_plain = re.compile(r"[!-~À-ž]*")


def is_ignorable(ch: str) -> bool:
    code = ord(ch)
    return code in _also_ignorable or unicodedata.category(ch) == "Cf" and code not in _visible_format


@lru_cache(maxsize=65_536)
def looks(ch: str) -> str:
    """What ``ch`` looks like: '' for ignorables, ' ' for blanks, else its consistent form."""
    if ch <= "~":
        return " " if ch.isspace() else ch
    if is_ignorable(ch):
        return ""
    if ch.isspace() or unicodedata.category(ch) == "Zs":
        return " "
    if ch in _shape:
        return _shape[ch]
    kind, code = unicodedata.decomposition(ch), ord(ch)
    if kind.startswith(("<wide>", "<narrow>", "<font>", "<noBreak>")) or 0xFB00 <= code <= 0xFB06 or 0x2160 <= code <= 0x217F or code in (0x2116, 0x212A, 0x212B):
        return "".join(map(looks, unicodedata.normalize("NFKC", ch)))
    return ch


class _Table(dict):
    """Translation table whose entries are worked out when first met."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, code: int) -> str:
        text = self.of(chr(code))
        if len(self) < 65_536:
            self[code] = text
        return text


def _bare(ch: str) -> str:
    spread = unicodedata.normalize("NFKD", looks(ch)).lower()
    kept = "".join(c for c in unicodedata.normalize("NFKD", spread) if not unicodedata.combining(c))
    return kept.replace("ß", "ss").replace("œ", "oe").replace("æ", "ae").replace("ø", "o")


_looks, _folds = _Table(looks), _Table(_bare)


def by_table(text: str) -> str:
    """``text`` in consistent characters, composed, without blanks at its ends."""
    if text.isascii() and text.isprintable():
        return text.strip()
    decomposed = unicodedata.normalize("NFD", text.translate(_looks))
    return unicodedata.normalize("NFC", decomposed.translate(_looks)).strip()


def is_plain(token: str) -> bool:
    """Whether every character already is in its consistent form."""
    return _plain.fullmatch(token) is not None and "ı" not in token


def fold(text: str) -> str:
    """Lower-case letters without accents: for comparing, not for display."""
    return text.lower() if text.isascii() else text.translate(_folds)
