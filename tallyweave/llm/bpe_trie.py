"""Exact byte-pair encoding by a depth-first walk over a trie of distinct words.

The state of a trie node is the last token of the encoding of the word from the
root to that node. It follows from the states above it: among the tokens that
end at the node exactly one is compatible with the state at its own start, i.e.
byte-pair merging would keep the boundary between the two. A prefix shared by
many words is therefore encoded once, and a word's ids are read off by stepping
back from its node, token by token.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache
from itertools import islice

import numpy as np

DEFAULT_FOLDER = "/opt/tokenizers"
DEFAULT_FILE = "byte_bpe_50k.tiktoken"

# The published split pattern of this vocabulary, and the same
# pattern where all characters are ASCII.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"

#: Words kept per Python worker before the store is emptied, and characters of a
#: text above which its words are handled in slices rather than as one list.
WORDS_KEPT = 400_000
LONG_TEXT = 1_000_000


def vocabulary_path(path: str | None = None) -> str:
    """Place of the rank file: the argument, else the installed public tokenizers."""
    if path:
        return path
    try:
        import public_tokenizers

        return public_tokenizers.path(DEFAULT_FILE)
    except ImportError:
        return os.path.join(DEFAULT_FOLDER, DEFAULT_FILE)


class TrieEncoder:
    """Encoder over one rank file; keeps the words it has met."""

    def __init__(self, path: str | None = None):
        import regex

        with open(vocabulary_path(path), "rb") as lines:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        top = max(self.ids.values()) + 1
        self.lengths = [0] * top
        self.longest = max(map(len, self.ids))
        # The merge that makes each token: its two parts; a byte is its own part.
        self.left, self.right = list(range(top)), list(range(top))
        self.merged: dict[tuple[int, int], int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        for word, token in sorted(self.ids.items(), key=lambda x: x[1]):
            self.lengths[token] = len(word)
            for k in range(1, len(word)):
                a, b = self.ids.get(word[:k], top), self.ids.get(word[k:], top)
                if a < token and b < token and self._keeps(a, b):
                    self.left[token], self.right[token] = a, b
                    self.merged[a, b] = token
                    break
        self.fits.clear()
        self.words: dict[str, bytes] = {}
        self.any_pattern = regex.compile(PATTERN)
        self.ascii_pattern = re.compile(ASCII_PATTERN)

    def _keeps(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` side by side leaves them apart."""
        left, right, merged = self.left, self.right, self.merged
        bound = len(left)
        while True:
            if merged.get((a, b), bound) < bound:
                return False
            # Undo the later of the two merges and look across the boundary again.
            if a > b:
                bound, a = a, right[a]
                if a == bound:
                    bound, b = b + 1, left[b]
                    if b + 1 == bound:
                        return True
            else:
                bound, b = b + 1, left[b]
                if b + 1 == bound:
                    bound, a = a, right[a]
                    if a == bound:
                        return True

    def _last(self, word: bytes, end: int, states: list[int]) -> int:
        """State of the node at ``word[:end]`` from the states before it."""
        ids, fits = self.ids, self.fits
        for start in range(max(0, end - self.longest), end):
            token = ids.get(word[start:end])
            if token is None:
                continue
            if not start:
                return token
            pair = (states[start], token)
            ok = fits.get(pair)
            if ok is None:
                ok = fits[pair] = self._keeps(*pair)
            if ok:
                return token
        raise ValueError("the vocabulary lacks a byte")

    def learn(self, words: set[str]) -> None:
        """Encode words not met before, in trie order, sharing prefixes."""
        fresh = sorted((w.encode(), w) for w in words if w not in self.words)
        if len(self.fits) > 4 * WORDS_KEPT:
            self.fits.clear()
        # Sorted order is the depth-first order of the trie: the stack of states
        # holds the path to the current node and is cut back to the branching.
        states, path = [0], b""
        for word, text in fresh:
            shared = len(os.path.commonprefix((path, word)))
            del states[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                states.append(self._last(word, end, states))
            path = word
            out, at = [], len(word)
            while at:
                out.append(states[at])
                at -= self.lengths[states[at]]
            self.words[text] = np.array(out[::-1], np.int32).tobytes()

    def _split(self, text: str):
        pattern = self.ascii_pattern if text.isascii() else self.any_pattern
        if len(text) <= LONG_TEXT:
            yield pattern.findall(text)
            return
        found = (m.group() for m in pattern.finditer(text))
        while part := list(islice(found, 100_000)):
            yield part

    def encode(self, text: str | None) -> bytes:
        """Ids of ``text`` as little 32-bit integers; nothing for null or empty."""
        if not text:
            return b""
        done = []
        for part in self._split(text):
            try:
                done.append(b"".join(map(self.words.__getitem__, part)))
            except KeyError:
                if len(self.words) > WORDS_KEPT:
                    self.words.clear()
                self.learn(set(part))
                done.append(b"".join(map(self.words.__getitem__, part)))
        return b"".join(done)

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """As :meth:`encode` for many texts, whose new words share one trie walk."""
        short = [t for t in texts if t and len(t) <= LONG_TEXT]
        parts = {t: next(self._split(t)) for t in short}
        known = self.words
        fresh = {w for part in parts.values() for w in part if w not in known}
        if fresh:
            if len(known) + len(fresh) > WORDS_KEPT:
                known.clear()
                fresh = {w for part in parts.values() for w in part}
            self.learn(fresh)
        get = known.__getitem__
        return [b"".join(map(get, parts[t])) if t in parts else self.encode(t) for t in texts]


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> TrieEncoder:
    """The encoder of this Python worker, built once."""
    return TrieEncoder(path)
