"""Keyword-stuffed pages and link lists among documents of commits."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.arrow import map_rows
from tallyweave.llm.lookalikes import fold

# Frequent function words of the four languages.
FUNCTION = """
the a an of to in on and or is are was were be it its this that these those for from with as at by not no we i you he they but so if then than can may
could should will would when which who what nobody any more only first before after here there has have had do does did
der die das den dem des ein eine einen einem und oder ist sind war waren wird werden auf in im an am mit von zu zum zur fur nicht nach noch aber danach wenn als liest steht
le la les un une des du de et ou est sont etait en dans sur pour par pas ne que qui ce cette ces il elle nous vous sera plus rien car puisque deja
el los las una unos del y es son era no se lo que para por con sin sobre este esta estos todo todos cada hasta nada
"""

_function = frozenset(FUNCTION.split())

_url = re.compile(r"(?:https?|ftp|rsync)\s?[:：]\s?//[^\s\"'<>\])|]+", re.I)
_bare_host = re.compile(r"\b(?:[a-z0-9-]+\.)+(?:invalid|example|test|com|net|org|info|biz|shop|online|ru|de|fr|es)\b(?:/\S*)?")
_arrow_host = re.compile(r">>\s*((?:[a-z0-9-]+\.)+[a-z]{3,}\S*)")
_hash_tag = re.compile(r"#([a-z][\w-]{3,})")
_tag_label = re.compile(r"^\W*[a-z0-9]+\s?:\s")
_span_tag = re.compile(r"<span class=\"?tag\"?>([^<]*)</span>")
_content = re.compile(r"<meta[^>]*content=\"([^\"]*)\"?[^>]*>?|<[^>]*>")
_own_use = re.compile(r"<loc>|\"resolved\"|\"integrity\"|\[!\[|\[[ x]\]|\(#\d+\)|\[#\d+\]|(?:ftp|rsync)://|refs?/|badge")
_word = re.compile(r"[a-z]{2,}")
_leet_token = re.compile(r"\b(?=[\w]*[a-z])(?=[\w]*[01345])[a-z01345]{3,}\b")
_leet = str.maketrans("01345", "oieas")
_code = re.compile(r"[{}=;()\[\]\"`]|\b\w+_\w+\b|->|::")
_header = ("commit ", "author:", "date:", "from ", "from:", "subject:", "authordate:", "index ", "---", "+++", "@@", "mime-", "content-", "message-id")
_owners = re.compile(r"\S+(?:\s+@[\w/-]+)+")
_hex_slug = re.compile(r"/[0-9a-f]{5,}(?:[/?.]|$)")
_numbered = re.compile(r"\(\d+\)")
# Words of links that name no page.
_no_page = frozenset("html htm php index id".split())

#: Least words of a list, and the part of its text that lists and links must hold.
WORDS, PART_SHARE = 20, 0.5
#: Share of function words from which a line is a sentence, and of code marks a word from which it is code.
SENTENCE, CODE = 0.15, 0.1
#: Least regularity of a list, see :func:`regularity`.
REGULAR = -0.13
#: Part of a list's text from which links make it a link list, least links, distinct hosts a link, and pages without words a link.
LINK_SHARE, LINKS, HOSTS, RANDOM = 0.4, 6, 0.7, 0.5
#: Distinct pages a link up to which many hosts offer the same, as mirrors do.
MIRROR = 0.25
#: Share of function words in link lines from which the links are described by sentences, and least share of regularly
#: recurring words of a link list without, less half the share of distinct ones.
DESCRIBED, LINK_REGULAR = 0.05, -0.46
#: Least recurrences of a term, gap that is short, spread of gaps that is even, and equal positions below which a lag is chance.
TIMES, SHORT_GAP, EVEN, MATCHES = 4, 16, 0.6, 5
#: Lags at which all equal positions are counted.
LAGS = 128


def parts(text: str) -> tuple[list[str], list[str], list[str]]:
    """Lines of the message, added lines and removed lines of a document."""
    message: list[str] = []
    added: list[str] = []
    removed: list[str] = []
    in_diff = False
    for line in text.splitlines():
        if line.startswith("diff --git ") or line.startswith(("--- a/", "+++ b/")):
            in_diff = True
        elif not in_diff:
            if not line.lower().startswith(_header):
                message.append(line)
        elif line[:1] == "+":
            if not line.startswith("+++ "):
                added.append(line[1:])
        elif line[:1] == "-" and not line.startswith("--- "):
            removed.append(line[1:])
    return message, added, removed


def plain_words(line: str) -> str:
    """A folded line with digits in the place of letters undone."""
    return _leet_token.sub(lambda m: m.group().translate(_leet), line)


def tag_words(tags: list[str]) -> list[str]:
    """Words of the tags of a line: parted at marks, and joined ones by words that other tags show apart."""
    split = [[w for w in re.split(r"[-_\W]+", plain_words(t)) if w] for t in tags]
    known = sorted({w for p in split if len(p) > 1 for w in p if len(w) > 2}, key=lambda w: (-len(w), w))
    out: list[str] = []
    for p in split:
        if len(p) == 1:
            w = p[0]
            k = next((k for k in known if w != k and (w.endswith(k) or w.startswith(k))), None)
            if k:
                p = [w[: -len(k)], k] if w.endswith(k) else [k, w[len(k) :]]
        out += p
    return out


def recurrence(words: list[str]) -> tuple[float, float]:
    """``(share, correlation)``: of words in terms that recur often in gaps shorter than chance or of even length, and
    the greatest share of positions that meet their term again at one and the same lag, over windows of every lag."""
    n = len(words)
    where: dict[str, list[int]] = {}
    for k, w in enumerate(words):
        where.setdefault(w, []).append(k)
    regular = 0
    lags = np.zeros(n + 1, dtype=np.int64)
    for at in where.values():
        if len(at) > 1:
            gaps = np.diff(at)
            np.add.at(lags, gaps, 1)
            if len(at) >= TIMES and (np.median(gaps) <= SHORT_GAP or gaps.std() <= EVEN * gaps.mean()):
                regular += len(at)
    # Short lags count every equal position, longer ones those that meet their term there for the first time.
    number = {w: k for k, w in enumerate(where)}
    codes = np.array([number[w] for w in words])
    for lag in range(1, min(LAGS, n // 2) + 1):
        lags[lag] = np.count_nonzero(codes[lag:] == codes[:-lag])
    lags[lags < MATCHES] = 0
    window = lags[: n // 2 + 1]
    peak = float((window / (n - np.arange(len(window)))).max()) if n else 0.0
    return regular / max(n, 1), peak


def regularity(words: list[str]) -> float:
    """How much more regularly the words of a list recur than those of any list of its length: regular share and a quarter
    of the autocorrelation, less the share of distinct words and what longer lists repeat by chance."""
    share, peak = recurrence(words)
    return share + 0.25 * peak - len(set(words)) / len(words) - 0.2 * math.log(len(words) / 50)


def is_filler(lines: list[str], removed_hosts: frozenset[str] = frozenset()) -> bool:
    """Whether the lines of one part of a document are for the most part filler.

    Every line is a sentence (function words), code, a line of tags, a line of links or
    one of a list. Where lists, tags and links outweigh the rest, their words decide: a
    list is filler if its terms recur more regularly than those of any text, a link list
    also if it leads to pages without words on many hosts. Links in the forms a project
    keeps for itself (sitemaps, lock files, badges, tasks, changelogs, owners, one path on many mirrors, replaced links) count as own text.
    """
    words: list[str] = []
    listed = linked = other = 0
    links = random_pages = described = named = 0
    hosts: set[str] = set()
    pages: set[str] = set()
    for line in lines:
        low = fold(line).strip()
        if not low:
            continue
        tags = _hash_tag.findall(low) + _span_tag.findall(low)
        if not tags and low.count(",") >= 4:
            items = [x.strip() for x in _tag_label.sub("", low).split(",") if x.strip()]
            single = [x for x in items if " " not in x]
            if len(single) > 0.8 * len(items):
                tags = single
        if len(tags) >= 3:
            words += tag_words(tags)
            listed += len(low)
            continue
        urls = _url.findall(low) if "//" in low else []
        if ">>" in low and not urls:
            urls = ["//" + h for h in _arrow_host.findall(low)]
        bare = _url.sub(" ", low) if urls else low
        if "<" in bare:
            bare = _content.sub(lambda m: " " + (m.group(1) or "") + " ", bare)
        if "." in bare:
            bare = _bare_host.sub(" ", bare)
        bare = plain_words(bare)
        found = _word.findall(bare)
        plain = sum(w in _function for w in found)
        if urls:
            fresh = [u.partition("//")[2] for u in urls]
            fresh = [u for u in fresh if plain_words(u).partition("/")[0] not in removed_hosts]
            if not fresh or _own_use.search(low) or plain >= 3 and plain >= 0.2 * len(found):
                other += len(low)
                continue
            links += len(fresh)
            linked += len(low)
            described += plain
            named += len(fresh) if found else 0
            words += found
            for u in fresh:
                host, _, page = plain_words(u).partition("/")
                slug = [w for w in _word.findall(page) if w not in _no_page]
                hosts.add(host)
                pages.add(page)
                words += slug
                random_pages += bool(_hex_slug.search("/" + u.partition("/")[2]))
        elif found:
            code = len(_code.findall(_numbered.sub(" ", bare)))
            if code >= 2 and code > CODE * len(found) or plain > SENTENCE * len(found) or _owners.fullmatch(low):
                other += len(low)
            else:
                listed += len(low)
                words += found
    if listed + linked <= PART_SHARE * (listed + linked + other):
        return False
    if linked > LINK_SHARE * (listed + linked + other):
        if links < LINKS or len(hosts) < HOSTS * links or len(pages) < MIRROR * links and 2 * named < links:
            return False
        if random_pages > RANDOM * links:
            return True
        if not words or described > DESCRIBED * len(words):
            return False
        share, _ = recurrence(words)
        return share - 0.5 * len(set(words)) / len(words) >= LINK_REGULAR
    return len(words) >= WORDS and regularity(words) >= REGULAR


def is_stuffed(text: str | None) -> bool:
    """Whether the message or the added lines of a document are mostly promotional filler; not for null, empty and blank texts."""
    if not text or not text.strip():
        return False
    message, added, removed = parts(text)
    before = frozenset(h for line in removed for h in (u.partition("//")[2].partition("/")[0] for u in _url.findall(fold(line)))) if added else frozenset()
    return is_filler(added, before) or is_filler(message)


def stuffed_pages(documents: DataFrame) -> DataFrame:
    """``(doc_id)`` of the documents that are keyword-stuffed or link lists, each once.

    Whole texts are judged, each by itself: no shuffle but for the distinct ids.
    """

    def rows(ids, texts) -> Iterator[tuple]:
        for i, text in zip(ids, texts, strict=True):
            if is_stuffed(text):
                yield (i,)

    picked = documents.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(picked, rows, "doc_id long").distinct()
