"""Leaf blocks of an HTML page and their vectors, for ``html_extraction``.

``blocks`` walks the tags once, closes what HTML closes by itself (paragraphs, list items, table cells, whatever
an end tag leaves open) and yields the text between block boundaries in page order. Contents that are no
text of the page (scripts, styles, templates, controls) never become blocks. The tag path of a
block is a set of hashed tokens, carried as bits of one integer from parent to child, so a path of any
depth costs the same.
"""

from __future__ import annotations

import html as entities
import math
import re
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np

#: bits of a hashed tag path, and places of a hashed-word vector
PATH_BITS, WORD_PLACES = 256, 64

# Element names of the HTML standard by their role here.
#: elements that do not end a block
INLINE = set("a abbr acronym b basefont bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output "
             "picture progress q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr input".split())
#: elements without contents
VOID = set("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
#: elements whose contents are not markup; they end at their own end tag only
RAW = set("script style textarea title xmp iframe noembed noframes".split())
#: elements whose contents are no text of the page
HIDDEN = RAW | set("head noscript template svg math select datalist option optgroup button object canvas audio video map".split())
#: elements that a new one of their kind closes, up to the element that holds them
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
          "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "body": ({"head"}, {"html"})}

#: elements that may stand in a head; any other one ends it
IN_HEAD = set("title meta link script style base noscript template".split())

TAG = re.compile(r"""<!--.*?(?:-->|$)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)(?:>|$)|<[!?/][^>]*(?:>|$)""", re.S)
NAMING = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Element(NamedTuple):
    name: str
    bits: int  # hashed tokens of the path down to here
    tokens: tuple  # the element's own
    parent: Element | None
    hidden: bool


class Leaf(NamedTuple):
    text: str
    at: Element
    linked: int  # characters inside links


def _bit(token: str) -> int:
    return 1 << zlib.crc32(token.encode("utf-8", "surrogatepass")) % PATH_BITS


def tokens(name: str, attrs: str) -> tuple:
    """The element's name, and the words of its class, id, role and itemprop with their beginnings."""
    out = ["<" + name]
    for m in NAMING.finditer(attrs) if "=" in attrs else ():
        for w in WORDS.findall(m[2] or m[3] or m[4] or ""):
            w = w.lower()
            out.append(w)
            if len(w) > 4:
                out.append(w[:4] + "*")
    return tuple(out)


def blocks(page: str) -> list[Leaf]:
    """The leaf blocks of a page in page order; white space inside a block is one blank."""
    top = Element("", 0, (), None, False)
    seen: dict[tuple, int] = {}
    open_names: Counter = Counter()
    out: list[Leaf] = []
    pieces: list[str] = []
    linked = links = pos = 0
    at = top

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Leaf(text, at, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def pop():
        nonlocal at
        open_names[at.name] -= 1
        at = at.parent

    while pos < len(page):
        m = TAG.search(page, pos)
        stop = m.start() if m else len(page)
        if stop > pos and not at.hidden:
            t = page[pos:stop]
            t = entities.unescape(t) if "&" in t else t
            pieces.append(t)
            if links:
                linked += len(t.strip())
        if not m:
            break
        pos = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if name in INLINE and not at.hidden:
            if name == "br":
                pieces.append("\n")
            elif name == "a":
                links = max(0, links - 1) if m["end"] else 1
            continue
        flush()
        if m["end"]:
            links = 0
            if open_names[name] > 0:
                while at.name != name:
                    pop()
                pop()
            continue
        if name in VOID:
            continue
        if at.name == "p" and not at.hidden or at.name == "head" and name not in IN_HEAD:
            pop()
        if name in CLOSES:
            same, holder = CLOSES[name]
            if any(open_names[s] > 0 for s in same):
                e = at
                while e.parent is not None and e.name not in same and e.name not in holder:
                    e = e.parent
                if e.name in same:
                    while at is not e:
                        pop()
                    pop()
        own = tokens(name, m["attrs"])
        bits = seen.get(own)
        if bits is None:
            bits = 0
            for t in own:
                bits |= _bit(t)
            seen[own] = bits
        if m["attrs"].endswith("/") and name not in HIDDEN and "-" in name:
            continue  # a custom element closed in itself
        if name in RAW:
            end = RAW_END[name].search(page, pos)
            pos = end.start() if end else len(page)
        at = Element(name, at.bits | bits, own, at, at.hidden or name in HIDDEN)
        open_names[name] += 1
    flush()
    return out


_MIX = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
NUMBERS = 12
MARKS, DIGITS, SIGNS = re.compile("[.,;:!?]"), re.compile("[0-9]"), re.compile("[©|»·›→]")


def _words(texts: list[str]) -> np.ndarray:
    """Hashed-word counts of each text, scaled to length 1. Texts have single blanks and none at their ends."""
    data = np.frombuffer(" ".join(t.lower() for t in texts).encode("utf-8", "surrogatepass") + b" ", np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _MIX[place & 63], starts)
    bucket = (h * _MIX[0] >> np.uint64(58)).astype(np.int64)
    per = np.array([t.count(" ") + 1 for t in texts])
    counts = np.bincount(np.repeat(np.arange(len(texts)), per) * WORD_PLACES + bucket, minlength=len(texts) * WORD_PLACES).reshape(-1, WORD_PLACES)
    return counts / np.sqrt((counts * counts).sum(axis=1, keepdims=True))


def _numbers(leaf: Leaf, k: int, n: int) -> tuple:
    t = leaf.text
    words = t.count(" ") + 1
    marks = len(MARKS.findall(t))
    return (math.log1p(len(t)) / 8, math.log1p(words) / 6, leaf.linked / len(t), float(t[-1] in ".!?\"'»”…"), min(1.0, marks / words),
            float(t[:1].isupper()), min(2.0, len(t) / words / 10), float(SIGNS.search(t) is not None), min(1.0, len(DIGITS.findall(t)) / len(t)),
            k / n, math.log1p(n) / 6, float(words == 1))


def vectors(leaves: list[Leaf], places: list[int], sizes: list[int]) -> np.ndarray:
    """One vector per block: bits of the tag path, the element itself, hashed words, numbers; given its place in its page and the page's blocks."""
    out = np.zeros((len(leaves), WIDTH), np.float32)
    if not leaves:
        return out
    path = np.frombuffer(b"".join([x.at.bits.to_bytes(PATH_BITS // 8, "little") for x in leaves]), np.uint8).reshape(len(leaves), -1)
    out[:, :PATH_BITS] = np.unpackbits(path, axis=1, bitorder="little")
    out[np.arange(len(leaves)), [PATH_BITS + zlib.crc32(x.at.name.encode("utf-8", "surrogatepass")) % OWN for x in leaves]] = 1
    out[:, PATH_BITS + OWN:-NUMBERS] = _words([x.text for x in leaves])
    out[:, -NUMBERS:] = [_numbers(x, k, n) for x, k, n in zip(leaves, places, sizes)]
    return out


#: places of the element that holds the block
OWN = 32
WIDTH = PATH_BITS + OWN + WORD_PLACES + NUMBERS
