"""Names as columns: normal form, transliteration, keyword matching. All but one rare case stay in the JVM."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What Unicode case folding and classes need in a Java pattern.
FLAGS = "(?iuU)"
#: White space at either end, as Python's strip sees it.
ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
BLANKS = r"(?U)[\s\x1c-\x1f]+"
APOSTROPHES = "[´`‘’ʼ]"
#: Letters that no decomposition brings to ASCII; fixed values.
LATIN = {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ı": "i", "ħ": "h", "Ħ": "H"}
#: Greek and Cyrillic letters in lower case, and what they are in Latin ones; fixed values.
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split(), strict=True))
CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщыэюяёєіїґ", "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch y e iu ia io ie i i g".split(), strict=True)) | {"ъ": "", "ь": ""}
SCRIPTS = GREEK | CYRILLIC
#: Quotes and dashes; fixed values.
MARKS = {"‘": "'", "’": "'", "ʼ": "'", "´": "'", "“": '"', "”": '"', "–": "-", "—": "-", "…": "...", "№": "No"}


def _bare(s: str, form: str) -> str:
    return "".join(c for c in unicodedata.normalize(form, s) if unicodedata.category(c) != "Mn")


@cache
def _one_to_one() -> tuple[str, str]:
    """Characters that lose their accents by becoming one other character."""
    pairs = [(chr(c), b) for c in range(0x80, 0x10000) if not 0xD800 <= c < 0xE000 and len(b := _bare(chr(c), "NFD")) == 1 and b != chr(c)]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


@cache
def _many() -> str:
    """A class of the characters that decompose to several: only those need Python."""
    found = [c for c in range(0x80, 0x10000) if not 0xD800 <= c < 0xE000 and len(_bare(chr(c), "NFD")) > 1]
    ranges: list[list[int]] = []
    for c in found:
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "\\x{10000}-\\x{10ffff}]"


@F.pandas_udf(StringType())
def _decomposed(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn"))


def without_accents(c: Column, exact: bool = False) -> Column:
    """Accents removed. exact: also where a character decomposes to several letters, in Python for those rows."""
    fast = F.regexp_replace(F.translate(c, *_one_to_one()), r"\p{Mn}", "")
    # all other rows go to Python as nulls only
    odd = c.rlike(_many())
    return F.when(odd, _decomposed(F.when(odd, c))).otherwise(fast) if exact else fast


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, ENDS, "")


def normalized_name(c: Column, exact: bool = False) -> Column:
    """Accents off, upper case, ends stripped; null stays null."""
    return stripped(F.upper(without_accents(c, exact)))


@cache
def _ascii_table() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    single, many, none = [], [], []
    for lower, to in SCRIPTS.items():
        # an accent may be part of the letter: it comes off with the letter's own table
        for ch, own in {lower: to, lower.upper(): to.capitalize()}.items():
            if len(ch) == 1:
                (single if len(own) == 1 else many if own else none).append((ch, own))
    for c in [*range(0x370, 0x3E0), *range(0x400, 0x482)]:
        ch = chr(c)
        base = _bare(ch, "NFD")
        if ch.lower() not in SCRIPTS and base != ch and base.lower() in SCRIPTS:
            to = SCRIPTS[base.lower()]
            to = to if base == base.lower() else to.capitalize()
            (single if len(to) == 1 else many).append((ch, to))
    for c in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), *range(0x2100, 0x2190), *range(0xFF00, 0xFF5F)]:
        ch = chr(c)
        to = LATIN.get(ch) or MARKS.get(ch) or _bare(ch, "NFKD")
        if to != ch and to.isascii():
            (single if len(to) == 1 else many).append((ch, to))
    several = tuple(x for x in many if x[0] in LATIN or x[0] in MARKS or x[0].lower() in SCRIPTS or _bare(x[0], "NFD").lower() in SCRIPTS)
    # translate() drops what has no counterpart
    return "".join(a for a, _ in [*single, *none]), "".join(b for _, b in single), several


def to_ascii(c: Column) -> Column:
    """Latin, Greek and Cyrillic letters and common marks as ASCII; symbols and emoji go, other scripts stay as they are."""
    source, target, many = _ascii_table()
    found = F.regexp_replace(F.translate(c, source, target), r"\p{Mn}", "")
    for ch, to in many:
        found = F.replace(found, F.lit(ch), F.lit(to))
    return F.regexp_replace(found, r"[\p{So}\p{Sk}\p{Cs}\p{Co}\x{fe0f}]", "")


def filter_key(c: Column) -> Column:
    """Apostrophes made alike, lower case."""
    return F.lower(F.regexp_replace(c, APOSTROPHES, "'"))


def spatial_name(c: Column) -> Column:
    """ASCII, lower case, inner white space made one space."""
    return stripped(F.regexp_replace(F.lower(to_ascii(c)), BLANKS, " "))


def keyword_name(c: Column) -> Column:
    """Lower case, ASCII, ends stripped; inner white space stays."""
    return stripped(to_ascii(F.lower(c)))


def any_pattern(patterns: Iterable[str]) -> str:
    return FLAGS + "|".join(f"(?:{p})" for p in patterns)


def matches(c: Column, pattern: str) -> Column:
    """rlike with null as no match."""
    return F.coalesce(c.rlike(pattern), F.lit(False))


def contains_text(c: Column, text: str) -> Column:
    """Case-insensitive literal search; null is no match."""
    return F.coalesce(F.contains(F.lower(c), F.lit(text.lower())), F.lit(False))


def literal(ch: str, blank: str | None = None) -> str:
    """A character as a pattern; blank: what a space stands for."""
    return blank if ch == " " and blank is not None else re.escape(ch)


def own_pattern(word: str, blank: str = r"\s*") -> str:
    """A keyword that counts as a pattern: spaces, escaped ones too, are blank, and its groups don't capture."""
    found, at, grouped = [], 0, 0  # up to grouped a group has been opened already
    while at < len(word):
        ch, step = word[at], 1
        if ch == "(" and at >= grouped and (end := word.find(")", at)) > at + 1:
            ch, grouped = "(?:", end
        elif word.startswith("\\ ", at):
            ch, step = literal(" ", blank), 2
        elif ch == " ":
            ch = literal(ch, blank)
        found.append(ch)
        at += step
    return "".join(found)


def trie_pattern(words: Iterable[str], blank: str | None = None) -> str:
    """A pattern that finds some of the words, shared beginnings written once.

    Only whether it matches counts: a word that extends another one adds nothing. blank:
    what a space in a word stands for.
    """
    root: dict = {}
    for word in words:
        node = root
        for ch in word:
            if "" in node:
                break
            node = node.setdefault(ch, {})
        else:
            node.clear()
            node[""] = None

    def shown(node: dict) -> str:
        tail = ""
        while len(node) == 1 and "" not in node:
            (ch, node), = node.items()
            tail += literal(ch, blank)
        if "" in node:
            return tail
        leaves = [c for c, n in node.items() if "" in n and c != " "]
        rest = [literal(c, blank) + shown(n) for c, n in node.items() if c not in leaves]
        if len(leaves) > 1:
            rest.append("[" + "".join(re.escape(c) if c.isascii() else c for c in leaves) + "]")
        else:
            rest += [literal(c, blank) for c in leaves]
        return tail + (rest[0] if len(rest) == 1 else "(?:" + "|".join(rest) + ")")

    return shown(root)


VOWELS = str.maketrans("áéíóúÁÉÍÓÚ", "aeiouAEIOU")
SPECIAL = re.compile(r"[\[\]().?*+^$|\\{}]")


def keyword_variants(keywords: Sequence[str]) -> list[str]:
    """The keywords, then those whose vowels lose their accents, in order, repeats left out."""
    bare = [k.translate(VOWELS) for k in keywords if k.translate(VOWELS) != k]
    return list(dict.fromkeys([*keywords, *bare]))


def keyword_pattern(keywords: Sequence[str]) -> str:
    """Finds a keyword at the start of a word, spaces optional. Keywords with special characters count as patterns."""
    plain = [k for k in keywords if not SPECIAL.search(k)]
    parts = [rf"\b{own_pattern(k)}\w*" for k in keywords if SPECIAL.search(k)]
    if plain:
        # letter case is folded here as far as one character stays one, the rest is left to the flags
        parts.insert(0, r"\b" + trie_pattern(sorted({k.lower() for k in plain}), r"\s*"))
    return FLAGS + "|".join(parts)


def first_keyword(c: Column, keywords: Sequence[str]) -> Column:
    """The first keyword, in order, that the text contains in any case; null if none."""
    if not keywords:
        return F.lit(None).cast("string")
    low = F.lower(c)
    pairs = F.array(*[F.struct(F.lit(k.lower()).alias("low"), F.lit(k).alias("word")) for k in keywords])
    found = F.get(F.filter(pairs, lambda p: F.contains(low, p["low"])), F.lit(0))["word"]
    return F.when(low.rlike(trie_pattern(sorted({k.lower() for k in keywords}))), found)
