"""Names as text: canonical form, similarity, containment, token features. Null counts as the empty string."""

from __future__ import annotations

import unicodedata
from collections import Counter
from difflib import SequenceMatcher
from heapq import heappop, heappush
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that say nothing about which property is meant.
STOPWORDS = (
    "& 's 1 2 a and aparthotel apartment apartments at b beach bed bedroom best business by city cottage de del express guest guesthouse "
    "historic home hostel hotel hotels house i in la le les lodge motel on park residence resort spa studio suites the view villa with"
).split()
# Abbreviations, replaced as substrings in this order.
ABBREVIATIONS = {
    "suites": "ste", "stes": "ste", "airport": "ap", "arpt": "ap", "downtown": "dtwn", "dwtwn": "dtwn", "dwtn": "dtwn", "international": "intl",
    "homewood": "hmwd", "hilton": "hltn", "howard johnson": "hojo", "ii": "2",
}
SPACED, DELETED = "-&/'", r"[,.:;!|_()\[\]<>{}\"]"
ACCENTED = "áàâäãåāăąçćčďđéèêëēęěğíìîïīıłńñňóòôöõōőøřśšşșťțúùûüūůűýÿźžż"
PLAIN = "aaaaaaaaacccddeeeeeeegiiiiiilnnnoooooooorssssttuuuuuuuyyzzz"


def fold(c: Column) -> Column:
    """Lower case without accents, for the Latin letters listed; stays in the JVM."""
    return F.translate(F.lower(F.coalesce(c, F.lit(""))), ACCENTED, PLAIN)


@F.pandas_udf(T.StringType())
def strip_accents(s: pd.Series) -> pd.Series:
    """Every combining mark removed, in any script (decomposed form)."""
    return s.map(lambda x: None if x is None else "".join(ch for ch in unicodedata.normalize("NFD", x) if unicodedata.category(ch) != "Mn"))


def normalize(c: Column, local: Column | None = None, stopwords: bool = True) -> Column:
    """Canonical name: folded, punctuation out, abbreviations applied, stop words (global and ``local``, an array) dropped."""
    s = F.translate(fold(c), SPACED, " " * len(SPACED))
    s = F.regexp_replace(s, DELETED, "")
    for long, short in ABBREVIATIONS.items():
        s = F.replace(s, F.lit(long), F.lit(short))
    toks = F.filter(F.split(F.trim(s), r"\s+"), lambda t: t != "")
    if stopwords:
        toks = F.filter(toks, lambda t: ~t.isin(STOPWORDS))
        if local is not None:
            toks = F.filter(toks, lambda t: ~F.coalesce(F.array_contains(local, t), F.lit(False)))
    return F.array_join(toks, " ")


def ratio_of(a: str, b: str) -> float:
    """Twice the matching characters over all (Ratcliff-Obershelp); 0 if either is empty."""
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def _masks(a: str) -> dict[str, int]:
    """Places of each character in ``a`` as bits."""
    out: dict[str, int] = {}
    for i, ch in enumerate(a):
        out[ch] = out.get(ch, 0) | 1 << i
    return out


def _advance(rows: int, masks: dict[str, int], full: int, b: str) -> int:
    """State of the bit-parallel longest common subsequence after ``b``; its zeros are the length."""
    for ch in b:
        u = rows & masks.get(ch, 0)
        rows = (rows + u | rows - u) & full
    return rows


def common_of(a: str, b: str) -> int:
    """Length of the longest common subsequence; the characters that ``ratio_of`` matches are one, so they are no more."""
    full = (1 << len(a)) - 1
    return len(a) - _advance(full, _masks(a), full, b).bit_count()


def ratio_above(a: str, b: str, least: float = 0.0) -> float:
    """ratio_of where it can be above ``least``, else 0."""
    return ratio_of(a, b) if a and b and 2 * common_of(a, b) / (len(a) + len(b)) > least else 0.0


def swap_ratio_of(a: str, b: str, least: float = 0.0) -> float:
    """Best ratio of the sorted tokens, where the longer name may leave tokens out; anything up to ``least`` may come out as that or 0.

    Of names with k < n tokens, all choices of k - 1, k and k + 1 of the n count. They are searched from the highest
    bound down: a choice begun matches no more than its tokens and all those not decided yet would, and is no shorter
    than with the shortest of those. What can't be above the best so far is left, so the result is that of all choices.
    """
    x, y = sorted(a.split()), sorted(b.split())
    if len(x) == len(y):
        return ratio_above(" ".join(x), " ".join(y), least)
    if len(x) > len(y):
        x, y = y, x
    if not x:
        return 0.0
    short, best, count = " ".join(x), least, 0
    full, masks = (1 << len(short)) - 1, _masks(short)
    # Of the tokens from i on: their text, and the lengths of the shortest and the longest with a space each, summed up.
    rest = [" ".join(y[i:]) for i in range(len(y) + 1)]
    lengths = [sorted(len(t) + 1 for t in y[i:]) for i in range(len(y) + 1)]
    least_of = [[0, *accumulate(t)] for t in lengths]
    most_of = [[0, *accumulate(reversed(t))] for t in lengths]
    todo: list[tuple] = []

    def add(i: int, left: int, chosen: str, rows: int, matched: int) -> None:
        """A choice begun: ``left`` tokens to take from i on, its state, and what it matches with all of these (-1: not known)."""
        nonlocal count
        size = len(chosen) + least_of[i][left] - (not chosen)
        if left == len(y) - i:
            i, chosen, left = len(y), f"{chosen} {rest[i]}" if chosen and left else chosen or rest[i], 0
        elif left == 0:
            i, matched = len(y), len(short) - rows.bit_count()
        if matched < 0:
            end = _advance(rows, masks, full, rest[i] if not chosen else f" {rest[i]}") if left else _advance(full, masks, full, chosen)
            matched = len(short) - end.bit_count()
        top = min(matched, len(chosen) + most_of[i][left] - (not chosen))
        bound = 2 * top / (len(short) + max(size, top))
        if bound > best:
            count += 1
            heappush(todo, (-bound, count, i, left, chosen, rows, matched))

    for n in {len(x) - 1 or 1, len(x), len(x) + 1}:
        add(0, n, "", full, -1)
    while todo:
        bound, _, i, left, chosen, rows, matched = heappop(todo)
        if -bound <= best:
            break
        if left == 0:
            best = max(best, ratio_of(short, chosen))
            continue
        token = f" {y[i]}" if chosen else y[i]
        add(i + 1, left - 1, chosen + token, _advance(rows, masks, full, token), matched)
        add(i + 1, left, chosen, rows, -1)
    return best


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio_of(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def swap_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([swap_ratio_of(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


#: ``letter_bits`` counts characters in groups, up to 8 of each in the bits of longs and the others in one number.
LETTER_GROUPS = 32


@F.pandas_udf(T.ArrayType(T.LongType()))
def letter_bits(s: pd.Series) -> pd.Series:
    """Counts of a name's characters by LETTER_GROUPS groups: four longs of unary counts, what goes beyond those, its length and its words."""

    def one(x: str | None) -> list[int]:
        words = (x or "").split()
        # With whatever stands between words as well as with one space, so that it holds for sorted words too.
        plain, bits, over = " ".join(words), 0, 0
        for group, n in (Counter(ord(ch) % LETTER_GROUPS for ch in x or "") | Counter(ord(ch) % LETTER_GROUPS for ch in plain)).items():
            bits |= (1 << min(n, 8)) - 1 << 8 * group
            over += max(0, n - 8)
        longs = [bits >> 64 * i & (1 << 64) - 1 for i in range(4)]
        return [*(v - (1 << 64) if v >> 63 else v for v in longs), over, min(len(x or ""), len(plain)), len(words)]

    return s.map(one)


def bits_bound(a: str, b: str, swap: bool = False) -> Column:
    """No ratio (or token-swap ratio) of two names is above this, by the characters they share; columns of ``letter_bits``."""
    at = lambda c, i: F.get(F.col(c), F.lit(i))
    m = F.least(at(a, 4), at(b, 4))
    for i in range(4):
        m = m + F.bit_count(at(a, i).bitwiseAND(at(b, i)))
    both = at(a, 5) + at(b, 5)
    if swap:
        # Of the longer name words may be left out, but no fewer characters than match are in what stays.
        both = F.when(at(a, 6) == at(b, 6), both).when(at(a, 6) < at(b, 6), at(a, 5) + m).otherwise(at(b, 5) + m)
    return F.coalesce(F.try_divide(2.0 * m, both), F.lit(0.0))


def included(a: Column, b: Column) -> Column:
    """Whether one name, without its spaces, holds the other; False if either is empty."""
    x, y = F.replace(F.coalesce(a, F.lit("")), F.lit(" "), F.lit("")), F.replace(F.coalesce(b, F.lit("")), F.lit(" "), F.lit(""))
    return (x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x))


def feature_name(c: Column) -> Column:
    """Names fit for columns: an underscore first, separators as underscores, < and > spelled out, the rest dropped."""
    s = F.regexp_replace(F.concat(F.lit("_"), c), r"[ /-]", "_")
    s = F.replace(F.replace(s, F.lit(">"), F.lit("greater")), F.lit("<"), F.lit("lower"))
    return F.regexp_replace(s, r"[^A-Za-z0-9_]", "")


def items(c: Column, sep: str = ",") -> Column:
    """Trimmed, non-blank members of a separated list; an empty array for null."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), sep), F.trim), lambda x: x != "")


def room_size(c: Column) -> Column:
    """Square metres named in a facility string, else 0."""
    return F.coalesce(F.regexp_extract(c, r"(\d+(?:\.\d+)?) *m²", 1).try_cast("double"), F.lit(0.0))


def room_views(c: Column) -> Column:
    """Views named in a facility string: the member with the word, split at slashes, without the word."""
    named = F.filter(items(c), lambda x: F.contains(F.lower(x), F.lit("view")))
    return F.flatten(F.transform(named, lambda x: F.transform(F.split(x, "/"), lambda v: F.trim(F.regexp_replace(v, "(?i)view", "")))))


def ascii_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")
