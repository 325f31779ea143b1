"""Names and positions of places as people type them: canonical tokens, bit codes and pairwise comparison."""

from __future__ import annotations

import re
import unicodedata
import zlib
from functools import lru_cache

# Words by kind. Articles and extras say nothing about which place is meant.
NOISE = frozenset("the el la le les los las il lo der die das zum zur am im an a o os as and und och y et e i ve and spa wellness restaurant restaurante adults only new nuevo hotels".split())
#: Kinds of houses: the same house is listed under several, so they weigh little.
KINDS = frozenset("hotel hostel hostal apartments guesthouse inn lodge manor suites pension gasthof gastehaus landhaus schlosshotel ferienhof haus casa posada parador hacienda residence relais chateau logis auberge solar pousada quinta pensjonat zajazd dwor konak pansiyon butik stugor vardshus gard royal grand grande grosses altes neues gamla lilla stora eski buyuk kucuk novo nova old nuevo".split()) - {"old", "nova", "nuevo"}
_LONG_KINDS = sorted(x for x in KINDS if len(x) > 4)
SHORT = {
    "htl": "hotel", "hotell": "hotel", "hotelli": "hotel", "apts": "apartments", "appartements": "apartments", "apartment": "apartments", "gh": "guesthouse", "gasteh": "gastehaus",
    "pens": "pension", "pensionat": "pension", "ctr": "centre", "center": "centre", "cntr": "centre", "stn": "station", "sta": "station", "conv": "convention", "stes": "suites", "ste": "suites", "rsts": "resorts", "rst": "resorts",
    "htls": "hotels", "intl": "international", "coll": "collection", "res": "residences", "grp": "group", "bout": "boutique", "twn": "town", "apto": "airport", "arpt": "airport", "otl": "hotel", "otel": "hotel", "resid": "residence", "rsd": "residence", "h": "hotel", "konagi": "konak", "willa": "villa",
}
_TRANS = str.maketrans({"ß": "ss", "ı": "i", "ł": "l", "Ł": "l", "ø": "o", "Ø": "o", "æ": "a", "Æ": "a", "œ": "o", "đ": "d", "ð": "d", "þ": "s", "’": "", "'": "", "´": "", "`": ""})
_SPLIT = re.compile(r"[^a-z0-9]+")
_INITIALS = re.compile(r"\b(?:[a-z]\.){2,}")
_STARS = re.compile(r"\*+\s*s?\b|\*+")
_UMLAUT = re.compile(r"([aou])e")
_CAMEL = re.compile(r"(?<=[a-zß-öø-ÿı]{2})(?=[A-ZÀ-ÖØ-ÞŁŚŻŞİ][a-zß-öø-ÿı])")
#: Additions that aren't part of a name.
_EXTRA = re.compile(r",?\s+a\s+[\w ]+\s+propert\w*|\bby the park\b|\bb\s*&\s*b\b|\badults? only\b|\(new\)")
#: Where in a town a house of a chain stands: two that name different places are different houses.
PLACES = {"riverside": "river", "north": "north", "south": "south", "airport": "airport", "park": "park", "harbour": "harbour", "convention": "convention", "station": "station", "central": "station", "city": "city", "town": "old"}
LONG_NOISE = ("restaurant", "wellness", "adults", "property")


@lru_cache(maxsize=100_000)
def fold_text(s: str) -> str:
    s = unicodedata.normalize("NFKD", s.translate(_TRANS).lower().translate(_TRANS))
    return "".join(c for c in s if not unicodedata.combining(c))


def tokens(name: str | None) -> list[str]:
    """Canonical tokens without noise, in the order typed; empty for null, blank or noise-only names."""
    if not name:
        return []
    s = _EXTRA.sub(" ", _STARS.sub(" ", fold_text(_CAMEL.sub(" ", name))))
    s = _INITIALS.sub(lambda m: " " + m.group().replace(".", "") + " ", s)
    out = []
    for t in _SPLIT.split(s):
        if not t:
            continue
        t = SHORT.get(t, t)
        out += ["city", "centre"] if t == "downtown" else [t]
    if "guest" in out or "house" in out:
        out = [t for t in out if t not in ("guest", "house")] + ["guesthouse"]
    return [t for t in out if not is_noise(t)] or out


def within_one(a: str, b: str) -> bool:
    """Whether one insertion, deletion, change or exchange of neighbours makes the one of the other."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[2:] == y[2:] and x[:2] == y[1::-1])


@lru_cache(maxsize=200_000)
def is_noise(t: str) -> bool:
    return t in NOISE or (len(t) > 5 and any(within_one(t, x) for x in LONG_NOISE))


@lru_cache(maxsize=200_000)
def collapse(t: str) -> str:
    """The form in which ae, oe and ue are the plain vowel."""
    return _UMLAUT.sub(r"\1", t)


def qgrams(toks: list[str]) -> set[str]:
    """Pairs of characters of each token with its ends marked, so that the order of tokens is of no account."""
    return {p[i : i + 2] for t in toks for p in (f"^{collapse(t)}$",) for i in range(len(p) - 1)}


@lru_cache(maxsize=200_000)
def token_bits(t: str, width: int) -> int:
    """Bit vector of one token's q-grams; a name's is that of all its tokens together."""
    return bits(qgrams([t]), width)


@lru_cache(maxsize=200_000)
def letters(t: str) -> int:
    """The characters of a token as a set of bits: each edit takes at most one of them away."""
    out = 0
    for c in t:
        out |= 1 << (ord(c) & 63)
    return out


def bits(grams: set[str], width: int) -> int:
    """Bit vector of q-grams, one bit each."""
    out = 0
    for g in grams:
        out |= 1 << (zlib.crc32(g.encode()) * 2654435761 % 4294967291 % width)
    return out


def words64(code: int, n: int) -> list[int]:
    """The code as n signed 64-bit integers."""
    return [((code >> (64 * i)) & (2**64 - 1)) - ((code >> (64 * i + 63) & 1) << 64) for i in range(n)]


def banded_distance(a: str, b: str, k: int) -> int:
    """Edit distance with exchanges of neighbours as one edit, or k + 1 if it is more than k: only 2k + 1 diagonals are filled."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    if abs(n - m) > k:
        return k + 1
    big = k + 1
    before: list[int] = []
    prev = [j if j <= k else big for j in range(m + 1)]
    for i in range(1, n + 1):
        lo, hi = max(1, i - k), min(m, i + k)
        row = [big] * (m + 1)
        if i <= k:
            row[0] = i
        best = row[0]
        for j in range(lo, hi + 1):
            d = min(prev[j - 1] + (a[i - 1] != b[j - 1]), prev[j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d = min(d, before[j - 2] + 1)
            row[j] = d
            if d < best:
                best = d
        if best > k:
            return big
        before, prev = prev, row
    return min(prev[m], big)


@lru_cache(maxsize=200_000)
def token_similarity(a: str, b: str) -> float:
    """1 for equal tokens, else 1 - edits / length for few edits, else 0; an initial part of four letters or more counts half."""
    if a == b or collapse(a) == collapse(b) or ("apt" in (a, b) and {a, b} & {"airport", "apartments"}):
        return 1.0
    n = max(len(a), len(b))
    k = 1 if n <= 5 else 2 if n <= 9 else 3
    d = k + 1
    for x, y in {(a, b), (collapse(a), collapse(b))}:
        u, v = letters(x), letters(y)
        if abs(len(x) - len(y)) <= k and (u & ~v).bit_count() <= k and (v & ~u).bit_count() <= k:
            d = min(d, banded_distance(x, y, k))
    if d <= k:
        return 1 - d / n
    if min(len(a), len(b)) >= 4 and (a.startswith(b) or b.startswith(a)):
        return 0.5
    return 0.0


@lru_cache(maxsize=200_000)
def kind(t: str) -> str | None:
    """The kind of house a token names, one typing error allowed."""
    if t in KINDS:
        return t
    return next((x for x in _LONG_KINDS if within_one(t, x)), None)


@lru_cache(maxsize=200_000)
def place(t: str) -> str | None:
    if t in PLACES:
        return PLACES[t]
    return next((v for x, v in PLACES.items() if len(x) > 4 and within_one(t, x)), None)


def weight(t: str, light: frozenset) -> float:
    return 0.15 if any(token_similarity(t, x) >= 0.75 for x in light) else 0.5 if kind(t) or place(t) or t in ("centre", "apt") else 0.3 if len(t) <= 2 else 1.0


def name_similarity(a: list[str], b: list[str], light: frozenset = frozenset()) -> float:
    """Weighted share of the tokens of both names that have a partner in the other, 0 to 1.

    Kinds of houses and the tokens in ``light`` (the town) weigh less; two names with kinds of which none
    agrees are marked down, for houses of one family name differ by it. A word may be the partner of two
    words written together. 0 if either name is empty.
    """
    if not a or not b:
        return 0.0
    wa, wb = [weight(t, light) for t in a], [weight(t, light) for t in b]
    pairs = sorted(((token_similarity(x, y), i, j) for i, x in enumerate(a) for j, y in enumerate(b)), reverse=True)
    ua, ub, got = {}, {}, 0.0
    for s, i, j in pairs:
        if s <= 0:
            break
        if i not in ua and j not in ub:
            ua[i], ub[j] = s, s
            got += s * (wa[i] + wb[j])
    for x, used, wx, y, other, wy in ((a, ua, wa, b, ub, wb), (b, ub, wb, a, ua, wa)):
        for i, t in enumerate(x):
            if used.get(i, 0) < 0.6 and len(t) >= 6:
                for j, u in enumerate(y):
                    for k, v in enumerate(y):
                        if j != k and other.get(j, 0) < 0.6 and other.get(k, 0) < 0.6 and (d := banded_distance(t, u + v, 2)) <= 2 and i not in used:
                            s = 1 - d / len(t)
                            used[i] = other[j] = other[k] = s
                            got += s * (max(wx[i], wy[j] + wy[k]) + wy[j] + wy[k])
                            wx[i] = max(wx[i], wy[j] + wy[k])
    score = got / (sum(wa) + sum(wb))
    ka, kb = {k for t in a if (k := kind(t))}, {k for t in b if (k := kind(t))}
    if ka and kb and not ka & kb:
        score *= 0.7
    pa, pb = {x for t in a if (x := place(t))}, {x for t in b if (x := place(t))}
    if pa and pb and not pa & pb:
        score *= 0.7
    return min(1.0, score)


def chain_agreement(a: list[str], b: list[str]) -> float:
    """1 if two chains share their first word, -1 if both name one and differ, 0 if either is missing."""
    if not a or not b:
        return 0.0
    return 1.0 if any(token_similarity(x, y) >= 0.7 for x in a[:2] for y in b[:2]) else -1.0


#: Stands for the missing number of a position of which only the other is known.
UNKNOWN = 999.0


def bad_number(x: float | None) -> bool:
    return x is None or x != x or abs(x) == float("inf")


def usable(lat: float, lng: float) -> bool:
    return abs(lat) < 90 and abs(lng) <= 180 and not (lat == 0 and lng == 0)


def is_coarse(lat: float, lng: float) -> bool:
    """On the grid of quarter degrees, or without decimals, in both numbers."""
    return (lat * 4) % 1 == 0 and (lng * 4) % 1 == 0


def positions(lat: float | None, lng: float | None) -> list[tuple[float, float]]:
    """Places a stored position may mean: as it is, with the columns exchanged, or in parts of a degree.

    Empty if there is none: null, NaN, the pole, (0, 0).
    """
    if bad_number(lat) or bad_number(lng):
        return []
    out = []
    if usable(lat, lng):
        out.append((lat, lng))
        if abs(lng) < 90 and not is_coarse(lat, lng):
            out.append((lng, lat))
    elif usable(lng, lat) and abs(lat) != 90:  # a pole is a placeholder, not a longitude
        out.append((lng, lat))
    whole = lat == int(lat) and lng == int(lng)
    if whole and (abs(lat) > 90 or abs(lng) > 180 or not out):
        for scale in (1e4, 1e5, 1e6, 1e7):
            if usable(lat / scale, lng / scale) and (abs(lat) > 90 or abs(lng) > 180):
                out.append((lat / scale, lng / scale))
    return out


def half_known(lat: float | None, lng: float | None) -> tuple[float, float] | None:
    """A position of which one number alone is good, the other as UNKNOWN; None if there isn't just one."""
    good = [not bad_number(x) and 0 < abs(x) < top and x != int(x) for x, top in ((lat, 90), (lng, 180))]
    return (lat, UNKNOWN) if good == [True, False] else (UNKNOWN, lng) if good == [False, True] else None


def cell_key(lat: float, lng: float, deg: float) -> tuple[int, int]:
    """Cell of a grid whose columns keep their width towards the poles."""
    import math

    row = math.floor(lat / deg)
    n = max(1, int(math.cos(math.radians(min(abs(row * deg), abs((row + 1) * deg)))) * 360 / deg))
    return row, int((lng + 180) / 360 * n) % n


def cells_round(lat: float, lng: float, km: float, deg: float) -> set[tuple[int, int]]:
    """All cells that hold a point within km, for km at most a cell's height."""
    import math

    up = km / 111.0
    side = up / max(0.01, math.cos(math.radians(min(89.0, abs(lat) + up))))
    return {cell_key(a, (o + 180) % 360 - 180, deg) for a in (max(-90.0, lat - up), lat, min(90.0, lat + up)) for o in (lng - side, lng, lng + side)}


def distance_km(a: tuple[float, float], b: tuple[float, float]) -> float:
    import math

    if UNKNOWN in (a[0], b[0]):  # only the longitudes are known
        lat = b[0] if a[0] == UNKNOWN else a[0]
        a, b = (lat, a[1]), (lat, b[1])
    if UNKNOWN in (a[1], b[1]):
        a, b = (a[0], 0.0), (b[0], 0.0)
    x, y, u, v = map(math.radians, (*a, *b))
    h = math.sin((u - x) / 2) ** 2 + math.cos(x) * math.cos(u) * math.sin((v - y) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, max(0.0, h))))
