"""Variant spellings of one name, linked by a pigeonhole segment join.

Two strings within k edits share one of k + 1 segments, at a place shifted by no more than k. Every distinctive
word of a name is cut into k + 1 segments and put into an inverted index under (area, length, segment number,
segment); the probe looks up the substrings of its own words that can be such a segment, at the shifts and
lengths the edits allow (for segment i of the k + 1, shifts from both ends are bounded, which keeps the look-ups
few). Names typed in another order, with additions or with abbreviated parts still share a word, so words, not
whole names, are indexed; the pair is then verified with banded edit distances over all words.

Hotels are only looked up in their area (a grid cell, the half degree of a coarse position, or their town), so no
list of the index holds more than the houses of one area; those of which no position is known are also compared with
all others by the code of their names. Chains are looked up among the entries of a code table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quoin.llm import entity_match as E
from quoin.llm import names as N
from quoin.session import checkpoint, spread

TOLERANCE_KM = 0.35
SAME, SAME_LOOSE = 0.66, 0.8
#: A word is the town of a half degree if this share of the names there hold it.
TOWN_SHARE = 0.04
CHAIN_SAME = 0.72
#: No pair is compared whose codes have a lower Dice score.
LEAST_DICE = 0.4


def edits(n: int) -> int:
    """Edits allowed in a word of n characters; an exchange of neighbours can take two."""
    return 1 if n <= 5 else 2


def segments(word: str, k: int) -> list[tuple[int, str]]:
    """(start, segment) of the k + 1 segments of a word, the longer ones last."""
    n, parts = len(word), k + 1
    short, extra, out, at = n // parts, n % parts, [], 0
    for i in range(parts):
        size = short + (i >= parts - extra)
        out.append((at, word[at : at + size]))
        at += size
    return out


def index_keys(word: str) -> list[str]:
    k = edits(len(word))
    return [f"{len(word)}.{i}.{s}" for i, (_, s) in enumerate(segments(word, k))]


def probe_keys(word: str, shorter: bool = True) -> set[str]:
    """Keys under which a word within the allowed edits of this one can stand in the index; not ``shorter``: only as long or longer ones."""
    out: set[str] = set()
    m = len(word)
    for n in range(max(1, m - 2) if shorter else m, m + 3):
        k = edits(n)
        diff = m - n
        if abs(diff) > k:
            continue
        for i, (at, s) in enumerate(segments("x" * n, k)):
            lo = max(0, at - i, at + diff - (k - i))
            hi = min(m - len(s), at + i, at + diff + (k - i))
            for p in range(lo, hi + 1):
                out.add(f"{n}.{i}.{word[p : p + len(s)]}")
    return out


def distinctive(toks: list[str]) -> list[str]:
    """Words that tell a name from others; all words if there is none."""
    strong = {N.collapse(t) for t in toks if N.weight(t, frozenset()) >= 1 and len(t) >= 3}
    return sorted(strong or {N.collapse(t) for t in toks})


SPELLED = "id long, toks array<string>, chain array<string>, pos array<struct<lat:double,lng:double>>, loose boolean, half array<string>, also array<string>, near array<string>, cell string, words array<string>, code array<long>, n int, u int"


def _spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for key, name, chain, lat, lng, crowded in zip(pdf["id"], pdf["name"], pdf["chain"], pdf["lat"], pdf["lng"], pdf["crowded"]):
            toks = N.tokens(name)
            if not toks:
                continue
            pos = N.positions(lat, lng)
            loose = not pos or crowded or N.is_coarse(*pos[0])
            # Half degrees of the position, the first its own; and its strips, for those who know one number only.
            half = ["h%d,%d" % N.cell_key(*pos[0], E.HALF_DEG)] if pos else []
            also = [f"x{math.floor(pos[0][1] / E.CELL_DEG)}", f"y{math.floor(pos[0][0] / E.CELL_DEG)}"] if pos else []
            if loose and pos:
                half += sorted({"h%d,%d" % c for c in N.cells_round(*pos[0], E.COARSE_KM, E.HALF_DEG)} - {*half})
            one = N.half_known(lat, lng) if not pos else None
            if one:
                at, axis = (one[1], "x") if one[0] == N.UNKNOWN else (one[0], "y")
                also = sorted({f"{axis}{math.floor((at + d) / E.CELL_DEG)}" for d in (-0.004, 0.0, 0.004)})
            near = [] if loose else sorted({f"g{x},{y}" for p in pos for x, y in N.cells_round(*p, TOLERANCE_KM, E.CELL_DEG)})
            cell = None if loose else "g%d,%d" % N.cell_key(*pos[0], E.CELL_DEG)
            rows.append((key, toks, N.tokens(chain), [{"lat": x, "lng": y} for x, y in pos or ([one] if one else [])], loose, half, also, near, cell, distinctive(toks), *E.code_of(toks)))
        yield pd.DataFrame(rows, columns=[c.split(":")[0].split()[0] for c in SPELLED.split(", ")])


def _towns(spelled: DataFrame, towns: DataFrame) -> DataFrame:
    """(id, town): words of each name that are a town's name, and the town of its half degree."""

    @F.pandas_udf("string")
    def canonical(s: pd.Series) -> pd.Series:
        return s.map(lambda x: " ".join(N.tokens(x)))

    named = towns.where(F.col("city_name").isNotNull()).select(canonical("city_name").alias("town")).where("town <> ''").distinct()
    grams = F.array_distinct(F.concat("toks", F.expr("transform(sequence(1, greatest(1, size(toks) - 1)), i -> concat_ws(' ', get(toks, i - 1), get(toks, i)))")))
    spelled = spelled.withColumn("half", F.get("half", 0))
    own = spelled.select("id", "half", F.explode(grams).alias("town")).join(named, "town", "left_semi")
    share = own.where(F.col("half").isNotNull()).groupBy("half", "town").agg(F.countDistinct("id").alias("n"))
    total = spelled.groupBy("half").agg(F.count(F.lit(1)).alias("all"))
    local = share.join(total, "half").where(F.col("n") >= TOWN_SHARE * F.col("all")).where(F.col("n") >= 2).select("half", "town")
    # A town's name is the town's only where it is the local one; without a position there is but the word.
    here = own.where(F.col("half").isNull()).select("id", "town").unionByName(spelled.select("id", "half").join(local, "half").select("id", "town"))
    return here.distinct()


def _met(spelled: DataFrame, town: DataFrame) -> DataFrame:
    """(a, b), a < b: records that share an area and, in it, a key of the segment index.

    Records with a position ask for words as long as theirs or longer, as the one with the longer word asks for no
    shorter; those that are looked for in a wide area ask for both, as nobody there asks for them.
    """
    words = checkpoint(spelled.select(F.explode("words").alias("w")).distinct())
    listed_as = F.pandas_udf(lambda s: s.map(index_keys), "array<string>")
    asked_as = F.pandas_udf(lambda s: s.map(lambda w: sorted(probe_keys(w, False))), "array<string>")
    asked_wide = F.pandas_udf(lambda s: s.map(lambda w: sorted(probe_keys(w))), "array<string>")
    by_town = town.withColumn("area", F.concat(F.lit("t"), "town")).select("id", "area")
    around = F.concat("half", F.when(F.size("half") == 0, F.col("also")).otherwise(F.array().cast("array<string>")))
    loose = spelled.where("loose").select("id", F.explode(around).alias("area")).unionByName(by_town.join(spelled.where("loose").select("id"), "id", "left_semi"))
    strict = spelled.where("NOT loose").select("id", F.explode("near").alias("area"))
    wide = spelled.select("id", F.explode(F.concat(F.slice("half", 1, 1), "also")).alias("area")).unionByName(by_town).join(loose.select("area").distinct(), "area", "left_semi").select("id", "area")
    listed = spelled.where("NOT loose").select("id", F.col("cell").alias("area")).unionByName(wide)
    # Cells where a record stands alone, and those nobody stands in, lead to no pair.
    crowd = listed.groupBy("area").agg(F.min("id").alias("one"), F.max("id").alias("other"))
    strict = strict.join(crowd, "area").where((F.col("one") != F.col("other")) | (F.col("one") != F.col("id"))).select("id", "area")
    own = spelled.select("id", F.explode("words").alias("w"))
    keyed = lambda at, keys, name: at.join(own, "id").join(words.select("w", keys("w").alias("keys")), "w").select(F.col("id").alias(name), "area", F.explode("keys").alias("key")).select(name, F.xxhash64("area", "key").alias("h"))
    probe = keyed(strict, asked_as, "a").unionByName(keyed(loose, asked_wide, "a"))
    met = probe.join(keyed(listed, listed_as, "b"), "h").where(F.col("a") != F.col("b"))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_places(df: DataFrame, towns: DataFrame) -> DataFrame:
    """df(rec_id, leo_id, name, chain, lat, lng), towns(city_name) -> (key_a, key_b): leo_ids of one place, key_a < key_b.

    Null and blank names and null leo_ids link nothing; a null chain is allowed; deliveries of one leo_id count
    together and don't link it to itself. Towns may be empty.
    """
    cleaned = checkpoint(E.clean_names(df.select(F.col("rec_id").alias("id"), "name", "chain", "lat", "lng")))
    spelled = checkpoint(spread(E.mark_placeholders(cleaned)).mapInPandas(_spell, SPELLED))
    town = checkpoint(_towns(spelled, towns))
    pairs = _met(spelled, town)
    few = spelled.where("size(pos) = 0 AND size(toks) > 0")
    pairs = pairs.unionByName(E.anywhere(few, spelled).where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
    # The few columns that rule most pairs out first: places in reach, a word of each within a few edits (two exchanges are four), codes that aren't too far apart.
    slim = lambda side: spelled.select(F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("words", "code", "n", "pos", "loose")))
    met = pairs.join(slim("a"), "a").join(slim("b"), "b").where(E.within_reach(F.col("pos_a"), F.col("pos_b"), F.col("loose_a") | F.col("loose_b")))
    common = sum((F.bit_count(F.col("code_a")[i].bitwiseAND(F.col("code_b")[i])) for i in range(E.WORDS)), F.lit(0))
    met = met.where(2 * common >= LEAST_DICE * (F.col("n_a") + F.col("n_b")))
    pairs = met.where(F.exists("words_a", lambda x: F.exists("words_b", lambda y: F.levenshtein(x, y, 4) >= 0))).select("a", "b")
    local = town.groupBy("id").agg(F.concat_ws(" ", F.collect_set("town")).alias("city"))
    rec = spelled.join(local, "id", "left").withColumn("city", F.coalesce("city", F.lit("")))
    of = lambda side: rec.select(F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("toks", "chain", "pos", "loose", "city")))

    @F.pandas_udf("double")
    def score(ta: pd.Series, tb: pd.Series, ca: pd.Series, cb: pd.Series, pa: pd.Series, pb: pd.Series, lo: pd.Series, city: pd.Series) -> pd.Series:
        return pd.Series([E.compare(*x, 0.0) for x in zip(ta, tb, ca, cb, pa, pb, lo, city)], dtype="float64")

    is_loose = F.col("loose_a") | F.col("loose_b")
    city = F.concat_ws(" ", "city_a", "city_b")
    scored = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", is_loose.alias("lo"), score("toks_a", "toks_b", "chain_a", "chain_b", "pos_a", "pos_b", is_loose, city).alias("score"))
    same = scored.where(F.col("score") >= F.when(F.col("lo"), SAME_LOOSE).otherwise(SAME))
    ids = df.select("rec_id", "leo_id").where(F.col("leo_id").isNotNull())
    out = same.join(ids.select(F.col("rec_id").alias("a"), F.col("leo_id").alias("x")), "a").join(ids.select(F.col("rec_id").alias("b"), F.col("leo_id").alias("y")), "b")
    return out.where("x <> y").select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).distinct()


# Words of a chain's name that many chains share, forms of companies, and fillers for no chain.
COMMON = frozenset("hotels hotel resorts resort inns inn lodges lodge suites suite residences residence hostels hostel international collection boutique group gastehauser ldgs hot".split())
LEGAL = frozenset("inc gmbh ltd llc plc co ag sa srl spa the and".split())
NO_CHAIN = frozenset("independent privately owned none n a na null familienbetriebe".split())
_DOTTED = {"s.a.": "", "s.p.a.": "", "s.r.l.": ""}


@lru_cache(maxsize=100_000)
def chain_words(typed: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(words of the brand, common words) of a chain as typed."""
    s = N.fold_text(N._CAMEL.sub(" ", typed))
    for k, v in _DOTTED.items():
        s = s.replace(k, v)
    toks = [N.SHORT.get(t, t) for t in N._SPLIT.split(s) if t]
    toks = [t for t in toks if t not in LEGAL]
    return tuple(N.collapse(t) for t in toks if not _is_common(t)), tuple(N.collapse(t) for t in toks if _is_common(t))


@lru_cache(maxsize=100_000)
def _is_common(t: str) -> bool:
    k = 1 if len(t) < 8 else 2
    return t in COMMON or (len(t) >= 4 and any(abs(len(x) - len(u)) <= k and N.banded_distance(u, x, k) <= k for x in COMMON if len(x) >= 5 for u in (t, N.collapse(t))))


def initials(name: str) -> str:
    return "".join(t[0] for t in N._SPLIT.split(N.fold_text(name)) if t and t != "and")


def chain_keys(name: str, probe: bool) -> list[str]:
    """Index or look-up keys of a chain: segments of its brand's words, its first five letters, its initials."""
    brand, common = chain_words(name)
    out = {k for w in (*brand, "".join(brand)) if w for k in (probe_keys(w) if probe else index_keys(w))}
    first = N.fold_text(name).strip()
    if not probe:
        out |= {"p" + first[:5].strip(), "i" + initials(name)}
    else:
        if len(first) <= 5:
            out.add("p" + first[:5])
        if name.strip().isupper() and len(name.strip()) <= 5:
            out.add("i" + first)
    return sorted(out)


def chain_score(typed: str, name: str) -> float:
    """How well a typed chain names an entry: 0 to 1, its brand's words before the common ones."""
    t = typed.strip()
    plain = N.fold_text(t)
    if not t or any(N.token_similarity(x, y) >= 0.8 for x in N._SPLIT.split(plain) if x for y in ("independent", "familienbetriebe", "privately")) or plain in NO_CHAIN:
        return 0.0
    if t.isupper() and len(t) <= 5 and plain == initials(name):
        return 0.9
    if len(t) <= 5 and len(plain) >= 4 and N.fold_text(name).startswith(plain) and " " not in t:
        return 0.95
    brand, common = chain_words(t)
    want, also = chain_words(name)
    if not brand:
        return 0.0
    one, two = "".join(brand), "".join(want)
    d = N.banded_distance(one, two, 3)
    whole = 1 - d / max(len(one), len(two)) if d <= 3 else 0.0
    parts = N.name_similarity(list(brand), list(want))
    score = max(whole, parts)
    if score < CHAIN_SAME:
        return 0.0
    shared = sum(any(N.token_similarity(x, y) >= 0.6 for y in also) for x in common) / max(1, len(common)) if common else 0.5
    return 0.9 * score + 0.1 * shared


def link_chains(df: DataFrame, codes: DataFrame) -> DataFrame:
    """df(leo_id, chain, name), codes(chain_code, chain_name) -> (key_a, key_b): leo_ids whose chain means an entry but isn't written as it.

    Null, blank and filler chains mean none. Of several entries the best is taken; where two are as good, the one
    whose brand the hotel's name holds, else none. Only distinct spellings are compared.
    """
    typed = df.where(F.col("chain").isNotNull() & (F.trim("chain") != "")).groupBy("chain").agg(F.count(F.lit(1)).alias("n"))
    typed = checkpoint(E.clean_names(typed.select("chain", F.col("chain").alias("name"))).withColumnRenamed("name", "clean"))
    look = F.pandas_udf(lambda s: s.map(lambda t: chain_keys(t, True)), "array<string>")
    keys = F.pandas_udf(lambda s: s.map(lambda t: chain_keys(t, False)), "array<string>")
    index = codes.where(F.col("chain_name").isNotNull()).select("chain_code", "chain_name", F.explode(keys("chain_name")).alias("key"))
    pairs = typed.select("chain", "clean", F.explode(look("clean")).alias("key")).join(index, "key").select("chain", "clean", "chain_code", "chain_name").distinct()

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([chain_score(x, y) for x, y in zip(a, b)], dtype="float64")

    scored = pairs.withColumn("score", score("clean", "chain_name")).where(F.col("score") > 0)
    best = scored.withColumn("best", F.max("score").over(Window.partitionBy("chain"))).where(F.col("score") >= F.col("best") - 1e-9)
    best = best.withColumn("ties", F.count(F.lit(1)).over(Window.partitionBy("chain")))
    exact = codes.select(F.col("chain_name").alias("chain")).distinct()
    rows = df.where(F.col("leo_id").isNotNull()).select("leo_id", "chain", "name").join(exact, "chain", "left_anti").join(best, "chain")
    brand = F.lower(F.element_at(F.split("chain_name", " "), 1))
    rows = rows.where((F.col("ties") == 1) | F.contains(F.lower("name"), brand))
    return rows.select(F.col("leo_id").alias("key_a"), F.col("chain_code").alias("key_b")).distinct()
