"""Records of two lists that mean the same place, matched without a common key.

Each record becomes a fixed bit vector of CODE_BITS bits, one for each q-gram of its canonical name. Records of both
sides meet in an equi-join on their areas, and all pairs of an area are compared by their codes: a Dice score of DICE
over n bits in all allows (1 - DICE) * n bits of Hamming distance. No pair of an area that reaches the score is lost.
(An index of the codes' blocks inside the areas was tried: a short name shares a block with most names of its area, so
it made three times as many rows as there are pairs to compare.) The join is done in slices of the areas, of which
only one's rows are on disk at a time.

The area comes from the position: the cells a record's tolerance reaches into; for positions that are missing or
coarse the half degree they name, the strip of the one number that is known, the town the name names, and, where no
position is known at all, each two words of the name, or the word of a name of one.

The Dice scores of the fields (name, chain) and the nearness of the places are weighted, checked token by token,
and turned into a confidence by a curve fitted on all labelled pairs, whose likelihoods are summed where they lie. The
fit allows for wrong labels and holds to a prior curve that a few labels can't overturn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quoin.llm import encoding_repair
from quoin.llm import names as N
from quoin.operators.regions import great_circle_km
from quoin.session import checkpoint, in_slices, packed, release, spread

CODE_BITS, BLOCKS = 256, 64
WORDS = CODE_BITS // 64
CELL_DEG, HALF_DEG = 0.02, 0.5
TOLERANCE_KM, COARSE_KM, FAR_KM = 0.4, 20.0, 40.0
#: Lowest Dice score of the codes of a pair, and where nothing but the names speaks for it.
DICE, FAR_DICE = 0.55, 0.65
#: Records of one side of an area beyond so many are spread over several keys, and the other side's copied to each of them.
AREA_ROWS = 4096
#: Slices in which areas are joined and pairs scored, one for each SLICE_ROWS records up to so many.
SLICES, SLICE_ROWS = 4, 40_000
#: A small table is broadcast up to so many rows, and joined by a shuffle beyond.
BROADCAST_ROWS = 100_000
WRONG_LABELS = 0.05
#: Curves tried in the fit.
SLOPES, MIDDLES = np.arange(8.0, 40.1, 2.0), np.arange(0.55, 0.75, 0.005)
#: Different names at exactly one position beyond this many make it a placeholder, which says no more than the half degree.
PLACEHOLDER_ROWS = 50
#: Similarity from which two spellings are the same name.
SAME_NAME = 0.6
#: Weights of name, distance and chain; a share of the name's weight goes to the Dice score of the codes.
W_NAME, W_GEO, W_CHAIN, DICE_PART = 0.85, 0.12, 0.03, 0.15
#: A match has to be no worse than the best match of its source record by more than this.
BEST_MARGIN = 0.03
CONFIDENT = 0.5

PREPARED = "side string, id long, toks array<string>, chain array<string>, pos array<struct<lat:double,lng:double>>, loose boolean, city string, code array<long>, n int, u int, areas array<string>"


def small(df: DataFrame) -> DataFrame:
    """df checkpointed, and marked for broadcast if it has no more than BROADCAST_ROWS rows."""
    df = checkpoint(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def clean_names(df: DataFrame) -> DataFrame:
    """df(name, …) with garbled names restored under the words of the names themselves."""
    values = df.select(F.col("name").alias("text"))
    model = encoding_repair.fit(checkpoint(encoding_repair._tokens(values).groupBy("t").agg(F.count(F.lit(1)).alias("n"))))
    out = encoding_repair.restore_texts(df.withColumnRenamed("name", "text"), model)
    return out.withColumn("name", F.col("restored")).drop("text", "restored")


def _crowded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The positions, whose rows stand together in the order of toks, with more than PLACEHOLDER_ROWS different names."""
    at, seen = None, []
    for pdf in batches:
        hot = []
        for lat, lng, toks in zip(pdf["lat"], pdf["lng"], pdf["toks"].map(list)):
            key = tuple(None if x != x else x for x in (lat, lng))
            if key != at:
                at, seen = key, []
            if len(seen) > PLACEHOLDER_ROWS:
                continue
            same = next((i for i, x in enumerate(seen) if N.name_similarity(toks, x) >= SAME_NAME), None)
            # The name met last comes first, as the next spelling is most often one of it.
            seen.insert(0, toks if same is None else seen.pop(same))
            if len(seen) > PLACEHOLDER_ROWS:
                hot.append((lat, lng))
        yield pd.DataFrame(hot, columns=["lat", "lng"])


def mark_placeholders(df: DataFrame) -> DataFrame:
    """Add ``crowded``: the row's position is one that many different names share to the last digit.

    However often a place is delivered, under however many spellings, its position stays a position. All spellings of a
    position are looked at, one after the other, until PLACEHOLDER_ROWS different names are found.
    """
    toks = F.pandas_udf(lambda s: s.map(N.tokens), "array<string>")
    named = df.where(F.col("lat").isNotNull() & F.col("lng").isNotNull() & F.col("name").isNotNull()).select("lat", "lng", "name")
    many = small(named.groupBy("lat", "lng").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PLACEHOLDER_ROWS).select("lat", "lng"))
    spelled = named.join(many, ["lat", "lng"]).select("lat", "lng", toks("name").alias("toks")).where(F.size("toks") > 0).distinct()
    hot = small(spelled.repartition("lat", "lng").sortWithinPartitions("lat", "lng", "toks").mapInPandas(_crowded, "lat double, lng double"))
    return df.join(hot.withColumn("crowded", F.lit(True)), ["lat", "lng"], "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))


#: The first bit of each block.
_FIRST_BITS = sum(1 << (i * (CODE_BITS // BLOCKS)) for i in range(BLOCKS))


def code_of(toks: list[str]) -> tuple[list[int], int, int]:
    """(code as signed longs, bits set, blocks with a bit)."""
    code = any_bit = 0
    for t in toks:
        code |= N.token_bits(t, CODE_BITS)
    for i in range(CODE_BITS // BLOCKS):
        any_bit |= code >> i
    return N.words64(code, WORDS), code.bit_count(), (any_bit & _FIRST_BITS).bit_count()


def exact_from(n: int, u: int) -> float:
    """Dice score from which a record of n bits in u blocks meets every record of its area: DICE, as all pairs are compared."""
    return DICE if n else 1.0


def _anywhere(words: list[str], single: bool) -> set[str]:
    """Areas by words alone: pairs of words, or the word of a name of one; with ``single`` also each word of longer names."""
    words = sorted({*words})
    two = {f"{x} {y}" for i, x in enumerate(words) for y in words[i + 1 :]}
    return two | ({*words} if single or len(words) == 1 else set())


def _areas(side: str, pos: list, half, loose: bool, toks: list[str], town: list[str]) -> set[str]:
    """Where a record looks (side a) or stands (side b)."""
    areas = set()
    words = [t for t in toks if N.weight(t, frozenset()) >= 1]
    grams = {*words} | {f"{x} {y}" for x, y in zip(toks, toks[1:])}
    if side == "a":
        for p in pos:
            areas |= {"h%d,%d" % c for c in N.cells_round(*p, COARSE_KM, HALF_DEG)} if loose and p is pos[0] else {"g%d,%d" % c for c in N.cells_round(*p, TOLERANCE_KM, CELL_DEG)} if not loose else set()
        if half:
            at, axis = (half[1], "x") if half[0] == N.UNKNOWN else (half[0], "y")
            areas |= {f"{axis}{math.floor((at + d) / CELL_DEG)}" for d in (-0.004, 0.0, 0.004)}
        areas |= {("c" if loose else "n") + g for g in grams}
        return areas | ({"w" + x for x in _anywhere(words, True)} if pos else {"v" + x for x in _anywhere(words, False)})
    for p in pos:
        areas |= {"g%d,%d" % N.cell_key(*p, CELL_DEG), "h%d,%d" % N.cell_key(*p, HALF_DEG), f"x{math.floor(p[1] / CELL_DEG)}", f"y{math.floor(p[0] / CELL_DEG)}"}
    if town:
        areas |= {"c" + " ".join(town)} | ({"n" + " ".join(town)} if not pos else set())
    return areas | {"v" + x for x in _anywhere(words, True)} | ({"w" + x for x in _anywhere(words, False)} if not pos else set())


def _prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for side, key, name, chain, lat, lng, city, crowded in zip(pdf["side"], pdf["id"], pdf["name"], pdf["chain"], pdf["lat"], pdf["lng"], pdf["city"], pdf["crowded"]):
            toks = N.tokens(name)
            if not toks:
                continue
            pos = N.positions(lat, lng)
            loose = not pos or crowded or N.is_coarse(*pos[0])
            half = N.half_known(lat, lng) if not pos else None
            town = N.tokens(city) if isinstance(city, str) else []
            # The exchanged columns of a position need only be tried on one of the two sides.
            areas = _areas(side, pos if side == "a" else pos[:1], half, loose, toks, town)
            at = [half] if half and side == "a" else pos
            rows.append((side, key, toks, N.tokens(chain), [{"lat": x, "lng": y} for x, y in at], loose, " ".join(town), *code_of(toks), sorted(areas)))
        yield pd.DataFrame(rows, columns=[c.split(":")[0].split()[0] for c in PREPARED.split(", ")])


def prepare(df: DataFrame) -> DataFrame:
    """df(side, id, name, chain, lat, lng, city) -> canonical tokens, positions, code and areas of each record with a name."""
    return spread(mark_placeholders(df)).mapInPandas(_prepare, PREPARED)


def slices_of(df: DataFrame) -> int:
    return min(SLICES, 1 + df.count() // SLICE_ROWS)


def near_codes(prepared: DataFrame, slices: int | None = None) -> DataFrame:
    """(a, b, dice, far): records of both sides that share an area with a Dice score of DICE or more (FAR_DICE if far).

    far: they only share two words of their names, or the word of a name of one. slices: by the number of records if not given.
    """
    spark = prepared.sparkSession
    code = [F.col("code")[i].alias(f"c{i}") for i in range(WORDS)]
    at = prepared.where("n > 0").select("side", "id", *code, F.explode("areas").alias("area"))
    at = at.select("side", "id", *(f"c{i}" for i in range(WORDS)), F.col("area").rlike("^[vw]").alias("far"), F.xxhash64("area").alias("area"))
    rows = at.groupBy("area").agg(F.count_if(F.col("side") == "a").alias("na"), F.count_if(F.col("side") == "b").alias("nb")).where("na > 0 AND nb > 0")
    parts = lambda n: F.ceil(F.col(n) / AREA_ROWS).cast("int")
    crowded = small(rows.where(F.greatest("na", "nb") > AREA_ROWS).select("area", parts("na").alias("pa"), parts("nb").alias("pb")))
    slices = slices or slices_of(prepared)
    if slices > 1:
        release(spark)

    def side(own: DataFrame, name: str) -> DataFrame:
        """A record of a crowded area has the key of one of its own side's parts with each of the other side's."""
        mine, other = ("pa", "pb") if name == "a" else ("pb", "pa")
        salt = F.pmod(F.xxhash64("id", F.lit("salt")), F.coalesce(mine, F.lit(1))).cast("int")
        own = own.where(F.col("side") == name).join(crowded, "area", "left").withColumn("salt", salt)
        own = own.withColumn("with", F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
        key = F.xxhash64("area", "salt", "with") if name == "a" else F.xxhash64("area", "with", "salt")
        return own.select(key.alias("h"), F.col("id").alias(name), *(F.col(f"c{i}").alias(f"{name}{i}") for i in range(WORDS)), *(["far"] if name == "a" else []))

    bits = lambda name: sum((F.bit_count(f"{name}{i}") for i in range(WORDS)), F.lit(0))
    common = sum((F.bit_count(F.col(f"a{i}").bitwiseAND(F.col(f"b{i}"))) for i in range(WORDS)), F.lit(0))

    def near(k: int) -> DataFrame:
        own = at.where(F.pmod("area", F.lit(slices)) == k) if slices > 1 else at
        both = side(own, "a").join(side(own, "b"), "h").select("a", "b", "far", (2 * common / (bits("a") + bits("b"))).alias("dice"))
        both = both.where(F.col("dice") >= F.when(F.col("far"), FAR_DICE).otherwise(DICE))
        return both.groupBy("a", "b").agg(F.first("dice").alias("dice"), F.min("far").alias("far"))

    if slices == 1:
        return near(0)
    return in_slices(spark, slices, near).groupBy("a", "b").agg(F.first("dice").alias("dice"), F.min("far").alias("far"))


def anywhere(few: DataFrame, every: DataFrame) -> DataFrame:
    """few, every(id, words, code, n, u) -> (a, b): pairs that share two words, or the word of a name of one, wherever they are, with a Dice score of FAR_DICE or more."""
    two = F.flatten(F.transform("words", lambda x: F.transform(F.filter("words", lambda y: y > x), lambda y: F.concat(F.lit("v"), x, F.lit(" "), y))))
    one = F.transform("words", lambda x: F.concat(F.lit("v"), x))
    of = lambda df, side: df.select(F.lit(side).alias("side"), "id", "code", "n", "u", (F.concat(two, one) if side == "b" else F.when(F.size("words") > 1, two).otherwise(one)).alias("areas"))
    return near_codes(of(few, "a").unionByName(of(every, "b")), 1).select("a", "b")


@lru_cache(maxsize=20_000)
def _light(city: str) -> frozenset:
    return frozenset(city.split())


def compare(toks_a, toks_b, chain_a, chain_b, pos_a, pos_b, loose: bool, city: str, dice: float, far: bool = False) -> float:
    """Field-weighted score of a pair, 0 to 1; 0 where the places are too far apart.

    far: nothing but the names says where the two are, so the town is no light word if the first has a word that the second lacks.
    """
    km = min((N.distance_km((p["lat"], p["lng"]), (q["lat"], q["lng"])) for p in pos_a for q in pos_b), default=None)
    one = any(N.UNKNOWN in (p["lat"], p["lng"]) for p in pos_a)
    if one and km is not None and km > TOLERANCE_KM:
        return 0.0
    if km is not None and km > (FAR_KM if loose else TOLERANCE_KM):
        return 0.0
    lacks = far and any(all(N.token_similarity(x, y) < 0.6 for y in toks_b) for x in toks_a)
    name = N.name_similarity(list(toks_a), list(toks_b), frozenset() if lacks else _light(city))
    name = (1 - DICE_PART) * name + DICE_PART * max(dice, name if dice > 0.6 else 0)
    geo = 0.9 if one else 0.4 if km is None or loose else 1.0 if km <= 0.05 else max(0.0, 1 - (km - 0.05) / 0.25)
    return W_NAME * name + W_GEO * geo + W_CHAIN * (0.5 + 0.5 * N.chain_agreement(list(chain_a), list(chain_b)))


def within_reach(pos_a: Column, pos_b: Column, loose: Column) -> Column:
    """False where all places two records may mean are further apart than a match can be; positions with one number pass."""
    far = F.when(loose, F.lit(FAR_KM)).otherwise(F.lit(TOLERANCE_KM)) * 1.001
    near = lambda p, q: (p["lat"] == N.UNKNOWN) | (p["lng"] == N.UNKNOWN) | (q["lat"] == N.UNKNOWN) | (q["lng"] == N.UNKNOWN) | (great_circle_km(p["lat"], p["lng"], q["lat"], q["lng"]) <= far)
    return (F.size(pos_a) == 0) | (F.size(pos_b) == 0) | F.exists(pos_a, lambda p: F.exists(pos_b, lambda q: near(p, q)))


def score_pairs(pairs: DataFrame, prepared: DataFrame) -> DataFrame:
    """pairs(a, b, dice, far) with ``score``, ``loose`` (one of the two has no exact position) and the target's ``place``."""
    cols = ("toks", "chain", "pos", "loose", "city")
    of = lambda side: prepared.where(F.col("side") == side).select(F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in cols))
    joined = pairs.join(of("a"), "a").join(of("b"), "b").where(within_reach(F.col("pos_a"), F.col("pos_b"), F.col("loose_a") | F.col("loose_b")))

    @F.pandas_udf("double")
    def score(ta: pd.Series, tb: pd.Series, ca: pd.Series, cb: pd.Series, pa: pd.Series, pb: pd.Series, lo: pd.Series, city: pd.Series, d: pd.Series, far: pd.Series) -> pd.Series:
        return pd.Series([compare(*x) for x in zip(ta, tb, ca, cb, pa, pb, lo, city, d, far)], dtype="float64")

    loose = F.col("loose_a") | F.col("loose_b")
    town = F.when(F.col("city_b") != "", F.col("city_b")).otherwise(F.col("city_a"))
    at = F.get("pos_b", 0)
    place = F.when(F.size("pos_b") > 0, F.concat_ws(" ", F.round(at["lat"], 1), F.round(at["lng"], 1))).otherwise(F.col("city_b")).alias("place")
    return joined.select("a", "b", "far", loose.alias("loose"), place, score("toks_a", "toks_b", "chain_a", "chain_b", "pos_a", "pos_b", loose, town, "dice", "far").alias("score"))


def likelihoods(scores: np.ndarray, labels: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Log likelihood of labelled scores, each so many times, under wrong labels: a row per slope, a column per middle."""
    s, y, n = (np.asarray(x, float)[:, None] for x in (scores, labels, times))
    out = np.zeros((len(SLOPES), len(MIDDLES)))
    for i, slope in enumerate(SLOPES):
        p = WRONG_LABELS + (1 - 2 * WRONG_LABELS) / (1 + np.exp(-slope * (s - MIDDLES)))
        out[i] = (n * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum(axis=0)
    return out


def _likelihoods(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    like = sum((likelihoods(pdf["score"], pdf["label"], pdf["n"]) for pdf in batches), np.zeros((len(SLOPES), len(MIDDLES))))
    yield pd.DataFrame({"i": range(like.size), "like": like.ravel()})


def fit_curve(known: DataFrame, prior_mid: float = 0.64, prior_slope: float = 22.0) -> tuple[float, float]:
    """(slope, middle) of the logistic curve from score to confidence, of all rows of known(score, label): the likeliest under wrong labels and the prior."""
    like = np.zeros(len(SLOPES) * len(MIDDLES))
    counted = known.groupBy("score", "label").agg(F.count(F.lit(1)).alias("n"))
    for r in counted.mapInPandas(_likelihoods, "i int, like double").groupBy("i").agg(F.sum("like").alias("like")).collect():
        like[r["i"]] = r["like"]
    like = like.reshape(len(SLOPES), -1) - ((MIDDLES - prior_mid) / 0.015) ** 2 / 2 - ((SLOPES[:, None] - prior_slope) / 6) ** 2 / 2
    i, j = np.unravel_index(like.argmax(), like.shape)
    return float(SLOPES[i]), float(MIDDLES[j])


def match(source: DataFrame, target: DataFrame, towns: DataFrame, labelled: DataFrame) -> DataFrame:
    """(leo_id, bkg_id, confidence) of the pairs that mean one place, each once.

    source(rec_id, leo_id, name, chain, lat, lng), target(bkg_id, name, chain, lat, lng, city_id), towns(city_id,
    city_name), labelled(leo_id, bkg_id, label). Records with a null or blank name match nothing; a null
    position, chain, city or label is allowed; repeated deliveries of a leo_id count together. The best target of
    a source record and those within BEST_MARGIN of it can match, so ties are kept.
    """
    a = source.select(F.lit("a").alias("side"), F.col("rec_id").alias("id"), "name", "chain", "lat", "lng", F.lit(None).cast("string").alias("city"))
    named = towns.groupBy("city_id").agg(F.min("city_name").alias("city"))
    b = target.join(named, "city_id", "left").select(F.lit("b").alias("side"), F.col("bkg_id").alias("id"), "name", "chain", "lat", "lng", "city")
    spark = source.sparkSession
    cleaned = checkpoint(clean_names(a.unionByName(b)))
    release(spark)
    read = packed(prepare(cleaned))
    del cleaned
    release(spark)
    who = source.select(F.col("rec_id").alias("a"), "leo_id").where(F.col("leo_id").isNotNull())
    codes = read("side", "id", "code", "n", "u", "areas")
    slices = slices_of(codes)
    pairs = checkpoint(near_codes(codes))
    release(spark)
    records = read("side", "id", "toks", "chain", "pos", "loose", "city")

    def score(k: int) -> DataFrame:
        mine = lambda key: F.pmod(F.xxhash64(key), F.lit(slices)) == k
        return score_pairs(pairs.where(mine("a")), records.where((F.col("side") == "b") | mine("id"))).where(F.col("score") > 0)

    scored = in_slices(spark, slices, score).join(who, "a")
    scored = checkpoint(scored.groupBy("leo_id", "b").agg(F.max(F.when(~F.col("loose"), F.col("score"))).alias("near"), F.max("score").alias("score"), F.min("far").alias("far"), F.first("place").alias("place")))
    del pairs, records, codes, read, score
    release(spark)
    known = labelled.where(F.col("label").isNotNull()).select("leo_id", F.col("bkg_id").alias("b"), "label")
    slope, mid = fit_curve(known.join(scored, ["leo_id", "b"], "left").select("label", F.coalesce("score", F.lit(0.0)).alias("score")))
    # Without an exact position the name alone must decide, so it has to be better.
    used = F.coalesce("near", F.col("score") - 0.08)
    out = scored.withColumn("used", used).withColumn("best", F.max("used").over(Window.partitionBy("leo_id")))
    out = out.where(F.col("used") >= F.col("best") - BEST_MARGIN)
    # A name that fits as well in several places, with nothing to say which, shares its confidence among them.
    places = F.size(F.collect_set("place").over(Window.partitionBy("leo_id")))
    out = out.withColumn("share", F.when(F.col("far"), places).otherwise(F.lit(1)))
    return out.select("leo_id", F.col("b").alias("bkg_id"), F.round(1 / (1 + F.exp(-slope * (F.col("used") - mid))) / F.col("share"), 6).alias("confidence"))


def tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    from quoin.session import table

    return table(spark, sf_dir, "leoh"), table(spark, sf_dir, "bkgh"), table(spark, sf_dir, "cities"), table(spark, sf_dir, "labelled_pairs")
