"""Entity matching: radius join, candidates with name similarities, threshold cascade, one-to-one assignment."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quoin.functions import geo, text
from quoin.operators.regions import circle_ring, points_in_regions
from quoin.session import checkpoint, spread

#: Passes of the cascade: (km, lowest similarity, only if it is the one candidate, tokens may be swapped).
CASCADE = ((1, 0.6, False, False), (2, 0.75, False, False), (4, 0.8, False, False), (6, 0.86, False, False), (0.1, 0.5, True, False), (6, 0.86, True, True))


def radius_join(src: DataFrame, tgt: DataFrame, km: float) -> DataFrame:
    """src(src_id, lat, lng) x tgt(tgt_id, lat, lng) -> (src_id, tgt_id, dist_m) within km.

    Rows without a usable position join nothing. Candidates come from the region join (strips and tiles), the
    distance is then exact; poles and the antimeridian need no care of the caller. One id may stand for several rows.
    """
    ok = lambda df: df.where((F.abs("lat") <= 90) & (F.abs("lng") <= 180) & ~F.isnan("lat") & ~F.isnan("lng"))
    a = ok(src).select("src_id", F.struct("lat", "lng").alias("p"))
    b = ok(tgt).select("tgt_id", F.struct("lat", "lng").alias("q"))
    rings = a.select("p").distinct().select(F.col("p").alias("rid"), circle_ring(F.col("p.lat"), F.col("p.lng"), km).alias("ring"))
    points = b.select("q").distinct().select(F.col("q").alias("pid"), "q.lat", "q.lng")
    near = points_in_regions(points, rings, max(0.02, km / 111)).select(F.col("rid").alias("p"), F.col("pid").alias("q"))
    near = near.withColumn("dist_m", geo.haversine_m(F.col("p.lat"), F.col("p.lng"), F.col("q.lat"), F.col("q.lng"))).where(F.col("dist_m") <= km * 1000)
    return near.join(a, "p").join(b, "q").select("src_id", "tgt_id", "dist_m")


def local_stopwords(names: DataFrame, group: str, name: str, top: int = 20) -> DataFrame:
    """(group, words): at most ``top`` tokens of a group's names that stand in more than a third of as many as it has."""
    canon = names.select(group, text.normalize(F.col(name)).alias("n"))
    size = canon.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    words = canon.select(group, F.explode(F.split("n", " ")).alias("w")).where("w <> ''").groupBy(group, "w").agg(F.count(F.lit(1)).alias("cnt"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("cnt"), "w"))
    kept = words.withColumn("rank", rank).where(F.col("rank") <= top).join(size, group).where(F.col("cnt") > F.floor(F.col("size") / 3))
    return kept.groupBy(group).agg(F.array_sort(F.collect_list("w")).alias("words"))


def candidates(src: DataFrame, tgt: DataFrame, km: float, least: float, stopwords: bool = False) -> DataFrame:
    """src(src_id, name, lat, lng), tgt(tgt_id, …) -> (src_id, tgt_id, name_sim, name_sim_sw, dist_m) with name_sim_sw above ``least``.

    With ``stopwords`` the words common among the names round a source record are left out for it.
    """
    near = radius_join(src, tgt, km)
    near = near.join(src.select("src_id", F.col("name").alias("name_a")), "src_id").join(tgt.select("tgt_id", F.col("name").alias("name_b")), "tgt_id")
    local = None
    if stopwords:
        near = near.join(local_stopwords(near, "src_id", "name_b"), "src_id", "left")
        local = F.col("words")
    near = near.withColumn("a", text.normalize(F.col("name_a"), local)).withColumn("b", text.normalize(F.col("name_b"), local))
    near = near.withColumn("fa", text.normalize(F.col("name_a"), stopwords=False)).withColumn("fb", text.normalize(F.col("name_b"), stopwords=False))
    near = checkpoint(spread(near.select("src_id", "tgt_id", "dist_m", "a", "b", "fa", "fb")))
    kept = compared(near.select("src_id", "tgt_id", "dist_m", F.col("a").alias("na"), F.col("b").alias("nb"), F.col("fa").alias("a"), F.col("fb").alias("b")), least, True)
    return kept.select("src_id", "tgt_id", text.ratio("na", "nb").alias("name_sim"), F.col("score").alias("name_sim_sw"), "dist_m")


#: So many edges or fewer that are left are settled in one task, in their order.
LAST_EDGES = 100_000


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of edges in order, those whose two ends no edge before has taken."""
    sources, targets = set(), set()
    for batch in batches:
        at = []
        for i, (x, y) in enumerate(zip(batch.column("src_id").to_pylist(), batch.column("tgt_id").to_pylist())):
            if x not in sources and y not in targets:
                sources.add(x)
                targets.add(y)
                at.append(i)
        yield batch.take(pa.array(at, pa.int64()))


def assign(edges: DataFrame, score: Column | str = "score", first: str | None = None) -> DataFrame:
    """One-to-one pairs of edges(src_id, tgt_id, score, …): always the best edge left, then none of its two ends again.

    Done in rounds: every edge that is the best of both its ends is taken at once, which gives the same pairs as
    taking edges one by one; when few are left, they are taken one by one. Lower values of the column ``first`` go before
    higher scores, ties go by src_id, then tgt_id. The order is total, so each round takes at least one.
    """
    edges = edges.withColumn("__s", score if isinstance(score, Column) else F.col(score)).where("__s IS NOT NULL AND src_id IS NOT NULL AND tgt_id IS NOT NULL")
    keys = [*([F.col(first).alias("f")] if first else []), (-F.col("__s")).alias("s"), F.col("src_id").alias("a"), F.col("tgt_id").alias("b")]
    left = checkpoint(edges.dropDuplicates(["src_id", "tgt_id"]))
    parts = []
    while left.count() > LAST_EDGES:
        # The best edge of each end, as one aggregation with a partial one before the shuffle.
        of_a, of_b = (left.groupBy(c).agg(F.min(F.struct(*keys)).alias("o")).select("o") for c in ("src_id", "tgt_id"))
        pick = of_a.join(of_b, "o", "left_semi").select(F.col("o.a").alias("src_id"), F.col("o.b").alias("tgt_id"))
        best = checkpoint(left.join(pick, ["src_id", "tgt_id"], "left_semi"))
        parts.append(best)
        left = checkpoint(left.join(best.select("src_id"), "src_id", "left_anti").join(best.select("tgt_id"), "tgt_id", "left_anti"))
    out = checkpoint(left.repartition(1).sortWithinPartitions(*keys).mapInArrow(_in_order, left.schema))
    for part in parts:
        out = out.unionByName(part)
    return out.drop("__s")


def _score(pairs: DataFrame, swap: bool) -> DataFrame:
    """pairs(a, b, __low, …) with ``score`` where it is above ``__low``; other rows drop out. One Python pass, in which equal pairs of a batch count once."""
    of = text.swap_ratio_of if swap else text.ratio_above

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = list(zip(*(batch.column(c).to_pylist() for c in ("a", "b", "__low"))))
            known = {k: of(k[0] or "", k[1] or "", k[2]) for k in set(asked)}
            scores = [known[k] for k in asked]
            at = pa.array([i for i, k in enumerate(asked) if scores[i] > k[2]], pa.int64())
            kept = batch.take(at)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(scores, pa.float64()).take(at)], [*batch.schema.names, "score"])

    return pairs.mapInArrow(run, StructType([*pairs.schema, StructField("score", DoubleType())]))


def compared(pairs: DataFrame, least, swap: bool = False) -> DataFrame:
    """pairs(a, b, …) with ``score``, the similarity of the two names, where it is above the column or number ``least``; other rows drop out.

    Each two distinct names are compared once, however many rows hold them: first by the characters they share, then,
    in Python, by their longest common subsequence. The lowest ``least`` is what Python is asked for.
    """
    least = least if isinstance(least, Column) else F.lit(float(least))
    rows = pairs.withColumn("__least", least)
    two = rows.groupBy("a", "b").agg(F.min("__least").alias("__low"))
    bag = lambda c: two.select(c).distinct().select(c, text.letter_bits(F.col(c)).alias(f"bits_{c}"))
    two = two.join(bag("a"), "a").join(bag("b"), "b")
    two = spread(two.where(text.bits_bound("bits_a", "bits_b", swap) > F.col("__low")).select("a", "b", "__low"))
    return rows.join(_score(two, swap).select("a", "b", "score"), ["a", "b"]).where(F.col("score") > F.col("__least")).drop("__least")


def _near(src: DataFrame, tgt: DataFrame, km: float, held: list[str]) -> DataFrame:
    """src(src_id, lat, lng, a_x …) x tgt(tgt_id, lat, lng, b_x …) -> the ids, dist_m and ``held`` columns of pairs within km.

    The rows of radius_join, made in the stage of the join itself, so that what is ruled out there is never written.
    Rows of cells as high as the distance; a source goes to all cells its circle can touch, the last of a row being next to
    the first. Where the circle holds a pole, these are all cells of the row.
    """
    high = km / 111.0  # a degree is 111.19 km
    ok = lambda df: df.where((F.abs("lat") <= 90) & (F.abs("lng") <= 180) & ~F.isnan("lat") & ~F.isnan("lng"))
    row = lambda lat: F.floor((lat + 90) / high)
    far = lambda r: F.greatest(F.abs(r * high - 90), F.abs((r + 1) * high - 90))
    across = lambda r: F.greatest(F.lit(1), F.floor(360 * F.cos(F.radians(F.least(far(r), F.lit(90.0)))) / high))
    column = lambda lng, n: F.floor((lng + 180) / 360 * n)
    angle, slack = km / 6371.0, 1e-6
    a = ok(src).withColumn("r", F.explode(F.sequence(row(F.col("lat")) - 1, row(F.col("lat")) + 1))).withColumn("n", across(F.col("r")))
    whole = F.abs("lat") + F.degrees(F.lit(angle)) + slack >= 90
    wide = F.when(~whole, F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.lit(angle)) / F.cos(F.radians("lat"))))) + slack)
    first, last = column(F.col("lng") - wide, F.col("n")), column(F.col("lng") + wide, F.col("n"))
    cells = F.when(F.coalesce(last - first >= F.col("n") - 1, F.lit(True)), F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).otherwise(F.transform(F.sequence(first, last), lambda c: F.pmod(c, F.col("n"))))
    a = a.withColumn("c", F.explode(cells)).select("r", "c", "src_id", F.col("lat").alias("lat_a"), F.col("lng").alias("lng_a"), *(c for c in held if c in src.columns))
    b = ok(tgt).withColumn("r", row(F.col("lat"))).withColumn("n", across(F.col("r")))
    b = b.select("r", F.pmod(column(F.col("lng"), F.col("n")), F.col("n")).alias("c"), "tgt_id", F.col("lat").alias("lat_b"), F.col("lng").alias("lng_b"), *(c for c in held if c in tgt.columns))
    parts = 4 * int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = a.repartition(parts, "r", "c").join(b.repartition(parts, "r", "c").hint("shuffle_hash"), ["r", "c"])
    dist = geo.haversine_m(F.col("lat_a"), F.col("lng_a"), F.col("lat_b"), F.col("lng_b"))
    return met.withColumn("dist_m", dist).where(F.col("dist_m") <= km * 1000).select("src_id", "tgt_id", "dist_m", *held)


def _scored(src: DataFrame, tgt: DataFrame, passes: list[tuple], swap: bool) -> DataFrame:
    """Pairs some pass can take: no further apart than its distance and, at that distance, more alike than the least any asks for."""
    name = text.normalize(F.col("name"), stopwords=not swap)
    a, b = (checkpoint(df.select(i, "lat", "lng", name.alias(c)).withColumn(f"bits_{c}", text.letter_bits(F.col(c)))) for df, i, c in ((src, "src_id", "a"), (tgt, "tgt_id", "b")))
    near = _near(a, b, max(p[0] for p in passes), ["a", "b", "bits_a", "bits_b"])
    asks = F.array_min(F.array(*(F.when(F.col("dist_m") <= km * 1000, F.lit(float(least))) for km, least, *_ in passes)))
    near = near.withColumn("__low", asks).where(text.bits_bound("bits_a", "bits_b", swap) > F.col("__low"))
    return _score(near.select("src_id", "tgt_id", "dist_m", "a", "b", "__low"), swap).select("src_id", "tgt_id", "dist_m", "score")


def cascade(src: DataFrame, tgt: DataFrame, passes=CASCADE) -> DataFrame:
    """(src_id, tgt_id, score, step): passes from strict in distance to strict in name; what matched is out of the later ones.

    The pairs of the widest pass are found and compared once; a pass takes its part of them. Passes in a row that may
    choose among several candidates are one assignment, earlier passes first: an edge that one of them could take and
    did not has lost an end to it, so it counts in the first that could only.
    """
    edges = {swap: checkpoint(spread(_scored(src, tgt, [p for p in passes if p[3] == swap], swap))) for swap in {p[3] for p in passes}}
    done = None
    for (only, swap), group in groupby(enumerate(passes), lambda p: (p[1][2], p[1][3])):
        for some in [[p] for p in group] if only else [list(group)]:
            step = F.coalesce(*(F.when((F.col("dist_m") <= km * 1000) & (F.col("score") > least), k) for k, (km, least, *_) in some))
            left = edges[swap].withColumn("step", step).where("step IS NOT NULL")
            if done is not None:
                left = left.join(done.select("src_id"), "src_id", "left_anti").join(done.select("tgt_id"), "tgt_id", "left_anti")
            if only:
                left = left.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("src_id"))).where("n = 1").drop("n")
            found = assign(left, first="step").select("src_id", "tgt_id", "score", "step")
            done = found if done is None else done.unionByName(found)
    return done


def best_of_group(df: DataFrame, group: str, features: list[str], dist: str, ident: str, exact: bool = True) -> DataFrame:
    """Best candidate of each group: each feature as a share of the group's sum, plus nearness.

    Zero sums are skipped. ``exact`` weighs nearness as 1/dist over the sum of 1/dist; without it the divisor is the
    number of candidates with a distance. A distance of 0 counts 1. Adds ``group_score`` and ``label`` (1 for the best).
    """
    w = Window.partitionBy(group)
    parts = [F.coalesce(F.try_divide(F.col(f), F.sum(f).over(w)), F.lit(0.0)) for f in features]
    near = F.when(F.col(dist) == 0, 1.0).otherwise((1 / F.col(dist)) / (F.sum(F.try_divide(F.lit(1.0), F.col(dist))).over(w) if exact else F.count(dist).over(w)))
    score = F.coalesce(near, F.lit(0.0))
    for p in parts:
        score = score + p
    out = df.withColumn("group_score", score)
    return out.withColumn("label", (F.row_number().over(w.orderBy(F.desc("group_score"), ident)) == 1).cast("int"))


def cooccurrence(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of value pairs; missing ones count as NONE."""
    none = lambda c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("NONE"))
    return df.groupBy(none(F.col(a)).alias("a"), none(F.col(b)).alias("b")).agg(F.count(F.lit(1)).alias("cnt"))


def suspicious(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    """Pairs(chain, chain_b, name, name_b) whose chains are a rule's (a, b) though neither name holds the other's chain."""
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    met = pairs.join(rules, (F.col("chain") == F.col("a")) & (F.col("chain_b") == F.col("b")))
    return met.where((F.col("a") != "") & (F.col("b") != "") & ~F.contains(low("name_b"), low("a")) & ~F.contains(low("name"), low("b"))).drop("a", "b")


def within_ratio(df: DataFrame, group: str, value: str, ratio: float) -> DataFrame:
    """Rows whose value is below ``ratio`` times the least of their group."""
    return df.withColumn("__least", F.min(value).over(Window.partitionBy(group))).where(F.col(value) < F.col("__least") * ratio).drop("__least")


def geoname(pairs: DataFrame) -> DataFrame:
    """pairs(name_sim, dist_m) with ``geoname_sim``: nearness times the square of the names' similarity."""
    return pairs.withColumn("geoname_sim", geo.dist_to_sim(F.col("dist_m")) * F.col("name_sim") * F.col("name_sim"))


def chain_similarity(pairs: DataFrame, known: bool = True) -> DataFrame:
    """pairs(chain_a, chain_b, …) with ``chain_sim`` and ``chain_sim_sw``, the ratio and token-swap ratio of the chains; 0 for all where the source has no chains."""
    if not known:
        return pairs.withColumn("chain_sim", F.lit(0.0)).withColumn("chain_sim_sw", F.lit(0.0))
    two = pairs.select("chain_a", "chain_b").distinct()
    x, y = text.normalize(F.col("chain_a"), stopwords=False), text.normalize(F.col("chain_b"), stopwords=False)
    two = two.select("chain_a", "chain_b", text.ratio(x, y).alias("chain_sim"), text.swap_ratio(x, y).alias("chain_sim_sw"))
    met = (pairs["chain_a"].eqNullSafe(two["chain_a"])) & (pairs["chain_b"].eqNullSafe(two["chain_b"]))
    return pairs.join(two, met, "left").drop(two["chain_a"]).drop(two["chain_b"])


def ranked_candidates(pairs: DataFrame, taken: DataFrame | None = None, least: float = 0.5, k: int = 5) -> DataFrame:
    """pairs(src_id, tgt_id, score) above ``least``, the k best of each source for a person to choose from; those of ``taken``(src_id) are left out."""
    left = pairs.where(F.col("score") > least)
    if taken is not None:
        left = left.join(taken.select("src_id"), "src_id", "left_anti")
    rank = F.row_number().over(Window.partitionBy("src_id").orderBy(F.desc("score"), "tgt_id"))
    return left.withColumn("rank", rank).where(F.col("rank") <= k)
