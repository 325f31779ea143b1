"""Fusion of ranked lists: lists(qid, list_id, id, dist) with a weight per list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quoin.session import prepare


def _tail(scored: DataFrame, max_len: int, max_weight: float) -> DataFrame:
    """The limit on the length comes before the one on the score."""
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("score", "id"))
    out = scored.withColumn("rank", rank).where(F.col("rank") <= max_len)
    return out.where(F.col("score") <= max_weight) if max_weight >= 0 else out


def _weighted(lists: DataFrame, weights: dict) -> DataFrame:
    w = F.coalesce(F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))[F.col("list_id")], F.lit(1.0)) if weights else F.lit(1.0)
    return lists.select("qid", "list_id", "id", (F.col("dist") * w).alias("d"))


def blending(lists: DataFrame, weights: dict | None = None, max_len: int = 5, max_weight: float = -1) -> DataFrame:
    """Least weighted distance of an item over the lists."""
    return _tail(_weighted(lists, weights or {}).groupBy("qid", "id").agg(F.min("d").alias("score")), max_len, max_weight)


def ensembling(lists: DataFrame, weights: dict | None = None, max_len: int = 5, max_weight: float = -1) -> DataFrame:
    """Sum over a query's lists of the weighted distance, or of the list's default where the item isn't in it.

    The default grows along the list, taken by distance: a value above it makes it half as much again as the value.
    """
    prepare(lists.sparkSession)
    v = _weighted(lists, weights or {})
    grown = F.aggregate(F.array_sort(F.collect_list("d")), F.lit(0.0), lambda d, x: F.when(x > d, 1.5 * x).otherwise(d))
    default = v.groupBy("qid", "list_id").agg(grown.alias("default"))
    sums = default.groupBy("qid").agg(F.sum("default").alias("all"))
    own = v.groupBy("qid", "list_id", "id").agg(F.min("d").alias("d")).join(default, ["qid", "list_id"])
    # All defaults, and for each list that holds the item its value in the default's place.
    score = own.groupBy("qid", "id").agg(F.sum(F.col("d") - F.col("default")).alias("diff")).join(sums, "qid")
    return _tail(score.select("qid", "id", (F.col("all") + F.col("diff")).alias("score")), max_len, max_weight)


def duplicates(hashes: DataFrame, max_dist: int = 6) -> DataFrame:
    """Nearest item by any hash, if within ``max_dist`` bits."""
    return blending(hashes, {}, 1, max_dist)


def similar(lists: DataFrame, bow: float = 0.5, rgb: float = 0.5, fixed_weights: bool = False, combine: str = "blending", threshold: float | None = None) -> DataFrame:
    """Histogram and bag-of-words lists (list_id rgb, yuv, bow) fused, best 20 up to 2.

    As published the weight of yuv is 1 + bow - rgb's, which tuned thresholds depend on; ``fixed_weights`` makes it 1 - bow - rgb's.
    """
    r = (1 - bow) * rgb
    weights = {"bow": float(bow), "rgb": float(r), "yuv": float(1 - bow - r if fixed_weights else 1 + bow - r)}
    out = (blending if combine == "blending" else ensembling)(lists, weights, 20, 2)
    return out.where(F.col("score") < threshold) if threshold is not None else out


def global_local(whole: DataFrame, parts: DataFrame, share: float = 0.9, max_len: int = 20) -> DataFrame:
    """Ensembling of two lists(qid, id, dist): of whole images with that share, of their parts with the rest."""
    both = whole.select("qid", F.lit("whole").alias("list_id"), "id", "dist").unionByName(parts.select("qid", F.lit("parts").alias("list_id"), "id", "dist"))
    return ensembling(both, {"whole": share, "parts": 1 - share}, max_len)


#: Ways to search: how lists are fused, their weights, the length of the result, the highest score.
VARIANTS = {
    "blend": ("blending", {}, 5, 2.0), "ensemble": ("ensembling", {}, 5, 6.0), "hog": ("blending", {"hog": 0.8, "sift": 1.0}, 5, 2.0), "hog_ensemble": ("ensembling", {"hog": 0.8, "sift": 1.0}, 5, 6.0),
}


def search_variant(lists: DataFrame, name: str) -> DataFrame:
    how, weights, max_len, top = VARIANTS[name]
    return (blending if how == "blending" else ensembling)(lists, weights, max_len, top)


def grid(lists: DataFrame, relevant: DataFrame, weights: list[dict], thresholds: list[float], combine: str = "blending") -> DataFrame:
    """(setting, threshold, tp, fp, fn, precision, recall) of each weighting and limit, from lists and relevant(qid, id).

    A found pair below the limit counts against the pairs that are relevant; settings are few, rows are fused once each.
    """
    out = None
    for i, w in enumerate(weights):
        fused = (blending if combine == "blending" else ensembling)(lists, w, 1, -1).select("qid", "id", "score")
        both = fused.join(relevant.select("qid", "id", F.lit(1).alias("y")), ["qid", "id"], "full")
        t = F.explode(F.array(*(F.lit(float(x)) for x in thresholds)))
        rows = both.select(t.alias("threshold"), "score", F.coalesce("y", F.lit(0)).alias("y"))
        hit = F.coalesce(F.col("score") < F.col("threshold"), F.lit(False))
        n = rows.groupBy("threshold").agg(F.count_if(hit & (F.col("y") == 1)).alias("tp"), F.count_if(hit & (F.col("y") == 0)).alias("fp"), F.count_if(~hit & (F.col("y") == 1)).alias("fn"))
        part = n.select(F.lit(i).alias("setting"), "threshold", "tp", "fp", "fn", F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"), F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0)).alias("recall"))
        out = part if out is None else out.unionByName(part)
    return out
