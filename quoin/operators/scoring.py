"""Scores from nested documents and reviews: room scores, tag polarity, interpolation, room types, evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The 19 review tags in the order of their flags.
TAGS = (
    "WiFi", "Quietness", "Bathroom", "Facilities", "Staff", "Parking & Transport", "Location", "In-room facilities", "Spa & Gym", "Price",
    "Cleanliness", "Ambiance", "Spaciousness", "Food & Beverage", "Breakfast", "Bedding", "Freebies", "Views & Surroundings", "Host",
)
# Words of a room's name and the room type they mean; all words of a key must stand in the name.
ROOM_WORDS = {
    "studio": "Studio", "apartment": "Residential apartment", "business": "Business room", "standard": "Standard", "superior": "Superior",
    "penthouse": "Penthouse", "deluxe": "Deluxe Room", "executive": "Executive room", "king room": "Executive room", "queen room": "Executive room",
    "king suite": "Concierge/Executive Suite", "queen suite": "Concierge/Executive Suite", "conference suite": "Concierge/Executive Suite",
    "comfort": "Comfort room", "family": "Family Room", "accessible": "Accessible room", "presidential": "Penthouse", "basic": "Budget room", "classic": "Budget room",
}


def room_types(name: Column) -> Column:
    """Sorted distinct room types of a room's name; a suite of no other kind is a junior suite, no word at all is Standard."""
    low = F.lower(F.coalesce(name, F.lit("")))
    toks = F.split(F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " ")), " ")
    rules = F.array(*(F.struct(F.array(*(F.lit(w) for w in k.split())).alias("words"), F.lit(v).alias("type")) for k, v in ROOM_WORDS.items()))
    hits = F.transform(F.filter(rules, lambda r: F.size(F.array_except(r["words"], toks)) == 0), lambda r: r["type"])
    junior = F.contains(low, F.lit("suite")) & ~F.array_contains(hits, "Concierge/Executive Suite")
    hits = F.when(junior, F.array_append(hits, F.lit("Junior Suite/Mini Suite"))).otherwise(hits)
    return F.when(F.size(hits) == 0, F.array(F.lit("Standard"))).otherwise(F.array_sort(F.array_distinct(hits)))


def room_scores(docs: DataFrame, key: str = "hotel_id") -> DataFrame:
    """(key, n, low, high, mean) of the scores of a document's rooms; rooms without one don't count, nor do documents without any."""
    s = F.filter(F.transform("rooms", lambda r: r["livingscore"]), lambda x: x.isNotNull() & ~F.isnan(x))
    got = docs.select(key, s.alias("s")).where(F.size("s") > 0)
    mean = F.aggregate("s", F.lit(0.0), lambda a, x: a + x) / F.size("s")
    return got.select(key, F.size("s").alias("n"), F.array_min("s").alias("low"), F.array_max("s").alias("high"), mean.alias("mean"))


def interpolate(scores: Column, k: Column) -> Column:
    """k values along the sorted scores, at places 0 to n in equal steps; places beyond the last score are the last. k = 1 is the mean."""
    v = F.array_sort(scores)
    n = F.size(v)
    at = lambda i: F.get(v, F.least(n - 1, i).cast("int"))
    x = lambda i: i * n / (k - 1)
    value = lambda i: at(F.floor(x(i))) + (at(F.ceil(x(i))) - at(F.floor(x(i)))) * (x(i) - F.floor(x(i)))
    mean = F.aggregate(v, F.lit(0.0), lambda s, y: s + y) / n
    return F.when(n == 0, F.array().cast("array<double>")).when(k == 1, F.array(mean)).otherwise(F.transform(F.sequence(F.lit(0), k - 1), value))


def merge_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews(hotel_id, positive, negative, tags) with the same text once, their tags or-ed; blank ones out, null tags as none."""
    blank = F.lit("")
    pos, neg = F.trim(F.coalesce("positive", blank)), F.trim(F.coalesce("negative", blank))
    flags = F.transform(F.sequence(F.lit(0), F.lit(len(TAGS) - 1)), lambda i: F.coalesce(F.get("tags", i), F.lit(0)))
    rows = reviews.select("hotel_id", pos.alias("positive"), neg.alias("negative"), flags.alias("f")).where("positive <> '' OR negative <> ''")
    best = F.array(*(F.max(F.get("f", F.lit(i))) for i in range(len(TAGS))))
    return rows.groupBy("hotel_id", "positive", "negative").agg(best.alias("tags"))


def tag_polarity(reviews: DataFrame) -> DataFrame:
    """(hotel_id, tag, p, n, score): votes of reviews with only praise and only blame per tag; p over both, 0.5 without votes."""
    blank = F.lit("")
    praise = (F.trim(F.coalesce("positive", blank)) != "").cast("int")
    blame = (F.trim(F.coalesce("negative", blank)) != "").cast("int")
    names = F.array(*(F.lit(t) for t in TAGS))
    votes = reviews.where(F.col("tags").isNotNull()).select("hotel_id", praise.alias("p"), blame.alias("n"), F.posexplode("tags").alias("i", "flag")).where("flag = 1")
    sums = votes.groupBy("hotel_id", "i").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    return sums.select("hotel_id", F.get(names, F.col("i")).alias("tag"), "p", "n", F.coalesce(F.try_divide("p", F.col("p") + F.col("n")), F.lit(0.5)).alias("score"))


def modes(df: DataFrame, group: str, value: str) -> DataFrame:
    """All values that are most frequent in their group."""
    n = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("cnt"))
    return n.withColumn("r", F.rank().over(Window.partitionBy(group).orderBy(F.desc("cnt")))).where("r = 1").drop("r")


def threshold_sweep(df: DataFrame, score: str, label: str, thresholds: list[float]) -> DataFrame:
    """Confusion counts, precision, recall, F1 and accuracy of score >= threshold for each threshold, in one pass."""
    t = F.explode(F.array(*(F.lit(float(x)) for x in thresholds)))
    rows = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).select(t.alias("threshold"), F.col(score).alias("s"), (F.col(label) == 1).alias("y"))
    hit = F.col("s") >= F.col("threshold")
    n = rows.groupBy("threshold").agg(F.count_if(hit & F.col("y")).alias("tp"), F.count_if(hit & ~F.col("y")).alias("fp"), F.count_if(~hit & F.col("y")).alias("fn"), F.count_if(~hit & ~F.col("y")).alias("tn"))
    p, r = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    return n.select("threshold", "tp", "fp", "fn", "tn", F.coalesce(p, F.lit(0.0)).alias("precision"), F.coalesce(r, F.lit(0.0)).alias("recall"), F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)).alias("f1"), ((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))).alias("accuracy"))


def average_precision(ranked: DataFrame) -> DataFrame:
    """ranked(qid, rank, relevant 0/1) -> (qid, ap): area under the curve of precision over recall by trapezoids."""
    w = Window.partitionBy("qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = ranked.withColumn("hits", F.sum("relevant").over(w)).where("relevant = 1")
    before = F.when(F.col("rank") == 1, 1.0).otherwise((F.col("hits") - 1) / (F.col("rank") - 1))
    return hits.groupBy("qid").agg((F.sum((before + F.col("hits") / F.col("rank")) / 2) / F.count(F.lit(1))).alias("ap"))


def one_hot(df: DataFrame, group: str, value: str, values: list[str]) -> DataFrame:
    """Counts of each known value per group; values not seen at the fit are left out."""
    return df.groupBy(group).agg(*(F.count_if(F.col(value) == v).alias(v) for v in values))


def flatten_record(df: DataFrame, sep: str = "::") -> DataFrame:
    """Struct members as columns named by their path; lists and maps stay as they are."""

    def walk(schema, path: tuple[str, ...]) -> list:
        out = []
        for f in schema.fields:
            p = (*path, f.name)
            out += walk(f.dataType, p) if hasattr(f.dataType, "fields") else [F.col(".".join(f"`{x}`" for x in p)).alias(sep.join(p))]
        return out

    return df.select(*walk(df.schema, ()))
