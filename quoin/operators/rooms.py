"""Photos and rooms of matched properties: duplicates, similar photos, room types and scores carried over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quoin.operators import fusion, scoring, search

# Room types by the first letter of their code; their order is the rank scores rise in.
TYPE_CODES = {
    "H": "Accessible room", "I": "Budget room", "B": "Business room", "G": "Comfort room", "D": "Deluxe Room", "X": "Duplex", "E": "Executive room",
    "C": "Concierge/Executive Suite", "F": "Family Room", "S": "Junior Suite/Mini Suite", "P": "Penthouse", "R": "Residential apartment", "M": "Standard",
    "L": "Studio", "A": "Superior", "V": "Villa",
}


def nearest_duplicates(queries: DataFrame, items: DataFrame, most: int = 6) -> DataFrame:
    """queries, items(key, id, code) -> (qid, id, dist): the nearest item of the same key, if within ``most`` bits; ties by id.

    Null keys and codes meet nothing.
    """
    some = lambda df: df.where(F.col("key").isNotNull() & F.col("code").isNotNull()).select("key", "id", "code")
    met = search._hamming_blocks(some(queries), some(items), most, "key").select(F.col("a_id").alias("qid"), F.lit("hash").alias("list_id"), F.col("b_id").alias("id"), "dist")
    return fusion.duplicates(met, most).select("qid", "id", F.col("score").alias("dist"))


def best_matches(queries: DataFrame, items: DataFrame, k: int = 5, kind: str = "l2sq") -> DataFrame:
    """queries, items(key, id, vec) -> (qid, id, dist, rank): every query against all items of its key, the k nearest."""
    return search.knn(items, queries, k, kind, key="key")


def similar_photos(queries: DataFrame, items: DataFrame, most: int = 6, weights: dict | None = None, k: int = 5) -> DataFrame:
    """(qid, id, score, how): the duplicate of a photo, or where there is none the blend of its nearest by both distances.

    queries, items(key, id, code, vec). Lists go in at 20 long; the fused one is cut to k.
    """
    dup = nearest_duplicates(queries, items, most)
    rest = queries.join(dup.select(F.col("qid").alias("id")), "id", "left_anti")
    lists = None
    for name, kind in (("l2", "l2sq"), ("cos", "cosine")):
        got = best_matches(rest, items, 20, kind).select("qid", F.lit(name).alias("list_id"), "id", (F.sqrt("dist") if kind == "l2sq" else F.col("dist")).alias("dist"))
        lists = got if lists is None else lists.unionByName(got)
    near = fusion.blending(lists.withColumn("dist", F.round("dist", 9)), weights or {"l2": 0.5, "cos": 0.5}, k)
    return dup.select("qid", "id", F.col("dist").cast("double").alias("score"), F.lit("duplicate").alias("how")).unionByName(near.select("qid", "id", "score", F.lit("similar").alias("how")))


def transfer_types(matches: DataFrame, queries: DataFrame, items: DataFrame) -> DataFrame:
    """(qid, type, cnt): per photo the commonest room types of the photos it matches, of those its own property has; ties stay.

    matches(qid, id), queries(id, key, room), items(id, room); a property's types are those of all its rooms' names.
    """
    types = lambda df, *keep: df.where(F.col("room").isNotNull()).select(*keep, F.explode(scoring.room_types(F.col("room"))).alias("type"))
    own = types(queries, "key").distinct()
    met = matches.join(types(items, "id"), "id").join(queries.select(F.col("id").alias("qid"), "key"), "qid")
    return scoring.modes(met.join(own, ["key", "type"], "left_semi"), "qid", "type")


def score_types(rooms: DataFrame, scores: DataFrame) -> DataFrame:
    """(key, type, score): sorted scores of a property laid over its room types in the order of their rank, averaged per type.

    rooms(key, room): distinct names give types; scores(key, scores array<double>). A property without names or scores has no row.
    """
    order = F.array(*(F.lit(t) for t in TYPE_CODES.values()))
    named = rooms.where(F.col("room").isNotNull()).select("key", "room").distinct().select("key", "room", F.explode(scoring.room_types(F.col("room"))).alias("type"))
    placed = named.withColumn("ord", F.array_position(order, F.col("type"))).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("ord", "room", "type"))).alias("t"))
    both = placed.join(scores.where(F.size("scores") > 0), "key").withColumn("s", scoring.interpolate(F.col("scores"), F.size("t")))
    each = both.select("key", F.explode(F.arrays_zip("t", "s")).alias("x")).select("key", F.col("x.t.type").alias("type"), F.col("x.s").alias("s"))
    return each.groupBy("key", "type").agg(F.avg("s").alias("score"))


def type_of(name: Column, code: Column, description: Column) -> Column:
    """Room types by precedence: a known name, else the code's first letter, else the description's first line by its words."""
    by_code = F.create_map(*(F.lit(x) for kv in TYPE_CODES.items() for x in kv))[F.substring(code, 1, 1)]
    line = F.trim(F.element_at(F.split(F.coalesce(description, F.lit("")), "\n"), 1))
    none = F.array().cast("array<string>")
    by_line = F.when(line == "", none).otherwise(scoring.room_types(line))
    coded = F.when(by_code.isNotNull(), F.array(by_code)).otherwise(none)
    return F.when(F.coalesce(name.isin(list(TYPE_CODES.values())), F.lit(False)), F.array(name)).when(F.coalesce(code, F.lit("")) != "", coded).otherwise(by_line)


def halves(photos: DataFrame, property_: str, room: str, photo: str, least_rooms: int, least_photos: int) -> DataFrame:
    """Photos of properties with so many rooms of so many photos each, with ``half``: 1 or 2, in each room by the photo's id."""
    rooms = photos.groupBy(property_, room).agg(F.count(F.lit(1)).alias("n"))
    kept = rooms.groupBy(property_).agg(F.count(F.lit(1)).alias("rooms"), F.min("n").alias("least")).where((F.col("rooms") >= least_rooms) & (F.col("least") >= least_photos))
    half = F.ntile(2).over(Window.partitionBy(property_, room).orderBy(photo))
    return photos.join(kept.select(property_), property_, "left_semi").withColumn("half", half)
