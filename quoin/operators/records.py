"""Records made of nested documents, and small relational helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quoin.functions import text

# Words in the lines on internet and parking, and the flags they set.
FLAGS = {
    "internet": {"free_internet": ("Free",), "wifi": ("WiFi", "Wireless"), "paid_internet": ("and costs", "paid")},
    "parking": {
        "free_parking": ("Free",), "private_parking": ("Private parking is possible",), "public_parking": ("Public parking is possible",), "parking_reservation_not_needed": ("reservation is not needed",),
        "parking_reservation_needed": ("reservation is needed",), "parking_reservation_not_possible": ("reservation is not possible",), "paid_parking": ("and costs",),
    },
}


def prune(m: Column) -> Column:
    """map<string, array<string>> without blank and null members, nor entries left empty; null stays null."""
    kept = F.transform_values(m, lambda _, v: F.filter(v, lambda x: x.isNotNull() & (F.trim(x) != "")))
    return F.map_filter(kept, lambda _, v: F.coalesce(F.size(v) > 0, F.lit(False)))


def facility_flags(docs: DataFrame, key: str, column: str = "facilities") -> DataFrame:
    """(key, flags 0/1): which words stand in the lines of a document's internet and parking facilities; 0 without such lines."""
    out = [key]
    for category, flags in FLAGS.items():
        lines = F.try_element_at(F.col(column), F.lit(category))
        for name, words in flags.items():
            hit = F.exists(lines, _any(words))
            out.append(F.coalesce(hit.cast("int"), F.lit(0)).alias(name))
    return docs.select(*out)


def _any(words: tuple[str, ...]):
    """Column function: the text holds one of the words; False for null."""

    def holds(x: Column) -> Column:
        found = F.contains(x, F.lit(words[0]))
        for w in words[1:]:
            found = found | F.contains(x, F.lit(w))
        return F.coalesce(found, F.lit(False))

    return holds


def hotel_records(docs: DataFrame) -> DataFrame:
    """A row per document: its type, how many categories of facilities and rooms it has, and the number of rooms its text names."""
    size = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("long")
    named = F.nullif(F.regexp_extract("number_of_rooms", "([0-9]+)", 1), F.lit("")).try_cast("int")
    return docs.select("det_id", F.coalesce("type", F.lit("none")).alias("type"), size("facilities").alias("n_categories"), size("rooms").alias("n_rooms"), named.alias("rooms_named"))


def room_records(docs: DataFrame) -> DataFrame:
    """A row per room with a score: its place, size, number of photos, and the score as label."""
    r = docs.select("det_id", F.posexplode("rooms").alias("pos", "r")).where(F.col("r.livingscore").isNotNull())
    n = F.coalesce(F.when(F.col("r.gallery").isNotNull(), F.size("r.gallery")), F.lit(0)).cast("long")
    return r.select("det_id", "pos", text.room_size(F.col("r.facilities")).alias("size"), n.alias("images"), F.col("r.livingscore").alias("label"))


def concatenated(lists: Column) -> Column:
    """One list of all members of the lists that are there, nulls left out."""
    return F.filter(F.flatten(F.filter(lists, lambda v: v.isNotNull())), lambda x: x.isNotNull())


def clock(seconds: Column) -> Column:
    """Minutes and seconds as mm:ss."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(two(F.floor(seconds / 60)), F.lit(":"), two(seconds % 60))


def share_of(key: Column, parts: int = 100) -> Column:
    """A number in [0, parts) that depends on the key alone: for splits that come out alike on every run."""
    return F.pmod(key * 7919 + 13, F.lit(parts))


def merged(sets: list[DataFrame], order: list[str], position: str) -> DataFrame:
    """Ordered sets as one ordered set, duplicates kept, with the place of each row from 1.

    Rows are sorted over all tasks and numbered by partition offsets, so no task holds them all.
    """
    rows = sets[0]
    for s in sets[1:]:
        rows = rows.unionByName(s)
    placed = rows.orderBy(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    first = placed.groupBy("__part").agg(F.min("__at").alias("__min"), F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # A row per partition: bounded by their number.
    offsets = F.broadcast(first.withColumn("__before", before).drop("__n"))
    return placed.join(offsets, "__part").withColumn(position, (F.col("__before") + F.col("__at") - F.col("__min") + 1).cast("int")).drop("__part", "__at", "__min", "__before")
