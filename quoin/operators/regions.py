"""Points in regions by crossing parity, and points near points built on it.

A region is a ring of vertices. Its edges are cut into latitude strips and, within a strip, copied to the
longitude tiles from the west end of the region to the edge's own east end, so that points and edges meet in an equi-join on (strip, tile).
A ray runs from each point to the east; the crossings are summed per (point, region) and an odd number
means inside. Points on an edge are found by an explicit test and count as inside, so a point on the
border of two regions belongs to both.

Everything is a Catalyst expression. One tile holds few points unless very many share one position;
``pairs_within`` therefore works on distinct positions and only then goes back to the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088
#: Tile height in degrees and width in degrees at the equator.
STRIP_DEG = 0.02
#: Beyond this latitude a circle may hold the pole, so its region is a full band of longitudes.
POLAR_LAT = 89.0
#: Rows of one position beyond this many are cut into parts.
PART_ROWS = 2048


def great_circle_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column, radius: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance; the argument of the root is clamped to [0, 1]."""
    h = F.pow(F.sin(F.radians(lat_b - lat_a) / 2), 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(F.sin(F.radians(lng_b - lng_a) / 2), 2)
    return F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), h)))) * (2 * radius)


def has_position(lat: Column, lng: Column) -> Column:
    """False for null, NaN, |lat| >= 90, |lng| > 180 and for the placeholder (0, 0); never null."""
    ok = ~F.isnan(lat) & ~F.isnan(lng) & (F.abs(lat) < 90) & (F.abs(lng) <= 180) & ~((lat == 0) & (lng == 0))
    return F.coalesce(ok, F.lit(False))


def _strip(lat: Column, deg: float) -> Column:
    return F.floor((lat + 90) / deg).cast("int")


def _tiles(strip: Column, deg: float) -> Column:
    """Number of tiles round the globe in a strip: fewer towards the poles, so that tiles keep their width."""
    edge = F.least(F.abs(strip * deg - 90), F.abs((strip + 1) * deg - 90))
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(edge)) * (360 / deg))).cast("int")


def _tile(lng: Column, strip: Column, deg: float) -> Column:
    n = _tiles(strip, deg)
    return F.least(n - 1, F.greatest(F.lit(0), F.floor((lng + 180) / 360 * n).cast("int")))


def points_in_regions(points: DataFrame, regions: DataFrame, strip_deg: float = STRIP_DEG) -> DataFrame:
    """points(pid, lat, lng) x regions(rid, ring array<struct<lng, lat>>) -> (pid, rid), each pair once.

    The ring needs no closing vertex. Longitudes may pass beyond +-180 if the ring crosses the antimeridian:
    parts beyond are matched with points shifted by 360 degrees. Points without a position and regions
    with a null ring or fewer than three vertices give no row. Ids should be unique: points with one id
    count as one region test each, and the pair comes out once. Other columns are ignored.
    """
    nxt = F.expr("transform(ring, (v, i) -> struct(v.lng as x1, v.lat as y1, ring[(i + 1) % size(ring)].lng as x2, ring[(i + 1) % size(ring)].lat as y2))")
    reg = regions.where(F.size("ring") >= 3).select(
        F.col("rid"), F.array_min(F.expr("transform(ring, v -> v.lng)")).alias("x_lo"), F.array_max(F.expr("transform(ring, v -> v.lng)")).alias("x_hi"), nxt.alias("edges")
    )
    # The ring is used where it is and, if it passes the antimeridian, once more where the other side is.
    shift = F.expr("filter(array(0, 360, -360), s -> x_lo + s <= 180 and x_hi + s >= -180)")
    reg = reg.withColumn("shift", F.explode(shift))
    edge = reg.select("rid", (F.col("x_lo") + F.col("shift")).alias("x_lo"), (F.col("x_hi") + F.col("shift")).alias("x_hi"), "shift", F.explode("edges").alias("e")).select(
        "rid", "x_lo", "x_hi", (F.col("e.x1") + F.col("shift")).alias("x1"), F.col("e.y1").alias("y1"), (F.col("e.x2") + F.col("shift")).alias("x2"), F.col("e.y2").alias("y2")
    )
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    edge = edge.withColumn("strip", F.explode(F.sequence(_strip(low, strip_deg), _strip(high, strip_deg))))
    # A ray to the east meets an edge only from the west of its own east end, and from within the region's box.
    first, last = _tile(F.col("x_lo"), F.col("strip"), strip_deg), _tile(F.greatest("x1", "x2"), F.col("strip"), strip_deg)
    edge = edge.where(F.greatest("x1", "x2") >= -180).withColumn("tile", F.explode(F.sequence(first, last))).drop("x_lo", "x_hi")
    pts = points.where(F.col("lat").isNotNull() & F.col("lng").isNotNull() & ~F.isnan("lat") & ~F.isnan("lng") & (F.abs("lat") <= 90) & (F.abs("lng") <= 180))
    pts = pts.select("pid", F.col("lat").alias("py"), F.col("lng").alias("px"), _strip(F.col("lat"), strip_deg).alias("strip"))
    pts = pts.withColumn("tile", _tile(F.col("px"), F.col("strip"), strip_deg))
    met = pts.join(edge, ["strip", "tile"])
    spans = (F.col("y1") > F.col("py")) != (F.col("y2") > F.col("py"))
    at = F.col("x1") + (F.col("py") - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
    crossing = F.coalesce(spans & (F.col("px") < at), F.lit(False))
    in_box = F.col("px").between(F.least("x1", "x2"), F.greatest("x1", "x2")) & F.col("py").between(low, high)
    on_edge = in_box & (((F.col("x2") - F.col("x1")) * (F.col("py") - F.col("y1")) - (F.col("y2") - F.col("y1")) * (F.col("px") - F.col("x1"))) == 0)
    met = met.select("pid", "rid", crossing.cast("int").alias("c"), on_edge.cast("int").alias("b")).where("c + b > 0")
    return met.groupBy("pid", "rid").agg(F.sum("c").alias("c"), F.max("b").alias("b")).where((F.col("c") % 2 == 1) | (F.col("b") == 1)).select("pid", "rid")


def circle_ring(lat: Column, lng: Column, km: float) -> Column:
    """Four vertices round the circle of that radius; beyond POLAR_LAT a band of all longitudes."""
    reach = math.degrees(km / EARTH_RADIUS_KM) * 1.001 + 1e-9
    wide = F.when(F.abs(lat) < POLAR_LAT, F.lit(reach) / F.cos(F.radians(F.abs(lat) + reach)))
    south, north = F.greatest(lat - reach, F.lit(-90.0)), F.least(lat + reach, F.lit(90.0))
    west, east = F.coalesce(lng - wide, F.lit(-180.0)), F.coalesce(lng + wide, F.lit(180.0))
    corner = lambda x, y: F.struct(x.alias("lng"), y.alias("lat"))
    return F.array(corner(west, south), corner(east, south), corner(east, north), corner(west, north))


def pairs_within(df: DataFrame, key: str, group: str, km: float) -> DataFrame:
    """Pairs (key_a < key_b) of rows with different ``group`` at most ``km`` apart, from columns key, group, lat, lng.

    Rows without a position (see has_position) give no pair. A null group differs from every value and
    equals null. A repeated key gives its pair once. Rows at one position are paired through it, so the
    search itself only ever sees distinct positions; the result still lists every pair of rows.
    """
    rows = df.select(F.col(key).alias("k"), F.col(group).alias("g"), F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng"))
    rows = rows.where(has_position(F.col("lat"), F.col("lng"))).withColumn("p", F.struct((F.col("lat") + 0.0).alias("lat"), (F.col("lng") + 0.0).alias("lng")))
    # Positions that very many rows share are cut into parts, and the parts of two such positions meet in a task each.
    places = rows.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    crowded = places.where(F.col("n") > PART_ROWS).select("p", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts"))
    regions = places.select(F.col("p").alias("rid"), circle_ring(F.col("p.lat"), F.col("p.lng"), km).alias("ring"))
    near = points_in_regions(places.select(F.col("p").alias("pid"), "p.lat", "p.lng"), regions).where(F.col("pid") <= F.col("rid"))
    near = near.where(great_circle_km(F.col("pid.lat"), F.col("pid.lng"), F.col("rid.lat"), F.col("rid.lng")) <= km)
    every = lambda df, p, i: df.join(crowded.withColumnRenamed("p", p), p, "left").withColumn(i, F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    near = every(every(near, "pid", "i"), "rid", "j")
    rows = rows.join(crowded, "p", "left").withColumn("part", F.pmod(F.xxhash64("k"), F.coalesce("parts", F.lit(1))).cast("int"))
    a = rows.select(F.col("p").alias("pid"), F.col("part").alias("i"), F.col("k").alias("ka"), F.col("g").alias("ga"))
    b = rows.select(F.col("p").alias("rid"), F.col("part").alias("j"), F.col("k").alias("kb"), F.col("g").alias("gb"))
    both = near.join(a, ["pid", "i"]).join(b, ["rid", "j"]).where(~F.col("ga").eqNullSafe(F.col("gb")) & (F.col("ka") != F.col("kb")))
    # At one position every pair comes in both orders; between two positions it comes in one.
    both = both.where((F.col("pid") != F.col("rid")) | (F.col("ka") < F.col("kb")))
    return both.select(F.least("ka", "kb").alias(f"{key}_a"), F.greatest("ka", "kb").alias(f"{key}_b")).distinct()
