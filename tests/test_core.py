import itertools
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quoin.functions import geo, text
from quoin.functions import vectors as V
from quoin.operators import cluster, fusion, images, matching, nested, regions, scoring, search
from quoin.plans import catalog
from quoin.sources import io


def km(a, b):
    x, y, u, v = map(math.radians, (*a, *b))
    h = math.sin((u - x) / 2) ** 2 + math.cos(x) * math.cos(u) * math.sin((v - y) / 2) ** 2
    return 2 * regions.EARTH_RADIUS_KM * math.asin(min(1, math.sqrt(h)))


def test_pairs_within_equals_all_pairs(spark):
    random.seed(1)
    rows = [(i, f"g{i % 40}", c[0] + random.uniform(-0.01, 0.01), c[1] + random.uniform(-0.01, 0.01)) for i, c in enumerate(random.choices([(10, 10), (84, 179.999), (-54, -179.999), (89.99, 20), (0, 0.01)], k=150))]
    rows = [(i, g, lat, (lng + 180) % 360 - 180) for i, g, lat, lng in rows]
    rows += [(200, "a", 90.0, 1.0), (201, "b", None, 1.0), (202, "c", float("nan"), 1.0), (203, "d", 0.0, 0.0), (204, None, 10.0, 10.0), (205, None, 10.0, 10.0), (206, "x", 10.0, 10.0), (207, "q", 5.0, 181.0)]
    got = {tuple(r) for r in regions.pairs_within(spark.createDataFrame(rows, "id long, g string, lat double, lng double").withColumn("tile", F.lit(1)).withColumn("strip", F.lit(2)), "id", "g", 0.25).collect()}
    ok = [r for r in rows if r[2] is not None and r[2] == r[2] and abs(r[2]) < 90 and abs(r[3]) <= 180 and not (r[2] == 0 and r[3] == 0)]
    want = {(a[0], b[0]) for a, b in itertools.combinations(ok, 2) if a[1] != b[1] and km(a[2:], b[2:]) <= 0.25}
    assert got == want and len(want) > 50


def test_regions_of_any_shape_and_boundaries(spark):
    ring = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)]  # concave
    reg = spark.createDataFrame([("r", [{"lng": float(x), "lat": float(y)} for x, y in ring]), ("none", None), ("two", [{"lng": 0.0, "lat": 0.0}, {"lng": 1.0, "lat": 1.0}])], "rid string, ring array<struct<lng:double,lat:double>>")
    pts = spark.createDataFrame([("in", 0.5, 2.0), ("notch", 3.0, 2.0), ("edge", 0.0, 2.0), ("corner", 4.0, 4.0), ("out", 5.0, 5.0), ("left", 3.0, 0.2), ("null", None, 1.0)], "pid string, lat double, lng double")
    got = {r["pid"] for r in regions.points_in_regions(pts, reg, 0.5).collect()}
    assert got == {"in", "edge", "corner", "left"}
    assert regions.points_in_regions(pts.limit(0), reg).count() == 0


def test_nested_shapes(spark):
    docs = [
        (1, {"facilities": {"A": ["x", None, "y"], "B": "z", "C": None}, "rooms": [{"name": "r", "gallery": ["g", None]}, None, {"name": "s"}], "reviews": {"t,u": [{"positive": "p", "negative": None}, None]}}),
        (2, {"hotel_id": 5, "payload": {"version": 3, "body": {"facilities": [{"category": "A", "items": [{"name": "x", "free": True}]}, {"category": "B", "items": None}], "rooms": {"r00": {"name": "a"}, "r01": {"name": "b", "gallery": "one"}}, "reviews": [{"tags": ["t", "u"], "items": [{"positive": "q"}]}]}}}),
        (3, {"rooms": {"name": "only", "facilities": "f"}}), (4, [1, 2]), (5, {}),
    ]
    raw = spark.createDataFrame([(i, json.dumps(d)) for i, d in docs] + [(6, '{"rooms": [{"na'), (7, None)], "det_id long, body string")
    nodes = nested.label_nodes(raw)
    got = {(r["det_id"], r["kind"], r["parent_label"], r["pos"]) for r in nested.link_nodes(nodes).where("parent_pre is not null").collect()}
    assert got == {
        (1, "facility", "A", 0), (1, "facility", "A", 2), (1, "facility", "B", 0), (1, "room", "", 0), (1, "room", "", 2), (1, "image", "0", 0), (1, "review", "t,u", 0),
        (2, "facility", "A", 0), (2, "room", "", 0), (2, "room", "", 1), (2, "image", "1", 0), (2, "review", "t,u", 0), (3, "room", "", 0),
    }
    flat = nested.flat_tables(nodes)
    assert {r["url"] for r in flat["images"].collect()} == {"g", "one"} and {r["name"] for r in flat["rooms"].collect()} == {"r", "s", "a", "b", "only"}
    for r in nodes.collect():
        assert r["pre"] < r["post"]


def test_names_and_similarity(spark):
    assert text.ratio_of("abcd", "bcde") == 0.75 and text.ratio_of("", "a") == 0
    assert text.swap_ratio_of("grand hotel", "hotel grand spa") == 1.0
    df = spark.createDataFrame([("Grand-Hôtel & Spa, Airport",), (None,), ("",)], "n string")
    assert [r[0] for r in df.select(text.normalize(F.col("n"))).collect()] == ["grand ap", "", ""]
    inc = spark.createDataFrame([("a b", "xab"), ("", "a"), (None, "a"), ("q", "z")], "a string, b string")
    assert [r[0] for r in inc.select(text.included(F.col("a"), F.col("b"))).collect()] == [True, False, False, False]
    room = spark.createDataFrame([("25 m², Garden view/City view, TV",), (None,)], "f string").select(text.room_size(F.col("f")).alias("s"), text.room_views(F.col("f")).alias("v")).collect()
    assert (room[0]["s"], room[0]["v"], room[1]["s"]) == (25.0, ["Garden", "City"], 0.0)


def test_token_swap_ratio_of_long_names_equals_all_choices():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(9)]
    assert text.swap_ratio_of("alpha beta", "alpha beta " + " ".join(f"x{i}" for i in range(9))) == 1.0
    for _ in range(60):
        a, b = (" ".join(rng.choice(words) for _ in range(n)) for n in (rng.randint(1, 4), rng.randint(7, 12)))
        x, y, least = sorted(a.split()), sorted(b.split()), rng.choice([0, 0.4, 0.6])
        best = max(text.ratio_of(" ".join(x), " ".join(c)) for n in {len(x) - 1 or 1, len(x), len(x) + 1} for c in itertools.combinations(y, n))
        got = text.swap_ratio_of(a, b, least)
        assert got == best if best > least else got <= least


def test_coordinates(spark):
    df = spark.createDataFrame([(123456.0,), (1234567.0,), (12345678.0,), (12.5,), (12.0,), (None,)], "c double")
    assert [r[0] for r in df.select(geo.repair_scaled(F.col("c"))).collect()] == [12.3456, 12.34567, 12.345678, 12.5, None, None]


def test_assignment_is_greedy_and_one_to_one(spark):
    random.seed(3)
    edges = [(a, b, round(random.random(), 1)) for a in range(30) for b in range(30) if random.random() < 0.3]
    want, sa, sb = set(), set(), set()
    for a, b, s in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        if a not in sa and b not in sb:
            want.add((a, b))
            sa.add(a)
            sb.add(b)
    df = spark.createDataFrame(edges + [(99, 99, None)], "src_id int, tgt_id int, score double")
    assert {(r["src_id"], r["tgt_id"]) for r in matching.assign(df).collect()} == want
    assert matching.assign(df.limit(0)).count() == 0


def test_hamming_join_equals_matrix(spark):
    random.seed(5)
    codes = [(i, random.getrandbits(63)) for i in range(60)]
    codes += [(100 + i, c ^ (1 << random.randrange(63))) for i, c in codes[:30]] + [(300, codes[0][1])]
    df = spark.createDataFrame(codes, "id long, code long")
    want = {(a, b) for (a, x), (b, y) in itertools.combinations(sorted(codes), 2) if (x ^ y).bit_count() <= 6}
    got = [(r["a_id"], r["b_id"]) for r in search.hamming_self_join(df, 6, 63).collect()]
    assert set(got) == want and len(got) == len(want)


def test_fusion_by_hand(spark):
    lists = spark.createDataFrame([(1, "x", 1, 1.0), (1, "x", 2, 1.2), (1, "x", 3, 3.0), (1, "y", 2, 0.5), (1, "y", 4, 0.9)], "qid int, list_id string, id int, dist double")
    assert [(r["id"], round(r["score"], 6)) for r in fusion.ensembling(lists).orderBy("rank").collect()] == [(2, 1.7), (1, 2.35), (3, 4.35), (4, 5.4)]
    assert [(r["id"], r["score"]) for r in fusion.blending(lists, max_len=2).orderBy("rank").collect()] == [(2, 0.5), (4, 0.9)]


def test_scores(spark):
    got = spark.createDataFrame([([1.0, 2.0, 4.0], 4), ([3.0], 1), ([], 3)], "v array<double>, k int").select(scoring.interpolate(F.col("v"), F.col("k")).alias("x")).collect()
    assert got[0]["x"] == [1.0, 2.0, 4.0, 4.0] and got[1]["x"] == [3.0] and got[2]["x"] == []
    rooms = spark.createDataFrame([("King Suite",), ("Family Suite",), ("Bed",), (None,)], "n string").select(scoring.room_types(F.col("n")).alias("t")).collect()
    assert [r["t"] for r in rooms] == [["Concierge/Executive Suite"], ["Family Room", "Junior Suite/Mini Suite"], ["Standard"], ["Standard"]]
    m = scoring.modes(spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (1, "a"), (1, "b")], "g int, v string"), "g", "v")
    assert {r["v"] for r in m.collect()} == {"a", "b"}


def test_vectors(spark):
    r = spark.createDataFrame([([3.0, 0.0, -4.0],)], "v array<double>").select(V.norm(F.col("v")).alias("n"), V.normalized(F.col("v")).alias("u"), V.cumulated(F.col("v")).alias("c"), V.polynomial2(F.col("v")).alias("p"), V.sparse(F.col("v")).alias("s"), V.clipped_histogram(F.col("v"), 0, 2, 2).alias("h"), V.median_of(F.col("v")).alias("m")).first()
    assert (r["n"], r["u"], r["c"], r["s"], r["h"], r["m"]) == (5.0, [0.6, 0.0, -0.8], [3.0, 3.0, -1.0], {0: 3.0, 2: -4.0}, [2, 1], 0.0)
    assert r["p"] == pytest.approx([9, 0, -12 * 2**0.5, 0, 0, 16])


def test_image_hashes(spark):
    df = spark.createDataFrame([(list(range(64)),), ([7] * 64,), (None,)], "p array<int>")
    got = df.select(images.average_hash(F.col("p")).alias("a"), images.otsu_hash(F.col("p"), F.col("p")).alias("o")).collect()
    assert got[0]["a"] == -(2**32) and got[1]["a"] == -1 and got[2]["a"] is None and got[2]["o"] is None


def test_sources_round_trip(spark, tmp_path):
    (tmp_path / "a.fvecs").write_bytes(io.encode_vectors([[1, 2], [3, 4, 5]]))
    assert [r["vec"] for r in io.read_vectors(spark, str(tmp_path / "a.fvecs")).orderBy("pos").collect()] == [[1, 2], [3, 4, 5]]
    (tmp_path / "m.json").write_text('// head\n{"a": 1,\n "b": 2,\n}')
    assert {tuple(r) for r in io.read_matches(spark, str(tmp_path / "m.json")).collect()} == {("a", 1), ("b", 2)}
    (tmp_path / "ids.txt").write_text("1\nx\n 2 \n")
    assert [r["id"] for r in io.read_ids(spark, str(tmp_path / "ids.txt")).collect()] == [1, 2]
    (tmp_path / "p.xml").write_text('<all><property property_id="1" latitude="90" longitude="2" property_name="A"/><property property_id="2" longitude="2" property_name="B"/></all>')
    assert [tuple(r) for r in io.read_property_xml(spark, str(tmp_path / "p.xml")).collect()] == [("1", -90.0, 2.0, "A")]


def test_stream_counts_equal_batch(spark, tmp_path):
    from quoin.streaming.windows import windowed_counts

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    events.write.parquet(str(tmp_path / "in"))
    q = windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counts").groupBy().sum("n").first()[0] == events.count()
    batch = {(r["start"], r["event_type"], r["n"]) for r in windowed_counts(events).collect()}
    assert {(r["start"], r["event_type"], r["n"]) for r in spark.table("counts").collect()} == batch


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_cell_neighbours_equal_all_pairs(spark, sf):
    d = f"/root/testdata/{sf}"
    e = catalog._emb(spark, d)
    want = {(r["qid"], r["id"]) for r in search.knn(e, e.where("id % 20 = 0"), 5, "l2sq", exclude_self=True).collect()}
    got = {(r["qid"], r["id"]) for r in catalog.cell_neighbours(spark, d).collect()}
    assert len(want) >= 100 and got == want  # recall 1


def test_cell_neighbours_of_clusters_and_few_rows(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((30, 16)) * 4
    rows = [(i, [float(x) for x in centres[i % 30] + 0.3 * rng.standard_normal(16)]) for i in range(400)] + [(900, None), (901, [50.0] * 16)]
    for part in (rows, rows[:3]):
        df = spark.createDataFrame(part, "id long, vec array<double>")
        got = {(r["qid"], r["id"], r["rank"]) for r in cluster.cell_neighbours(df, df, 5).collect()}
        assert got == {(r["qid"], r["id"], r["rank"]) for r in search.knn(df, df, 5, "l2sq", exclude_self=True).collect()}


def test_vote_blocks_equal_the_join_and_cover_all_documents(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, [rng.choice("abcdefgh") + str(int(rng.paretovariate(0.7)) % 30) for _ in range(rng.randint(0, 9))]) for i in range(300)] + [(7, ["a1", "z"]), (400, None), (401, ["only"])]
    df = spark.createDataFrame(rows, "id long, codes array<string>")
    flat = df.select("id", F.explode("codes").alias("code"))
    want = {(r["qid"], r["id"], round(r["score"], 9), r["rank"]) for r in search.vote_join(flat, flat.where("id % 3 = 0").withColumnRenamed("id", "qid")).collect()}
    for items, block in ((8192, 2048), (40, 25), (3, 7)):
        monkeypatch.setattr(search, "ITEMS", items)
        monkeypatch.setattr(search, "BLOCK", block)
        got = search.vote_blocks(df, df.where("id % 3 = 0").withColumnRenamed("id", "qid"))
        assert {(r["qid"], r["id"], round(r["score"], 9), r["rank"]) for r in got.collect()} == want
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id % 20 = 0 AND text rlike '[a-z]'")
    asked = {r["qid"] for r in catalog.QUERIES["lsh_vote_all"](spark, "/root/testdata/sf0.001").collect()}
    assert {r["doc_id"] for r in docs.collect()} <= asked and docs.where("lang <> 'en' OR lang IS NULL").count()


def test_a_position_of_very_many_rows_is_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(regions, "PART_ROWS", 7)
    rows = [(i, f"g{i % 3}", 10.0, 20.0) for i in range(40)] + [(100, "g0", 10.001, 20.0), (101, None, 10.0, 20.0), (102, "g1", 11.0, 20.0)]
    got = {tuple(r) for r in regions.pairs_within(spark.createDataFrame(rows, "k long, g string, lat double, lng double"), "k", "g", 0.25).collect()}
    want = {(x[0], y[0]) for x in rows for y in rows if x[0] < y[0] and x[1] != y[1] and abs(x[2] - y[2]) < 0.002}
    assert got == want


def test_points_in_polygons_equal_ray_casting(spark):
    rng = random.Random(3)
    rings = {i: [(rng.uniform(-0.2, 0.2) + 0.1 * i, rng.uniform(-0.2, 0.2)) for _ in range(rng.randint(3, 9))] for i in range(6)}
    pts = [(i, rng.uniform(-0.25, 0.25), rng.uniform(-0.3, 0.8)) for i in range(400)]

    def inside(y, x, ring):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
        return odd

    df = spark.createDataFrame([(k, [{"lng": x, "lat": y} for x, y in r]) for k, r in rings.items()], "rid int, ring array<struct<lng:double,lat:double>>")
    got = {tuple(r) for r in regions.points_in_regions(spark.createDataFrame(pts, "pid int, lat double, lng double"), df).collect()}
    assert got == {(i, k) for i, y, x in pts for k, r in rings.items() if inside(y, x, r)}
