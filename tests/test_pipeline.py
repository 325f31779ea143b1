import colorsys
import glob
import os
import random
import struct

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quoin.functions import text
from quoin.functions import vectors as V
from quoin.operators import fusion, images, matching, records, rooms, search
from quoin.plans import models, pipeline
from quoin.sources import io

SF = "/root/testdata/sf0.001"


def rows(pdf):
    def plain(v):
        return "nan" if v is pd.NA or v != v else repr(round(float(v), 5) + 0.0) if isinstance(v, (int, float, np.number)) else str(v)

    return sorted(tuple(plain(v) for v in r) for r in pdf[sorted(pdf.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(pipeline.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    got, want = pipeline.QUERIES[name](spark, SF).toPandas(), con.execute(pipeline.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("most,index", [(3, True), (3, False), (9, True), (20, None), (64, None)])
def test_hamming_join_equals_brute_force(spark, most, index):
    rng = random.Random(most)
    base = [rng.getrandbits(64) for _ in range(30)]
    codes = base + [c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 12))) for c in base] + [0, (1 << 64) - 1, base[0]]
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([*enumerate(signed), (999, None)], "id long, code long")
    want = {(i, j, (x ^ y).bit_count()) for i, x in enumerate(codes) for j, y in enumerate(codes) if (x ^ y).bit_count() <= most}
    assert {tuple(r) for r in search.hamming_join(df, df, most, index=index).collect()} == want
    assert sorted(tuple(r) for r in search.hamming_self_join(df, most).collect()) == sorted(x for x in want if x[0] < x[1])


def test_knn_in_blocks_and_by_key(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 7)
    monkeypatch.setattr(search, "ITEMS", 11)
    rng = np.random.default_rng(1)
    v = rng.integers(0, 3, (60, 2)).astype(float)
    df = spark.createDataFrame([(i, "ab"[i % 2], x.tolist()) for i, x in enumerate(v)] + [(100, "a", None), (101, None, [0.0, 0.0])], "id long, key string, vec array<double>")
    for key in (None, "key"):
        got = {(r["qid"], r["rank"]): r["id"] for r in search.knn(df.where("id < 100"), df.where("id % 5 = 0 AND id < 100"), 4, exclude_self=True, key=key).collect()}
        for q in range(0, 60, 5):
            best = sorted((((v[q] - v[i]) ** 2).sum(), i) for i in range(60) if i != q and (key is None or i % 2 == q % 2))[:4]
            assert [got[q, r + 1] for r in range(4)] == [i for _, i in best]
    assert search.knn(df.limit(0), df, 3).count() == 0 and search.knn(df, df.limit(0), 3, key="key").count() == 0


def test_colours(spark):
    px = [(255, 0, 0), (0, 255, 0), (0, 0, 255), (0, 0, 0), (255, 255, 255), (12, 200, 77), (200, 30, 180), (90, 90, 91)]
    df = spark.createDataFrame([(1, [{"r": r, "g": g, "b": b} for r, g, b in px]), (2, []), (3, None)], "id long, p array<struct<r:int,g:int,b:int>>")
    one = df.where("id = 1").select(F.explode("p").alias("x"))
    got = [tuple(r) for r in one.select(*images.hls(F.col("x"))).collect()]
    assert all(abs(a - b * 255) <= 1 for g, p in zip(got, px) for a, b in zip(g, colorsys.rgb_to_hls(*(c / 255 for c in p))))
    y = [r[0] for r in one.select(*images.yuv(F.col("x"))).collect()]
    assert all(abs(a - (0.299 * r + 0.587 * g + 0.114 * b)) <= 1 for a, (r, g, b) in zip(y, px))
    for bin_of in (images.rgb_bin, images.yuv_bin, images.hls_bin):
        share = images.binned(df, "id", "p", bin_of).collect()
        assert {r["id"] for r in share} == {1} and abs(sum(r["share"] for r in share) - 1) < 1e-9 and all(0 <= r["bin"] < 512 for r in share)


def test_hashes_and_gradients(spark):
    small = [10] * 32 + [200] * 32
    ring = [255 if 2 <= i // 8 <= 5 and 2 <= i % 8 <= 5 else 0 for i in range(64)]
    df = spark.createDataFrame([(1, small, small * 4), (2, ring, ring), (3, [255 - x for x in ring], [255 - x for x in ring]), (4, None, small), (5, small, []), (6, [7] * 64, [7])], "id int, s array<int>, w array<int>")
    got = {r["id"]: (r["a"], r["b"]) for r in df.select("id", images.otsu_hash("s", "w").alias("a"), images.otsu_hash_centred("s", "w").alias("b")).collect()}
    bits = lambda x: [(x >> i) & 1 for i in range(64)]
    assert bits(got[1][0]) == [0] * 32 + [1] * 32 and got[4] == (None, None) and got[5] == (None, None) and got[6][0] is not None
    assert got[2][1] == got[3][1] and bits(got[2][1]) == [int(x == 255) for x in ring]
    # Light in the whole image that isn't in its small form moves the threshold.
    both = spark.createDataFrame([([0] * 32 + [60] * 32, [0] * 50 + [60] * 50 + [250] * 100)], "s array<int>, w array<int>").select(images.otsu_hash("s", "w")).first()[0]
    assert both == 0
    up = np.tile(np.arange(36) * 7.0, (36, 1))
    h = images.gradient_histograms(up)
    assert len(h) == 8 * 8 * 4 * 9 and h.reshape(-1, 9)[:, 0].sum() > 0.99 * h.sum() and images.gradient_histograms(np.zeros((3, 3))).size == 0
    d = spark.createDataFrame([(1, up.ravel().tolist(), 36), (2, [1.0, 2.0], 3), (3, None, 2)], "id int, g array<double>, w int")
    assert {r["id"]: r["n"] for r in d.select("id", F.size(images.hog("g", "w")).alias("n")).collect()} == {1: len(h), 2: None, 3: None}


def test_more_vectors(spark):
    df = spark.createDataFrame([([3.0, 1.0, 2.0, 1.0], [0.5, -1.0, 2.0, 0.0])], "a array<double>, b array<double>")
    a, b = F.col("a"), F.col("b")
    r = df.select(V.sorting_index(a).alias("s"), V.ranks(a).alias("r"), V.permuted(a, V.sorting_index(a)).alias("p"), V.differences(a).alias("d"), V.product(a).alias("x"), V.quantile_of(a, 0.5).alias("q"), V.dot(V.polynomial3(a), V.polynomial3(b)).alias("c"), V.dot(a, b).alias("dot"), V.seeded(F.lit(5), 3, 1).alias("u"), V.seeded(F.lit(5), 3, 1).alias("u2")).first()
    assert (r["s"], r["r"], r["p"], r["d"], r["x"], r["q"]) == ([1, 3, 2, 0], [3, 0, 2, 1], [1.0, 1.0, 2.0, 3.0], [-2.0, 1.0, -1.0], 6.0, 1.5)
    assert abs(r["c"] - r["dot"] ** 3) < 1e-9 and r["u"] == r["u2"] and all(0 <= x < 1 for x in r["u"])


def test_sinks_and_sources(spark, tmp_path):
    p = str(tmp_path)
    df = spark.createDataFrame([("é", 1, 0.5), ("b", 2, None)], "name string, id int, score double")
    io.write_json(df, f"{p}/j")
    assert sorted(tuple(r) for r in spark.read.schema(df.schema).json(f"{p}/j").collect()) == [("b", 2, None), ("é", 1, 0.5)]
    io.write_split(df, "score", f"{p}/s")
    assert spark.read.option("header", True).csv(f"{p}/s/with").count() == 1 and spark.read.option("header", True).csv(f"{p}/s/without").columns == ["name", "id"]
    io.write_report(df, f"{p}/r")
    assert {r[0] for r in spark.read.text(f"{p}/r").collect()} == {"name: é | id: 1 | score: 0.5", "name: b | id: 2 | score: none"}
    v = spark.createDataFrame([("/a/1.jpg", [1.0, 2.5], "00010203"), ("/a/2.jpg", [3.0], "0001")], "path string, vec array<double>, code string")
    io.write_features(v, f"{p}/f")
    (tmp_path / "f" / "bad.txt").write_text("no tab\n/x\t1,x\n\t1\n/y\t1\t2\n")
    assert {(r["path"], tuple(r["vec"])) for r in io.read_features(spark, f"{p}/f").collect()} == {("/a/1.jpg", (1.0, 2.5)), ("/a/2.jpg", (3.0,))}
    io.write_features(v, f"{p}/g", "code")
    assert io.read_features(spark, f"{p}/g").count() == 1
    io.write_vectors(v.repartition(2), f"{p}/v")
    assert sorted(tuple(r["vec"]) for r in io.read_vectors(spark, f"{p}/v").collect()) == [(1.0, 2.5), (3.0,)]
    (tmp_path / "d.siftgeo").write_bytes(struct.pack("<9fi", *range(9), 3) + bytes([1, 2, 255]) + struct.pack("<9fi", *[0.5] * 9, 1) + b"\x07")
    got = io.read_siftgeo(spark, f"{p}/d.siftgeo").orderBy("pos").collect()
    assert [r["vec"] for r in got] == [[1.0, 2.0, 255.0], [7.0]] and got[0]["meta"] == list(map(float, range(9)))
    (tmp_path / "t.txt").write_text("1 2 3\n\n4 x\n")
    assert [r["vec"] for r in io.read_text_vectors(spark, f"{p}/t.txt").collect()] == [[1.0, 2.0, 3.0], [4.0, None]]
    os.makedirs(f"{p}/i/deep")
    for n in ("a.JPG", "deep/b.png", "c.txt"):
        (tmp_path / "i" / n).write_bytes(b"x")
    assert sorted(os.path.basename(r["path"]) for r in io.list_images(spark, f"{p}/i").collect()) == ["a.JPG", "b.png"]
    index = spark.createDataFrame([(i % 9, i) for i in range(50)], "key int, id int")
    io.save_index(index, f"{p}/x")
    assert io.load_index(spark, f"{p}/x").count() == 50 and {r["id"] for r in io.load_index(spark, f"{p}/x", wanted=[4]).collect()} == {i for i in range(50) if i % 9 == 4}


def test_fusion_and_rooms_of_odd_rows(spark):
    q = spark.createDataFrame([("k", 1, 0, [1.0, 0.0], "Studio"), (None, 2, 0, [1.0, 0.0], None), ("k", 3, None, None, "Deluxe King Room")], "key string, id long, code long, vec array<double>, room string")
    t = spark.createDataFrame([("k", 10, 1, [1.0, 0.1], "Deluxe Studio"), ("k", 11, -1, [0.0, 1.0], None), ("z", 12, 0, [1.0, 0.0], "Studio")], q.schema)
    assert {(r["qid"], r["id"], r["how"]) for r in rooms.similar_photos(q, t).collect()} == {(1, 10, "duplicate")}
    assert {tuple(r) for r in rooms.transfer_types(rooms.nearest_duplicates(q, t), q, t).collect()} == {(1, "Studio", 1), (1, "Deluxe Room", 1)}
    assert rooms.similar_photos(q.limit(0), t).count() == 0 and rooms.nearest_duplicates(q, t.limit(0)).count() == 0
    lists = spark.createDataFrame([(1, "rgb", 7, 0.2), (1, "bow", 7, 0.9), (1, "bow", 8, 0.3)], "qid long, list_id string, id long, dist double")
    assert [r["id"] for r in fusion.similar(lists).orderBy("rank").collect()] == [7, 8]
    mixed = fusion.global_local(lists.where("list_id = 'rgb'"), lists.where("list_id = 'bow'"))
    assert [r["id"] for r in mixed.orderBy("rank").collect()][0] == 7


def test_linkage_em_finds_planted_parameters(spark):
    rng = random.Random(6)
    rows = []
    for i in range(4000):
        match = rng.random() < 0.2
        rows.append((i, match, *(int(rng.random() < (0.9 if match else p)) for p in (0.05, 0.1, 0.2)), None))
    df = spark.createDataFrame(rows, "id int, match boolean, a int, b int, c int, d int")
    found, scored = models.linkage_em(df, ["a", "b", "c", "d"])
    assert abs(found["share"] - 0.2) < 0.03 and abs(found["m"]["a"] - 0.9) < 0.05 and abs(found["u"]["c"] - 0.2) < 0.03
    assert scored.where("(match_p > 0.5) = match").count() > 0.95 * 4000
    assert models.linkage_em(df.limit(0), ["a"])[1].count() == 0


def test_models(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(float(x), rng.random(), float(x > 5)) for x in (rng.randrange(11) for _ in range(300))], "a double, b double, y double")
    share = models.forest_importances(df, ["a", "b"], "y")
    assert share["a"] > 0.8 and abs(sum(share.values()) - 1) < 1e-6
    texts = [("clean room and bed", [1, 0, 1]), ("noisy street at night", [0, 0, 1])] * 20 + [(None, [1, 1, 1]), ("x", None)]
    got = models.tag_models(spark.createDataFrame(texts, "text string, tags array<int>"), 3)
    assert set(got) == {0}
    assert {r["tag_0"] for r in got[0].transform(spark.createDataFrame([("a clean bed",)], "text string")).collect()} == {1.0}


def test_matching_helpers(spark):
    df = spark.createDataFrame([(1, 10, 50.0, 0.5, "Priora Inns", "Inns Priora"), (1, 11, 100.0, 1.0, None, "x"), (2, 12, 0.0, 0.4, "a", None)], "src_id int, tgt_id int, dist_m double, name_sim double, chain_a string, chain_b string")
    assert [round(r["geoname_sim"], 6) for r in matching.geoname(df).orderBy("tgt_id").collect()] == [0.125, 0.25, 0.16]
    sims = {r["tgt_id"]: (r["chain_sim"], r["chain_sim_sw"]) for r in matching.chain_similarity(df).collect()}
    assert sims[10][1] == 1.0 and sims[11] == (0.0, 0.0) and {r["chain_sim"] for r in matching.chain_similarity(df, False).collect()} == {0.0}
    ranked = matching.ranked_candidates(df.withColumn("score", F.col("name_sim")), spark.createDataFrame([(2,)], "src_id int"), 0.4)
    assert [(r["src_id"], r["tgt_id"], r["rank"]) for r in ranked.orderBy("rank").collect()] == [(1, 11, 1), (1, 10, 2)]
    grid = fusion.grid(spark.createDataFrame([(1, "p", 7, 0.2), (2, "p", 8, 0.6)], "qid int, list_id string, id int, dist double"), spark.createDataFrame([(1, 7), (3, 9)], "qid int, id int"), [{}, {"p": 2.0}], [0.3, 0.7])
    assert {(r["setting"], r["threshold"], r["tp"], r["fp"], r["fn"]) for r in grid.collect()} == {(0, 0.3, 1, 0, 1), (0, 0.7, 1, 1, 1), (1, 0.3, 0, 0, 2), (1, 0.7, 1, 0, 1)}


@pytest.mark.parametrize("swap", [False, True])
def test_shared_letters_never_rule_out_a_pair(spark, swap):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdeéł ", k=rng.randint(0, 9))).strip()
    pairs = [(i, f"{word()} {word()}".strip(), f"{word()} {word()}".strip()) for i in range(300)]
    df = spark.createDataFrame(pairs, "id int, a string, b string")
    got = {r["id"]: r["score"] for r in matching.compared(df, 0.6, swap).collect()}
    of = text.swap_ratio_of if swap else text.ratio_of
    assert {i: round(of(a, b), 9) for i, a, b in pairs if of(a, b) > 0.6} == {i: round(x, 9) for i, x in got.items()}


def test_cascade_equals_pass_by_pass_greedy(spark, monkeypatch):
    monkeypatch.setattr(matching, "LAST_EDGES", 5)  # rounds first, then one by one
    rng = random.Random(8)
    words = ["lumo", "verano", "talstad", "brook", "kesridge", "north", "solvia"]
    place = lambda i: [(47 + rng.random() / 20, 9 + rng.random() / 20), (89.99 + rng.random() / 100, rng.uniform(-180, 180)), (rng.random() / 20, 179.98 + rng.random() / 50), (rng.random() / 20, -180 + rng.random() / 50)][i % 4]
    rows = lambda n: [(i, *place(i), " ".join(rng.sample(words, rng.randint(1, 4)))) for i in range(n)]
    a, b = rows(60), rows(70)
    src, tgt = (spark.createDataFrame(x, f"{c}_id long, lat double, lng double, name string") for x, c in ((a, "src"), (b, "tgt")))
    near = {(r["src_id"], r["tgt_id"]): r["dist_m"] for r in matching.radius_join(src, tgt, 6).collect()}
    assert {(r["src_id"], r["tgt_id"]) for r in matching._near(src.drop("name"), tgt.drop("name"), 6, []).collect()} == set(near)
    used, free, want = set(), set(), set()
    names = {c: {r["i"]: (r["x"], r["y"]) for r in df.select(F.col(f"{c}_id").alias("i"), text.normalize(F.col("name")).alias("x"), text.normalize(F.col("name"), stopwords=False).alias("y")).collect()} for df, c in ((src, "src"), (tgt, "tgt"))}
    for step, (km, least, only, swap) in enumerate(matching.CASCADE):
        of = text.swap_ratio_of if swap else text.ratio_of
        left = [(-of(names["src"][x][swap], names["tgt"][y][swap]), x, y) for (x, y), d in near.items() if d <= km * 1000 and x not in used and y not in free]
        left = sorted(e for e in left if -e[0] > least)
        left = [e for e in left if sum(o[1] == e[1] for o in left) == 1] if only else left
        for s, x, y in left:
            if x not in used and y not in free:
                used.add(x)
                free.add(y)
                want.add((x, y, round(-s, 9), step))
    assert want and {(r["src_id"], r["tgt_id"], round(r["score"], 9), r["step"]) for r in matching.cascade(src, tgt).collect()} == want


def test_names_are_compared_once(spark, tmp_path, monkeypatch):
    def noted(a, b, least=0.0):
        with open(seen, "a") as f:
            f.write("x")
        return 1.0

    seen = str(tmp_path / "seen")
    monkeypatch.setattr(text, "ratio_above", noted)
    pairs = spark.createDataFrame([(i, "lumo north", "north lumo") for i in range(20)], "id int, a string, b string")
    assert matching.compared(pairs, 0.1).count() == 20
    assert len(open(seen).read()) == 1


def test_classifier_compares_its_candidates_once(spark, tmp_path, monkeypatch):
    def noted(a, b, least=0.0):
        with open(seen, "a") as f:
            f.write(f"{a}|{b}\n")
        return 1.0 if a == b else 0.5

    seen = str(tmp_path / "seen")
    monkeypatch.setattr(text, "swap_ratio_of", noted)
    rows = [(i, f"lumo north {i % 4}{i // 4}x", 47 + (i % 4) / 1000, 9.0, None) for i in range(12)]
    hotels = spark.createDataFrame(rows, "bkg_id long, name string, lat double, lng double, chain string")
    hotels.withColumns({"rec_id": F.col("bkg_id"), "leo_id": F.col("bkg_id")}).drop("bkg_id").write.parquet(str(tmp_path / "leoh.parquet"))
    hotels.write.parquet(str(tmp_path / "bkgh.parquet"))
    spark.createDataFrame([(i, j, int(i == j)) for i in range(6) for j in range(6)], "leo_id long, bkg_id long, label int").write.parquet(str(tmp_path / "labelled_pairs.parquet"))
    assert models.classified_matches(spark, str(tmp_path)).count() > 0
    calls = open(seen).read().split("\n")[:-1]
    assert calls and len(calls) == len(set(calls))
