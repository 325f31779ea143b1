import random
import time

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quoin import session
from quoin.llm import encoding_repair, entity_match, mixing, name_variants, names, nn_descent, sentences, tokenizing

SF = "/root/testdata/sf0.001"


# --- 1 ----------------------------------------------------------------------------------------------------------------
CLEAN = ["Das Frühstück war außergewöhnlich gut", "La señora nos preparó un café", "Отличное расположение до центра города", "服务态度很好", "Łóżko wygodne było czysto", "Parking costs €20 – sadly", "ATENÇÃO À LOCALIZAÇÃO"] * 40
DAMAGED = [CLEAN[0].encode().decode("cp1252"), CLEAN[1].encode().decode("mac_roman"), CLEAN[2].encode("koi8-r").decode("cp1252"), CLEAN[3].encode("gb18030").decode("latin-1"), CLEAN[4].encode("cp1250").decode("cp1252"), "Das Fr�hst�ck", CLEAN[1].encode().decode("latin-1").encode().decode("latin-1")]


def test_damaged_texts_are_found_and_restored(spark):
    rows = [(i, t) for i, t in enumerate(CLEAN)] + [(1000 + i, t) for i, t in enumerate(DAMAGED)] + [(2000, None), (2001, ""), (2002, "plain"), (2003, "café 😀 ½")]
    df = spark.createDataFrame(rows, "k long, text string")
    keys, model = encoding_repair.find_damaged(df, ["k"])
    assert sorted(r["k"] for r in keys.collect()) == [1000 + i for i in range(len(DAMAGED))]
    fixed = {r["k"]: r["restored"] for r in encoding_repair.restore_texts(df, model).collect()}
    assert [fixed[1000 + i] for i in (0, 1, 2, 3, 4, 6)] == [CLEAN[i] for i in (0, 1, 2, 3, 4, 1)]
    assert fixed[1005] == "Das Frühstück" and fixed[2000] is None and fixed[2002] == "plain" and fixed[0] == CLEAN[0]


def test_no_texts_no_damage(spark):
    keys, _ = encoding_repair.find_damaged(spark.createDataFrame([], "k long, text string"), ["k"])
    assert keys.count() == 0


# --- 3 and 5 ----------------------------------------------------------------------------------------------------------
SOURCE = "rec_id long, leo_id string, lat double, lng double, name string, chain string"
TARGET = "bkg_id long, lat double, lng double, name string, chain string, city_id long"


def _towns(spark):
    return spark.createDataFrame([(1, "Wälkirch"), (2, None)], "city_id long, city_name string")


def test_places_are_matched(spark):
    src = spark.createDataFrame([
        (1, "a", 10.0001, 20.0001, "Hotel Schönbrück", None), (2, "b", 10.0001, 20.0002, "Schoenbruck Htl., Wälkirch", None), (3, "c", 10.0003, 20.0, "Pension Rauhtal", "x"), (4, "d", None, None, "", None),
        (5, "e", 100001.0, 200001.0 * 10, "Gasthof Eismoos", None), (6, "f", float("nan"), 1.0, "Gasthof Unbekannt", None), (7, None, 10.0, 20.0, "Hotel Schönbrück", None), (8, "a", 10.0001, 20.0001, "Hotel Schönbruck", ""),
    ], SOURCE)
    tgt = spark.createDataFrame([(100, 10.0, 20.0, "Hotel Schönbrück", None, 1), (101, 10.0004, 20.0001, "Rauhtal Pens.", None, None), (102, 1.00001, 20.00011, "Gasthof Eismoos", "-", 2), (103, None, None, None, None, None)], TARGET)
    labels = spark.createDataFrame([("a", 100, 1), ("c", 100, 0), ("zz", 1, None)], "leo_id string, bkg_id long, label int")
    found = entity_match.match(src, tgt, _towns(spark), labels).where("confidence >= 0.5")
    assert {(r["leo_id"], r["bkg_id"]) for r in found.collect()} == {("a", 100), ("b", 100), ("c", 101), ("e", 102)}
    assert entity_match.match(src.limit(0), tgt, _towns(spark), labels).count() == 0


def test_places_without_a_position_are_matched_anywhere(spark):
    src = spark.createDataFrame([(1, "a", 0.0, 0.0, "Suites Harterham", "x"), (2, "b", 10.0, 20.0, "Apartments Oakingford", None), (3, "c", None, None, "Oakamere Manor", "y"), (4, "d", 50.0123, 7.0123, "Gasthof Eismoos", None), (7, "g", None, None, "Zephstad Sol Rauhtal Convention Center", None), (8, "h", None, None, "Hotel Zwiebach", None), (9, "i", None, None, "The Inn", None)], SOURCE)
    tgt = spark.createDataFrame([(100, 30.0123, 40.0123, "Harterham Suites", "x", None), (101, None, None, "Apartments, Oakingford", None, 1), (102, 31.0123, 41.0123, "Oakamere Maner", "y", 1), (103, 51.0123, 7.0123, "Gasthof Eismoos", None, None), (104, 32.0123, 3.0123, "Zephstad Sol Wälkirch Convention Center", None, 1), (105, 1.0123, 3.0123, "Hotel Zwiebach", None, None), (106, 61.0123, 3.0123, "Hotel Zwiebach", None, None), (107, 61.0123, 3.0123, "The Inn", None, None)], TARGET)
    labels = spark.createDataFrame([], "leo_id string, bkg_id long, label int")
    found = entity_match.match(src, tgt, _towns(spark), labels).where("confidence >= 0.5")
    assert {(r["leo_id"], r["bkg_id"]) for r in found.collect()} == {("a", 100), ("b", 101), ("c", 102)}
    more = src.unionByName(spark.createDataFrame([(5, "e", 30.0123, 40.0123, "Harterham Suites", "x"), (6, "f", 31.0123, 41.0123, "Suites Rauhtal", "x")], SOURCE))
    assert {tuple(r) for r in name_variants.link_places(more, _towns(spark)).collect()} == {("a", "e")}


def test_a_position_of_many_rows_of_one_place_is_no_placeholder(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    typed = lambda w: w[: (i := rng.randrange(len(w)))] + rng.choice("aeioulnrst") + w[i + 1 :]
    one = [(10.0121, 20.0121, f"Hotel {typed('Schonbruckental')} {typed('Rauhenstein')}") for _ in range(300)]
    many = [(30.0121, 40.0121, f"Hotel {word()} {word()}") for _ in range(120)] + [(None, 1.0, "x"), (10.0121, 20.0121, None)]
    marked = entity_match.mark_placeholders(spark.createDataFrame(one + many, "lat double, lng double, name string")).groupBy("lat", "crowded").count().collect()
    assert {(r["lat"], r["crowded"]): r["count"] for r in marked} == {(10.0121, False): 301, (30.0121, True): 120, (None, False): 1}
    spelled = [(i, f"l{i}", 10.0121, 20.0121, "Hotel Schönbrück Rauhtal", None) for i in range(60)] + [(90, "v", 10.0121, 20.0121, "Hotel Schönbrück", None)]
    found = entity_match.match(spark.createDataFrame(spelled, SOURCE), spark.createDataFrame([(100, 10.0121, 20.0121, "Hotel Schönbrück Eismoos", None, None)], TARGET), _towns(spark), spark.createDataFrame([], "leo_id string, bkg_id long, label int"))
    few = entity_match.match(spark.createDataFrame(spelled[-2:], SOURCE), spark.createDataFrame([(100, 10.0121, 20.0121, "Hotel Schönbrück Eismoos", None, None)], TARGET), _towns(spark), spark.createDataFrame([], "leo_id string, bkg_id long, label int"))
    of = lambda df: {r["confidence"] for r in df.where("leo_id = 'v'").collect()}
    assert of(found) == of(few) and of(few)


def _crowd(lat: float) -> list[tuple]:
    """2,000 spellings of one name and 60 other names at one position: of 500 spellings some 15 were other names."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12))
    typed = lambda w: w[: (i := rng.randrange(len(w)))] + rng.choice("aeioulnrst") + w[i + 1 :]
    one = {f"Hotel {typed('Schonbruckental')} {typed('Rauhensteinerhof')}" for _ in range(2000)}
    return [(lat, 20.0121, x) for x in sorted(one)] + [(lat, 20.0121, f"{word()} {word()}") for _ in range(60)]


def test_all_spellings_of_a_position_count(spark):
    marked = entity_match.mark_placeholders(spark.createDataFrame(_crowd(10.0121) + [r for r in _crowd(11.0121) if "Hotel" in r[2]], "lat double, lng double, name string"))
    assert {(r["lat"], r["crowded"]) for r in marked.select("lat", "crowded").distinct().collect()} == {(10.0121, True), (11.0121, False)}


def test_the_curve_is_fitted_on_all_labels(spark):
    """25,000 labels: 20,000 that a limit in the order of the hash would leave, and 5,000 beyond that move the curve."""
    keys = spark.range(25_000).select(F.concat(F.lit("l"), "id").alias("leo_id"), F.col("id").alias("bkg_id"))
    first = keys.orderBy(F.xxhash64("leo_id", "bkg_id")).limit(20_000).withColumn("first", F.lit(True))
    known = keys.join(first, ["leo_id", "bkg_id"], "left").select(F.when(F.col("first"), 0.75).otherwise(0.6).alias("score"), F.lit(1).alias("label"))
    s, y = np.array([0.75] * 20_000 + [0.6] * 5_000), np.ones(25_000)
    best = lambda s, y: max(((float(np.log(0.05 + 0.9 / (1 + np.exp(-a * (s - m)))).sum()) - ((m - 0.64) / 0.015) ** 2 / 2 - ((a - 22.0) / 6) ** 2 / 2, a, m) for a in entity_match.SLOPES for m in entity_match.MIDDLES))[1:]
    assert np.allclose(entity_match.fit_curve(known), best(s, y)) and not np.allclose(best(s, y), best(s[:20_000], y[:20_000]))
    assert entity_match.fit_curve(known.limit(0)) == (22.0, pytest.approx(0.64))


def test_hamming_blocks_lose_no_pair(spark, monkeypatch):
    """Against all pairs: in one area, split over keys, every pair from ``exact_from`` up is found, and none below DICE."""
    monkeypatch.setattr(entity_match, "AREA_ROWS", 40)
    rng = random.Random(1)
    base = [["".join(rng.choices("aeinrst", k=rng.randint(2, 9))) for _ in range(rng.randint(1, 4))] for _ in range(40)]
    typed = lambda w: w[: (i := rng.randrange(len(w)))] + rng.choice("aeinrst") + w[i + rng.randint(0, 1) :]
    spelled = [[typed(w) if rng.random() < 0.4 else w for w in rng.choice(base)] for _ in range(400)]
    code = [entity_match.code_of(x) for x in spelled]
    rows = [("ab"[i % 2], i, c, n, u, ["g1"]) for i, (c, n, u) in enumerate(code)] + [("a", 1000, [0] * entity_match.WORDS, 0, 0, ["g1"]), ("b", 1001, [0] * entity_match.WORDS, 0, 0, None)]
    got = {(r["a"], r["b"]): r["dice"] for r in entity_match.near_codes(spark.createDataFrame(rows, "side string, id long, code array<long>, n int, u int, areas array<string>")).collect()}
    bits = [names.bits(names.qgrams(x), entity_match.CODE_BITS) for x in spelled]
    for i in range(0, 400, 2):
        for j in range(1, 400, 2):
            dice = 2 * (bits[i] & bits[j]).bit_count() / (code[i][1] + code[j][1])
            large = max(code[i], code[j], key=lambda c: c[1])
            if dice >= entity_match.exact_from(large[1], large[2]):
                assert (i, j) in got
            assert ((i, j) not in got) or (dice >= entity_match.DICE and abs(got[i, j] - dice) < 1e-9)


def test_all_pairs_of_an_area_are_compared(spark, monkeypatch):
    """Also those whose codes agree in no block, in areas split on both sides, and area by area in slices."""
    monkeypatch.setattr(entity_match, "AREA_ROWS", 3)
    monkeypatch.setattr(entity_match, "SLICE_ROWS", 10)
    rng = random.Random(4)
    nibble = lambda some: sum(rng.choice(some) << (4 * i) for i in range(entity_match.BLOCKS))
    code = [nibble((7, 14)) if i % 2 else nibble((11, 13)) for i in range(40)] + [0, 0]
    rows = [("ab"[i % 2], i, names.words64(c, entity_match.WORDS), c.bit_count(), 64, [f"g{i % 3}", f"v{i % 2 + i % 3}"] + ["x1"] * (i < 20)) for i, c in enumerate(code)]
    got = [tuple(r) for r in entity_match.near_codes(spark.createDataFrame(rows, "side string, id long, code array<long>, n int, u int, areas array<string>")).collect()]
    want = set()
    for a in rows[:40:2]:
        for b in rows[1:40:2]:
            dice, shared = 2 * (code[a[1]] & code[b[1]]).bit_count() / (a[3] + b[3]), {*a[5]} & {*b[5]}
            far = all(x[0] == "v" for x in shared)
            if shared and dice >= (entity_match.FAR_DICE if far else entity_match.DICE):
                want.add((a[1], b[1], dice, far))
    assert len(got) == len(want) > 100 and {(a, b, round(d, 9), f) for a, b, d, f in got} == {(a, b, round(d, 9), f) for a, b, d, f in want}


def test_slices_leave_no_shuffle_files(spark):
    def shuffled() -> int:
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return sum(f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle"))

    session.release(spark)
    time.sleep(2)
    before = shuffled()
    seen = []

    def make(k: int):
        seen.append(shuffled() - before)
        return spark.range(100_000).select((F.col("id") * 4 + k).alias("id"), F.rand(1).alias("x")).repartition(4, "id")

    def slowly(k: int):
        time.sleep(2)
        return make(k)

    read = session.packed(session.in_slices(spark, 4, slowly).withColumn("s", F.array(F.lit("a"), F.col("id").cast("string"))))
    assert max(seen) < 400_000  # a slice's are about 1.2 MB
    assert sorted(r["id"] for r in read("id").collect()) == list(range(400_000))
    assert read("s", "id").where("s[1] = 7").collect()[0].asDict() == {"s": ["a", "7"], "id": 7}


def test_variants_are_linked(spark):
    df = spark.createDataFrame([
        (1, "a", 10.0121, 20.0, "Hotel Schönbrück", None), (2, "b", 10.0124, 20.0001, "SCHONBRUCK HTL.", None), (3, "c", 10.0124, 20.0, "Pension Schönbrück", None), (4, "d", 40.0, 20.0, "Hotel Schönbrück", None),
        (5, "a", 10.0121, 20.0, "Hotel Schönbrück", None), (6, "e", 10.0121, 20.0, None, None), (7, None, 10.0121, 20.0, "Hotel Schönbrück", None), (8, "f", 10.0121, 20.0003, "Brück Schön Hotel Schönbürck", None),
    ], SOURCE)
    got = {tuple(r) for r in name_variants.link_places(df, _towns(spark)).collect()}
    assert ("a", "b") in got and ("a", "c") not in got and not any("d" in p or "e" in p for p in got)
    assert name_variants.link_places(df.limit(0), _towns(spark)).count() == 0


def test_a_placeholder_is_known_by_all_its_spellings(spark):
    """600 spellings of one name and 56 other names: of 500 spellings fewer than 51 were different names, and the place counted as exact."""
    crowd = _crowd(10.0121)
    crowd = crowd[:600] + crowd[-56:]
    rows = [(i, f"l{i}", *r[:2], r[2], None) for i, r in enumerate(crowd)]
    pair = [(9001, "x", 10.0121, 20.0121, "Hotel Zwiebach Eismoos", None), (9002, "y", 10.0121, 20.0121, "Hotel Zwiebach", None)]
    linked = lambda some: ("x", "y") in {tuple(r) for r in name_variants.link_places(spark.createDataFrame(some, SOURCE), _towns(spark)).where("key_a = 'x' OR key_b = 'x'").collect()}
    assert linked(rows[:600] + pair) and not linked(rows + pair)


def test_chains(spark):
    codes = spark.createDataFrame([("PM", "Priora Gästehäuser"), ("LJ", "Lumolune Boutique Hotels"), ("BY", "Belnova Ever Hotel Group"), ("PP", "Belnova Boutique Hotels"), ("X", None)], "chain_code string, chain_name string")
    typed = ["Priora Gästehäuser", "prioar gastehauser GmbH", "Prior", "LBH", "Belnova", "Belnova Ever", "Schön Familienbetriebe", "independent", "", None, "n/a", "Boutique Hotels", "Proira", "Lumolune, Boutique Htls"]
    df = spark.createDataFrame([(str(i), c, "n") for i, c in enumerate(typed)], "leo_id string, chain string, name string")
    got = {(r["key_a"], r["key_b"]) for r in name_variants.link_chains(df, codes).collect()}
    assert got == {("1", "PM"), ("2", "PM"), ("3", "LJ"), ("4", "PP"), ("5", "BY"), ("12", "PM"), ("13", "LJ")}


def test_segments_find_every_word_within_the_edits():
    random.seed(2)
    for _ in range(2000):
        w = "".join(random.choices("abcd", k=random.randint(4, 14)))
        v = list(w)
        for _ in range(random.randint(0, name_variants.edits(len(w)))):
            op, i = random.choice("sdi"), random.randrange(len(v)) if v else 0
            if op == "s" and v:
                v[i] = random.choice("abcd")
            elif op == "d" and len(v) > 3:
                del v[i]
            else:
                v.insert(i, random.choice("abcd"))
        v = "".join(v)
        k = name_variants.edits(len(w))
        if names.banded_distance(v, w, k) <= k and name_variants.edits(len(v)) >= 0:
            assert name_variants.probe_keys(v) & set(name_variants.index_keys(w)), (v, w)


def test_banded_distance_equals_full():
    def full(a, b):
        d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
        for i in range(len(a)):
            for j in range(len(b)):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
                if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a) - 1, len(b) - 1]

    random.seed(4)
    for _ in range(500):
        a, b = ("".join(random.choices("abc", k=random.randint(1, 8))) for _ in range(2))
        for k in (1, 2, 3):
            assert names.banded_distance(a, b, k) == min(full(a, b), k + 1)


# --- 4 ----------------------------------------------------------------------------------------------------------------
def test_graph_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(40):
        base = rng.standard_normal(96)
        for _ in range(rng.integers(1, 9)):
            rows.append((len(rows), (base + 0.15 * rng.standard_normal(96)) * rng.uniform(0.1, 9)))
    rows += [(len(rows) + i, rows[0][1]) for i in range(3)]
    data = [(i, [float(x) for x in v]) for i, v in rows] + [(900, None), (901, [1.0]), (902, [0.0] * 96), (903, [float("nan")] * 96), (904, [None] * 96)]
    df = spark.createDataFrame(data, "id long, features array<float>").withColumn("a", F.lit(1)).withColumn("d", F.lit(1))
    got = nn_descent.knn_graph(df, 96, 5, 0.95).toPandas()
    m = np.array([v for _, v in rows]).astype(np.float32).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    s = np.round(m @ m.T, 9)
    np.fill_diagonal(s, -2)
    want = {(i, j) for i in range(len(rows)) for j in sorted(range(len(rows)), key=lambda j: (-s[i, j], j))[:5] if s[i, j] >= 0.95}
    have = set(zip(got.id, got.neighbour))
    assert len(have & want) >= 0.99 * len(want) and len(have - want) <= 0.01 * len(want)
    assert nn_descent.knn_graph(df.limit(0), 96).count() == 0
    found = nn_descent.greedy_search(got_df(spark, got), df, df.where("id < 20"), 96, 3).toPandas()
    best = found[found["rank"] == 1]
    assert len(best) == 20 and (best.similarity > 0.999).all()


def test_crowds_of_near_copies_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    vecs = []
    for n, noise in ((400, 0.12), (150, 0.05), (60, 0.15), (8, 0.1)):
        base = rng.standard_normal(96)
        vecs += [base + noise * rng.standard_normal(96) for _ in range(n)]
    m = np.array(vecs).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, features array<float>")
    got = nn_descent.knn_graph(df, 96, 5, 0.95)
    m = m.astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    s = m @ m.T
    np.fill_diagonal(s, -2)
    want = {(i, int(j)) for i in range(len(m)) for j in np.argsort(-s[i])[:5] if s[i, j] >= 0.95}
    assert len(want) > 2800 and {(r["id"], r["neighbour"]) for r in got.collect()} == want


def test_crowds_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "CROWD_BLOCK", 50)
    test_crowds_of_near_copies_equal_brute_force(spark)


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (7, 9), (20, 21)] + [(i, i + 1) for i in range(100, 140)]
    got = {r["id"]: r["part"] for r in nn_descent.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20} | {i: 100 for i in range(100, 141)}


def got_df(spark, pdf):
    return spark.createDataFrame(pdf[["id", "neighbour"]])


# --- 7 ----------------------------------------------------------------------------------------------------------------
def test_ids_equal_the_whole_encoding():
    e = tokenizing.encoder(tokenizing.TOKENIZER_DIR, "byte_bpe_50k")
    random.seed(3)
    alphabet = list("ab 'sStlvedrm\n\t\r 12.,!?éß中の　\xa0​😀́ก-\"’<|>")
    for _ in range(5000):
        s = "".join(random.choices(alphabet, k=random.randint(1, 20)))
        assert list(e.ids(s)) == e.encoding.encode_ordinary(s), repr(s)
    for t in pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist():
        assert list(e.ids(t)) == (e.encoding.encode_ordinary(t) if t else [])


def test_ids_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<|endoftext|>"), (4, "long word " * 50_000)], "doc_id long, text string").withColumn("ids", F.lit("old"))
    got = {r["doc_id"]: r["ids"] for r in tokenizing.encode(df).collect()}
    assert got[1] == [] and got[2] == [] and 50256 not in got[3] and len(got[3]) > 1 and len(got[4]) >= 100_000
    assert tokenizing.encode(df.limit(0)).count() == 0


# --- 8 ----------------------------------------------------------------------------------------------------------------
def test_mix_follows_weights_and_caps(spark):
    random.seed(6)
    docs = spark.createDataFrame([(i, "big" if i % 4 else "small", "word " * random.randint(1, 30)) for i in range(800)] + [(9000, None, "x"), (9001, "big", None), (9002, "big", "")], "doc_id long, source string, text string").withColumn("block", F.lit(1))
    targets = spark.createDataFrame([("p", "big", 3.0, 1), ("p", "small", 7.0, 2), ("p", "gone", 5.0, 1), ("q", "big", 1.0, None), ("r", "gone", 1.0, None), ("s", "small", None, 1)], "mix_plan string, source string, weight double, max_repeats int")
    m = mixing.mix(docs, targets, shards=5)
    sel, sh = m.selection.toPandas(), m.shares.toPandas().set_index(["mix_plan", "source"])
    assert sh.loc[("p", "small")].share == pytest.approx(0.7, abs=0.01) and sh.loc[("p", "gone")].tokens == 0
    assert sel.groupby(["mix_plan", "doc_id"]).size().loc["p"].max() <= 2 and sel[(sel.mix_plan == "p") & (sel.source == "big")].groupby("doc_id").size().max() == 1
    assert not sel.duplicated(["mix_plan", "doc_id", "pass"]).any() and set(sel.mix_plan) == {"p", "q"} and not sel.doc_id.isin([9000, 9001, 9002]).any()
    assert sel[sel.mix_plan == "q"].doc_id.nunique() == 600
    again = mixing.mix(docs, targets, shards=5).selection.toPandas()
    key = ["mix_plan", "doc_id", "pass", "shard"]
    assert sorted(map(tuple, sel[key].values)) == sorted(map(tuple, again[key].values))


def test_splitting_tree_keeps_counts():
    rng = np.random.default_rng(0)
    t = mixing.split_tree(np.array([100, 7, 0]), 16, rng)
    assert t.sum(0).tolist() == [100, 7, 0] and np.ptp(t.sum(1)) <= 1


# --- 9 ----------------------------------------------------------------------------------------------------------------
CASES = [
    ["Mr. Ilgaz paid £1,242.25 at 9.30 p.m. daily.", "Late arrival?", "“We stayed in No. 9. It was fine,” wrote Dr. Ilgaz.", "See www.a.example for details…", "It’s 6 a.m.", "Please close it."],
    ["Am 3. Oktober 1996 eröffnete Dr. X den Flügel.", "Haustiere (z. B. Hunde bis 3 kg) sind ok.", "„Gibt es Parkplätze?“, fragte Hr. Bern.", "(Das ist gut.)", "Was kostet das?"],
    ["« Avez-vous une chambre ? » demanda Mme Quillan.", "Prévenez-nous !", "M. Z dirige l’hôtel."],
    ["Животные допускаются, и т. д.", "Дом построен по проекту А. Б. Зарубов.", "«Есть ли номера?» – спросил г-н Остряков."],
    ["Υπάρχει πάρκινγκ;", "Ναι, με 2.203,90 € την ημέρα.", "Ο κ. Szandor ήρθε."],
    ["होटल केंद्र से 40.78 किमी दूर है।", "“क्या कमरा खाली है?” मेहमान ने पूछा।", "डॉ. सोमानी ने इसे शुरू किया।"],
    ["تبلغ مساحة الغرفة 16.43 م²، وفيها شرفة.", "«هل توجد غرف؟» سأل د. السهلي.", "الموقع جيد!"],
    ["เช็คอินได้ตั้งแต่เวลา 23:00 น. เป็นต้นไป", "ห้องพักสะอาดมากค่ะ", "ที่จอดรถคิดค่าบริการ 755 บาทต่อคืน"],
]


@pytest.mark.parametrize("want", CASES)
def test_sentences_by_language(want):
    text = " ".join(want)
    assert [text[a:b] for a, b in sentences.sentences(text)] == want


def test_sentences_without_spaces_lines_and_lists():
    t = "ロビーが最高でした。「空室はありますか？」と客が尋ねた。駅から5.5kmです！\n* 無料\n* 駐車場20台\nHouse rules\n\nIt was good 😊 Next one.No space"
    assert [t[a:b] for a, b in sentences.sentences(t)] == ["ロビーが最高でした。", "「空室はありますか？」と客が尋ねた。", "駅から5.5kmです！", "* 無料", "* 駐車場20台", "House rules", "It was good 😊", "Next one.", "No space"]
    w = "The bed was cosy, and the heated pool was stylish too, and we loved\nour balcony, which was bright. Great value at night, said the man who\nwas here."
    assert len(sentences.sentences(w)) == 2


def test_every_character_is_in_one_sentence(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, None), (-2, " \n "), (-3, "a. " * 20_000), (-4, "“(((" * 50), (-5, "...!?")], "doc_id long, text string")
    docs = docs.unionByName(extra).withColumn("start_char", F.lit(1))
    got = sentences.split(docs).toPandas()
    for d, text in docs.select("doc_id", "text").toPandas().itertuples(index=False):
        spans = got[got.doc_id == d].sort_values("start_char")
        pieces = [text[a:b] for a, b in zip(spans.start_char, spans.end_char)] if isinstance(text, str) else []
        assert all(p == p.strip() and p for p in pieces)
        assert "".join("".join(pieces).split()) == "".join((text or "").split())
        assert (spans.start_char.to_numpy()[1:] >= spans.end_char.to_numpy()[:-1]).all()


def test_nothing_outside_imports_llm():
    from pathlib import Path

    import quoin

    root = Path(quoin.__file__).parent
    assert not [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts and "quoin.llm" in p.read_text()]
    assert pd is not None


def test_plan_rows_are_bounded_however_often_a_source_repeats():
    sums = {"small": {b: 1 for b in range(64)}, "large": {b: 2000 for b in range(64)}}
    want = {"small": 64 * 1998 + 5, "large": 64 * 2000}
    rows = mixing.plan_blocks("p", want, sums, 16, 1)
    assert len(rows) <= 2 * 64 * 17
    seen = sorted((s, p, b) for _, s, b, _, first, n, _ in rows for p in range(first, first + n))
    assert len(seen) == len(set(seen)) == 64 * 1998 + 5 + 64 and {p for s, p, _ in seen if s == "small"} == set(range(1999))
    per = [sum(n for _, s, _, k, _, n, _ in rows if k == shard) for shard in range(16)]
    assert max(per) - min(per) <= 1


def test_a_cap_of_zero_leaves_out_its_source_only():
    assert mixing.quotas({"a": (1.0, 0), "b": (1.0, 2), "c": (2.0, None)}, {"a": 10, "b": 10, "c": 30}) == {"b": 20, "c": 40}


def test_counts_equal_the_ids():
    e = tokenizing.encoder(tokenizing.TOKENIZER_DIR, "byte_bpe_50k")
    for t in ["", None, "Zimmer 12 war's!", "服务态度很好 😀\n\n x", "a" * 3000]:
        assert e.count(t) == len(e.ids(t))


def test_long_quotations_stay_whole_up_to_a_blank_line():
    body = "Es war gut. " * 120
    assert len(sentences.sentences(f"Er sagte: „{body.strip()}“ Danach ging er.")) == 2
    assert len(sentences.sentences(f"Er sagte: „{body.strip()}\n\nDanach ging er.")) > 100
    assert sentences.sentences("Kein Ende" + "." * 400 + " Neu. " + "wort " * 90 + "aus. Ende.")[-1][1] == 9 + 400 + 6 + 450 + 10


def test_lost_bytes_are_restored_at_any_place():
    """Planted truth: a byte lost from a garbled word, shown or gone, wherever in its character it stood."""
    rng = random.Random(4)
    words = ["отличное", "расположение", "завтрак", "gemütlich", "Frühstück", "niño", "señora", "habitación", "déjeuner", "chambre", "très", "łóżko", "śniadanie", "服务态度很好", "早餐不错", "位置优越"]
    words = {w: 40 for w in words if not w.isascii()}
    pairs = {}
    for w, n in words.items():
        x = "\x02" + w + "\x03"
        for i in range(len(x) - 1):
            pairs[x[i : i + 2]] = pairs.get(x[i : i + 2], 0) + n
    model = encoding_repair.Model(words, pairs, sum(words.values()))
    assert all(model.repair(w) == w for w in words)
    for read, true, least in (("cp1252", "utf-8", 0.9), ("mac_roman", "utf-8", 0.9), ("latin-1", "gb18030", 0.6)):
        right = tries = 0
        for w in words:
            try:
                g = w.encode(true).decode(read)
            except UnicodeError:
                continue
            high = [i for i, c in enumerate(g) if c > "\x7f"]
            if g == w or len(high) < 4:
                continue
            for _ in range(4):
                i = rng.choice(high)
                right += model.repair(g[:i] + "�" + g[i + 1 :]) == w
                tries += 1
        assert tries >= 8 and right >= least * tries, (read, true, right, tries)
