"""Most similar vectors of every vector: a neighbour graph by NN-descent, and greedy search in it.

The graph starts from links that are cheap to find: in each of TABLES random rotations a vector gets a
cross-polytope key (the signed axes nearest to it, a few in a row), the vectors are sorted by key, and each is
linked to the next WINDOW. The sort is a range partitioning by (key, id), so a key that a third of all vectors
share is spread over many tasks, and no bucket is ever expanded into all its pairs. Then NN-descent: the
neighbours of a vector's neighbours are joined to it, the best DEGREE links of each are kept, and this is
repeated until fewer than STOP of the links are new; a pair of neighbours is only offered once, while one of its
two links is new. The rounds compare bit codes (signs of random projections), so they move a few dozen bytes per
link; only the graph that came out of them is scored with the vectors themselves.

``least`` is the lowest similarity of interest: links whose codes are further apart than such vectors' codes can
be (by SLACK standard deviations) are dropped at once, so vectors without a near neighbour cost nothing in the
rounds. Vectors of the very same numbers are one node of the graph and share its links.

A node whose links fill its list may have lost nearer ones to the coarse codes. Such crowds (a node with a full list
and all that links lead to from it) are searched exactly: all pairs of a crowd, in blocks of CROWD_BLOCK nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quoin.session import checkpoint

TABLES, WINDOW, AXES = 8, 10, 4
CODE_WORDS = 2
DEGREE, STOP, ROUNDS = 24, 0.005, 6
SLACK = 4.0
CROWD_BLOCK = 8192
SEED = 7


def _rotations(dim: int, tables: int, seed: int) -> np.ndarray:
    """Random matrices, AXES blocks of as many axes as a key takes, per table."""
    return np.random.default_rng(seed).standard_normal((tables, AXES, dim, 32)).astype(np.float32)


def _planes(dim: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed + 1).standard_normal((dim, 64 * CODE_WORDS)).astype(np.float32)


def usable(features: F.Column, dim: int) -> F.Column:
    """True for vectors of dim finite numbers that are not all zero; never null."""
    finite = F.forall(features, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(features) == dim) & finite & F.exists(features, lambda x: x != 0), F.lit(False))


def _unit(rows: pd.Series, dim: int) -> np.ndarray:
    m = np.stack(rows.to_numpy()).astype(np.float64) if len(rows) else np.empty((0, dim))
    return m / np.linalg.norm(m, axis=1, keepdims=True)


NODE = "id long, h long, " + ", ".join(f"w{i} long" for i in range(CODE_WORDS)) + ", " + ", ".join(f"k{t} long" for t in range(TABLES))


def encode(vectors: DataFrame, dim: int, seed: int = SEED) -> DataFrame:
    """vectors(id, features) -> code, keys and a hash of the very numbers of each usable vector."""
    vectors = vectors.where(usable(F.col("features"), dim)).select("id", "features")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rot, planes = _rotations(dim, TABLES, seed), _planes(dim, seed)
        for pdf in batches:
            u = _unit(pdf["features"], dim)
            f = u.astype(np.float32)
            out = {"id": pdf["id"].to_numpy()}
            out["h"] = np.array([xxhash.xxh64_intdigest(np.asarray(x, np.float32).tobytes()) for x in pdf["features"]], np.uint64).view(np.int64)
            bits = np.packbits(f @ planes > 0, axis=1, bitorder="little").view(np.int64).reshape(len(f), CODE_WORDS)
            for i in range(CODE_WORDS):
                out[f"w{i}"] = bits[:, i]
            for t in range(TABLES):
                key = np.zeros(len(f), np.int64)
                for a in range(AXES):
                    p = f @ rot[t, a]
                    at = np.abs(p).argmax(axis=1)
                    key = key * 64 + at * 2 + (p[np.arange(len(f)), at] > 0)
                out[f"k{t}"] = key
            yield pd.DataFrame(out)

    return vectors.mapInPandas(run, NODE)


def reach(least: float) -> int:
    """Bits in which the codes of two vectors of that similarity can differ, but for SLACK standard deviations."""
    p, n = math.acos(max(-1.0, min(1.0, least))) / math.pi, 64 * CODE_WORDS
    return min(n, math.ceil(n * p + SLACK * math.sqrt(n * p * (1 - p))))


def _code(prefix: str = "") -> list[str]:
    return [f"{prefix}w{i}" for i in range(CODE_WORDS)]


def _apart(p: str, q: str):
    total = None
    for i in range(CODE_WORDS):
        d = F.bit_count(F.col(f"{p}w{i}").bitwiseXOR(F.col(f"{q}w{i}")))
        total = d if total is None else total + d
    return total


LINK = "a long, b long, d int"


def seed_links(nodes: DataFrame, most: int) -> DataFrame:
    """Links a < b of vectors that stand near each other in the order of one of the tables' keys."""
    keyed = nodes.select("id", *_code(), F.explode(F.array(*(F.struct(F.lit(t).cast("byte").alias("t"), F.col(f"k{t}").alias("k")) for t in range(TABLES)))).alias("x")).select("x.t", "x.k", "id", *_code())
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(n, "t", "k", "id").sortWithinPartitions("t", "k", "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for pdf in batches:
            both = pdf if tail is None else pd.concat([tail, pdf], ignore_index=True)
            fresh = 0 if tail is None else len(tail)
            t, ids, w = both["t"].to_numpy(), both["id"].to_numpy(), both[_code()].to_numpy().astype(np.int64).view(np.uint64)
            for s in range(1, WINDOW + 1):
                j = np.arange(max(fresh, s), len(both))  # the later of the two is new in this batch
                i = j - s
                d = np.bitwise_count(w[i] ^ w[j]).sum(axis=1)
                ok = (t[i] == t[j]) & (d <= most)
                x, y = ids[i[ok]], ids[j[ok]]
                yield pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y), "d": d[ok].astype(np.int32)})
            tail = both.tail(WINDOW)

    return ordered.mapInPandas(run, LINK).where("a <> b").dropDuplicates(["a", "b"])


def descend(links: DataFrame, codes: DataFrame, most: int, degree: int = DEGREE, rounds: int = ROUNDS, stop: float = STOP) -> DataFrame:
    """Rounds of NN-descent on links (a < b, d) of the vectors with these codes; returns the links kept, a < b.

    Each vector's nearest ``degree`` links count as its neighbours, so a vector joins no more than degree squared
    pairs a round, however many vectors lie close to it.
    """
    codes = codes.select("id", *_code())
    graph = checkpoint(links.select("a", "b", "d", F.lit(True).alias("new")))
    for _ in range(rounds):
        ways = F.array(F.struct("a", "b", "d", "new"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "d", "new"))
        rank = F.row_number().over(Window.partitionBy("a").orderBy("d", "b"))
        near = graph.select(F.inline(ways)).withColumn("rank", rank).where(F.col("rank") <= degree).drop("rank")
        near = checkpoint(near.join(codes.withColumnRenamed("id", "b"), "b"))
        left = near.select(F.col("a").alias("m"), F.col("b").alias("x"), F.col("new").alias("nx"), *(F.col(c).alias("x" + c) for c in _code()))
        right = near.select(F.col("a").alias("m"), F.col("b").alias("y"), F.col("new").alias("ny"), *(F.col(c).alias("y" + c) for c in _code()))
        met = left.join(right, "m").where("x < y AND (nx OR ny)").withColumn("d", _apart("x", "y").cast("int")).where(F.col("d") <= most)
        kept = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "d", F.lit(False).alias("new"))
        offered = met.select(F.col("x").alias("a"), F.col("y").alias("b"), "d", F.lit(True).alias("new"))
        # A link that was there before is none of the new ones.
        graph = checkpoint(kept.unionByName(offered).groupBy("a", "b").agg(F.min("d").alias("d"), F.min("new").alias("new")))
        size, fresh = graph.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("new").cast("long")), F.lit(0))).first()
        if fresh <= stop * size:
            break
    return graph.select("a", "b", "d")


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> (id, part): the smallest id that links lead to from each, by large and small stars in turn."""
    both = lambda df: df.unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges, before = checkpoint(links.where("a <> b").select("a", "b").distinct()), None
    while True:
        for large in (True, False):
            ways = both(edges)
            ways = ways if large else ways.where("b < a")
            least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            ways = ways.where("b > a") if large else ways.unionByName(ways.select("a", F.col("a").alias("b")).distinct())
            edges = ways.join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        edges = checkpoint(edges)
        now = tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38, 0)")), F.lit(0))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("id"), F.col("a").alias("part")).unionByName(edges.select(F.col("a").alias("id"), F.col("a").alias("part")).distinct())


def finish_crowds(links: DataFrame, vectors: DataFrame, dim: int, k: int, least: float, degree: int = DEGREE) -> DataFrame | None:
    """links(a, b) of NN-descent -> (a, b): the k nearest of every node of a crowd, exactly; None if there is no crowd."""
    each = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    full = checkpoint(each.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= degree).select("a"))
    if full.isEmpty():
        return None
    crowd = components(each.join(full, "a", "left_semi"))
    # Nodes with few links of their own that lead into a crowd are of it too.
    rim = each.join(crowd.withColumnRenamed("id", "b"), "b").join(crowd.select(F.col("id").alias("a")), "a", "left_anti").select(F.col("a").alias("id"), "part").distinct()
    crowd = checkpoint(crowd.unionByName(rim))
    blocks = crowd.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CROWD_BLOCK).cast("int").alias("blocks"))
    at = crowd.join(blocks, "part").withColumn("block", F.pmod(F.xxhash64("id", "part"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    at = at.select("id", "part", "block", other).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    rows = at.join(vectors.select("id", "features"), "id").select("part", "i", "j", "block", "id", "features")

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf["block"] == pdf["i"].iloc[0]
        left = pdf[one]
        right = left if pdf["i"].iloc[0] == pdf["j"].iloc[0] else pdf[~one]
        ids, u = [x["id"].to_numpy() for x in (left, right)], [_unit(x["features"], dim) for x in (left, right)]
        out: list[pd.DataFrame] = []
        for x, y in ((0, 1), (1, 0)) if right is not left else ((0, 1),):
            for lo in range(0, len(ids[x]), 512):
                s = u[x][lo : lo + 512] @ u[y].T
                s[ids[x][lo : lo + 512, None] == ids[y][None, :]] = -2
                # The k best and those as good as the last of them up to rounding, which the exact cosine and the ids tell apart.
                top = min(k, s.shape[1])
                last = np.partition(s, s.shape[1] - top, axis=1)[:, s.shape[1] - top] if top else np.empty(len(s))
                r, c = np.nonzero(s >= np.maximum(last, least)[:, None] - 1e-12) if top else (np.empty(0, int),) * 2
                ok = s[r, c] > -2
                r, c = r[ok], c[ok]
                got = pd.DataFrame({"a": ids[x][lo : lo + 512][r], "b": ids[y][c], "s": s[r, c].round(12)})
                got = got.sort_values(["a", "s", "b"], ascending=[True, False, True])
                out.append(got.groupby("a").head(2 * k))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "s": []}).astype({"a": "int64", "b": "int64"})

    met = rows.groupBy("part", "i", "j").applyInPandas(nearest, "a long, b long, s double")
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))
    return met.distinct().withColumn("rank", rank).where(F.col("rank") <= 2 * k).select("a", "b")


def _cosine(x: pd.Series, y: pd.Series) -> pd.Series:
    """Cosine in double precision of the numbers as stored."""
    if not len(x):
        return pd.Series([], dtype="float64")
    a, b = (np.stack(s.to_numpy()).astype(np.float64) for s in (x, y))
    return pd.Series((a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1)) / np.sqrt((b * b).sum(axis=1)))


def knn_graph(vectors: DataFrame, dim: int, k: int = 5, least: float = -1.0, seed: int = SEED) -> DataFrame:
    """(id, neighbour, similarity, rank): the k most similar other vectors of each, of similarity ``least`` or more.

    vectors(id long, features array<float>). Vectors that are null, of another length, all zero, or hold a null, NaN
    or infinite number are in no pair. Equal similarities rank by id. Vectors of the very same numbers are one
    node; each of its members has the others as neighbours first, then the members of near nodes.
    """
    nodes = checkpoint(encode(vectors, dim, seed))
    # One node for all equal vectors: the smallest id. Only the k + 1 first members can be anyone's neighbours by rank.
    group = nodes.groupBy("h").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
    alone = nodes.join(group.select(F.col("node").alias("id")), "id", "left_semi")
    most = reach(least)
    pairs = descend(seed_links(alone, most), alone, most).select("a", "b")
    exact = finish_crowds(pairs, vectors, dim, k, least)
    if exact is not None:
        pairs = pairs.unionByName(exact.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
    vec = vectors.select("id", F.col("features").alias("vec"))
    cosine = F.pandas_udf(_cosine, T.DoubleType())
    scored = pairs.join(vec.select(F.col("id").alias("a"), F.col("vec").alias("va")), "a").join(vec.select(F.col("id").alias("b"), F.col("vec").alias("vb")), "b")
    scored = checkpoint(scored.select("a", "b", cosine("va", "vb").alias("s")).where(F.col("s") >= least))
    many = group.where("copies > 1")
    member = nodes.select("id", "h").join(many, "h").select("node", "id")
    lead = member.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("id"))).where(F.col("r") <= k + 1).select("node", F.col("id").alias("first"))
    both = scored.unionByName(scored.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
    # Each node's near nodes, opened to their first members; then each node opened to all its members.
    opened = both.join(lead.withColumnRenamed("node", "b"), "b", "left").select("a", F.coalesce("first", "b").alias("b"), "s")
    opened = opened.unionByName(lead.select(F.col("node").alias("a"), F.col("first").alias("b"), F.lit(1.0).alias("s")))
    top = opened.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))).where(F.col("r") <= 2 * k + 2).drop("r")
    rows = top.join(member.withColumnRenamed("node", "a"), "a", "left").select(F.coalesce("id", "a").alias("id"), F.col("b").alias("neighbour"), F.col("s").alias("similarity")).where("id <> neighbour")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def greedy_search(graph: DataFrame, vectors: DataFrame, queries: DataFrame, dim: int, k: int = 5, width: int = 20, hops: int = 4, entries: int = 64) -> DataFrame:
    """(query, id, similarity, rank): the k vectors a greedy walk through the graph finds nearest to each query.

    graph(id, neighbour); vectors, queries(id, features). Every query starts at the same ``entries`` vectors (those with
    the smallest hash of their id) and at the vectors that share a key with it in one of the tables; in each hop the
    neighbours of its best ``width`` vectors join them. Unusable queries give no row.
    """
    base = checkpoint(encode(vectors, dim).join(vectors.select("id", "features"), "id"))
    asked = checkpoint(encode(queries, dim).join(queries.select("id", "features"), "id"))
    cosine = F.pandas_udf(_cosine, T.DoubleType())
    start = base.orderBy(F.xxhash64("id")).limit(entries).select("id")
    keys = lambda df, name: df.select(F.col("id").alias(name), F.posexplode(F.array(*(F.floor(F.col(f"k{t}") / 64) for t in range(TABLES))))).withColumnRenamed("col", "k")
    few = keys(base, "id").withColumn("r", F.row_number().over(Window.partitionBy("pos", "k").orderBy("id"))).where(F.col("r") <= width).drop("r")
    first = keys(asked, "query").join(few, ["pos", "k"]).select("query", "id")
    found = asked.select(F.col("id").alias("query")).join(F.broadcast(start)).unionByName(first).distinct()
    ways = graph.select(F.col("id").alias("at"), F.col("neighbour").alias("id")).unionByName(graph.select(F.col("neighbour").alias("at"), "id")).distinct()
    score = lambda df: df.join(asked.select(F.col("id").alias("query"), F.col("features").alias("qv")), "query").join(base.select("id", "features"), "id").select("query", "id", cosine("qv", "features").alias("similarity"))
    best = Window.partitionBy("query").orderBy(F.desc("similarity"), "id")
    held = None
    for hop in range(hops + 1):
        new = found if held is None else held.select("query", F.col("id").alias("at")).join(ways, "at").select("query", "id").distinct().join(held.select("query", "id"), ["query", "id"], "left_anti")
        got = score(new)
        held = got if held is None else held.drop("rank").unionByName(got)
        held = checkpoint(held.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= width))
    return held.where(F.col("rank") <= k)
