"""Centroids and what is built on them: Lloyd steps, bags of words, VLAD, covariance, Gaussian mixtures, Fisher vectors.

Centroids are model parameters: few, and bounded by the caller's k, so they are kept on the driver and broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quoin.session import checkpoint

Centroids = np.ndarray


def first_vectors(df: DataFrame, k: int) -> Centroids:
    """The vectors of the k smallest ids, a reproducible start."""
    return np.array([r["vec"] for r in df.where(F.col("vec").isNotNull()).orderBy("id").limit(k).collect()], np.float64)


def nearest_word(df: DataFrame, centroids: Centroids, out: str = "word", kind: str = "l2") -> DataFrame:
    """Add the number of the nearest centroid; ties go to the lower number, null vectors get null."""
    shared = df.sparkSession.sparkContext.broadcast(np.asarray(centroids, np.float64))

    @F.pandas_udf("int")
    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = shared.value
        for s in batches:
            got = pd.Series(pd.NA, index=s.index, dtype="Int32")
            known = s.notna()
            if known.any():
                x = np.stack(s[known].to_numpy()).astype(np.float64)
                # Distances but for the square of the vector itself, which is the same for all centroids.
                d = np.stack([np.abs(x - row).sum(1) for row in c], 1) if kind == "l1" else (c * c).sum(1) - 2 * x @ c.T
                got[known] = d.argmin(1).astype(np.int32)
            yield got

    return df.withColumn(out, assign("vec"))


def cell_means(assigned: DataFrame, word: str = "word", how: str = "mean") -> DataFrame:
    """(word, dim, value): mean, or for L1 median, of each component per cell."""
    parts = assigned.where(F.col(word).isNotNull()).select(word, F.posexplode(F.col("vec").cast("array<double>")).alias("dim", "x"))
    return parts.groupBy(word, "dim").agg((F.avg("x") if how == "mean" else F.median("x")).alias("value"))


def lloyd(df: DataFrame, start: Centroids, rounds: int, kind: str = "l2") -> Centroids:
    """Centroids after so many rounds of assignment and update; an empty cell keeps its centroid."""
    c = np.array(start, np.float64)
    for _ in range(rounds):
        for r in cell_means(nearest_word(df, c, kind=kind), how="mean" if kind == "l2" else "median").collect():
            c[r["word"], r["dim"]] = r["value"]
    return c


def hierarchical(df: DataFrame, branching: int, levels: int, rounds: int = 3) -> list[Centroids]:
    """Centroids per level of a tree with that branching; level i has branching^(i + 1) of them."""
    tree, cells = [], df.withColumn("cell", F.lit(0))
    for level in range(levels):
        out = np.zeros((branching ** (level + 1), len(df.first()["vec"])))
        for cell in range(branching**level):
            part = cells.where(F.col("cell") == cell)
            start = first_vectors(part, branching)
            if len(start):
                start = np.vstack([start, np.repeat(start[-1:], branching - len(start), 0)]) if len(start) < branching else start
                out[cell * branching : (cell + 1) * branching] = lloyd(part, start, rounds)
        tree.append(out)
        cells = tree_word(df, tree).withColumnRenamed("word", "cell")
    return tree


def tree_word(df: DataFrame, tree: list[Centroids]) -> DataFrame:
    """Descend the tree: at each level the nearest of the node's children."""
    shared = df.sparkSession.sparkContext.broadcast(tree)

    @F.pandas_udf("int")
    def descend(s: pd.Series) -> pd.Series:
        out = []
        for v in s:
            at = 0
            k = len(shared.value[0])
            for c in shared.value:
                child = c[at * k : (at + 1) * k]
                at = at * k + int(((np.asarray(v, float) - child) ** 2).sum(1).argmin())
            out.append(at)
        return pd.Series(out, dtype="int32")

    return df.withColumn("word", descend("vec"))


def bag_of_words(assigned: DataFrame, owner: str, word: str = "word") -> DataFrame:
    """(owner, word, n, share): counts, and counts over the owner's total."""
    n = assigned.groupBy(owner, word).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(owner)))


def idf(assigned: DataFrame, word: str = "word") -> DataFrame:
    """(word, idf): log of all assignments over the word's, counted by assignment."""
    n = assigned.groupBy(word).agg(F.count(F.lit(1)).alias("df"))
    total = assigned.agg(F.count(F.lit(1)).alias("total"))
    return n.join(F.broadcast(total)).select(word, F.log(F.col("total") / (F.col("df") + 2.0**-23)).alias("idf"))


def vlad(assigned: DataFrame, owner: str, centroids: Centroids) -> DataFrame:
    """(owner, word, dim, value): summed residuals to the centroid, not normalised."""
    spark = assigned.sparkSession
    c = spark.createDataFrame([(w, d, float(x)) for w, row in enumerate(centroids) for d, x in enumerate(row)], "word int, dim int, c double")
    parts = assigned.select(owner, "word", F.posexplode(F.col("vec").cast("array<double>")).alias("dim", "x"))
    return parts.join(F.broadcast(c), ["word", "dim"]).groupBy(owner, "word", "dim").agg(F.sum(F.col("x") - F.col("c")).alias("value"))


def covariance(df: DataFrame, sample: bool = False) -> DataFrame:
    """(i, j, cov) of the components, i <= j: over n, or n - 1 for ``sample``. One pass of sums, added up per partition."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, ss = 0, None, None
        for pdf in batches:
            if len(pdf):
                m = np.stack(pdf["vec"].to_numpy()).astype(np.float64)
                n, s, ss = n + len(m), m.sum(0) + (0 if s is None else s), m.T @ m + (0 if ss is None else ss)
        if n:
            i, j = np.triu_indices(len(s))
            yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "n": n, "si": s[i], "sj": s[j], "sij": ss[i, j]})

    parts = df.where(F.col("vec").isNotNull()).select("vec").mapInPandas(sums, "i int, j int, n long, si double, sj double, sij double")
    t = parts.groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in ("n", "si", "sj", "sij")))
    cov = F.col("sij") / F.col("n") - F.col("si") / F.col("n") * F.col("sj") / F.col("n")
    return t.select("i", "j", (cov * F.col("n") / (F.col("n") - 1) if sample else cov).alias("cov"))


def pca(df: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, components x dims) from the covariance; only the d x d matrix comes to the driver."""
    mean = np.array([r["m"] for r in df.select(F.posexplode(F.col("vec").cast("array<double>")).alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).orderBy("i").collect()])
    c = np.zeros((len(mean), len(mean)))
    for r in covariance(df).collect():
        c[r["i"], r["j"]] = c[r["j"], r["i"]] = r["cov"]
    values, vectors = np.linalg.eigh(c)
    return mean, vectors[:, ::-1][:, :dims]


def mixture_posteriors(x: np.ndarray, w: np.ndarray, mu: np.ndarray, sigma: np.ndarray) -> np.ndarray:
    """Responsibilities of diagonal Gaussians; shares e^-16.636 below the largest are 0."""
    log = -0.5 * (((x[:, None, :] - mu) ** 2 / sigma).sum(2) + np.log(2 * np.pi * sigma).sum(1)) + np.log(w)
    log -= log.max(1, keepdims=True)
    p = np.where(log < -16.636, 0.0, np.exp(log))
    return p / p.sum(1, keepdims=True)


def fit_mixture(df: DataFrame, k: int, rounds: int = 10, floor: float = 1e-9) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal mixture (weights, means, variances) by EM from the first k vectors; only sums leave the tasks."""
    mu = first_vectors(df, k)
    k, d = mu.shape
    w, sigma = np.full(k, 1 / k), np.full((k, d), max(floor, float(df.select(F.explode(F.col("vec").cast("array<double>")).alias("x")).agg(F.var_pop("x")).first()[0])))
    for _ in range(rounds):
        model = df.sparkSession.sparkContext.broadcast((w, mu, sigma))

        def step(batches: Iterator[pd.DataFrame], model=model) -> Iterator[pd.DataFrame]:
            w, mu, sigma = model.value
            acc = [np.zeros(len(w)), np.zeros(mu.shape), np.zeros(mu.shape)]
            for pdf in batches:
                if len(pdf):
                    x = np.stack(pdf["vec"].to_numpy()).astype(np.float64)
                    p = mixture_posteriors(x, w, mu, sigma)
                    acc[0] += p.sum(0)
                    acc[1] += p.T @ x
                    acc[2] += np.stack([p[:, j] @ (x - mu[j]) ** 2 for j in range(len(w))])
            yield pd.DataFrame({"part": [np.concatenate([acc[0], acc[1].ravel(), acc[2].ravel()])]})

        parts = [np.array(r["part"]) for r in df.select("vec").mapInPandas(step, "part array<double>").collect()]
        t = np.sum(parts, axis=0)
        n, sx, sd = t[:k], t[k : k + k * d].reshape(k, d), t[k + k * d :].reshape(k, d)
        n = np.maximum(n, 1e-12)
        new = sx / n[:, None]
        w, sigma = n / n.sum(), np.maximum(sd, floor) / n[:, None]
        if np.array_equal(new, mu):
            break
        mu = new
    return w, mu, sigma


def fisher_vector(x: np.ndarray, w: np.ndarray, mu: np.ndarray, sigma: np.ndarray) -> np.ndarray:
    """Gradients to weights (k - 1), means and variances of the vectors of one owner."""
    p, n = mixture_posteriors(x, w, mu, sigma), len(x)
    s = p.sum(0)
    gw = (s[1:] / w[1:] - s[0] / w[0]) / np.sqrt(n * (1 / w[1:] + 1 / w[0]))
    px, pxx = p.T @ x, p.T @ (x * x)
    gm = (px - mu * s[:, None]) / sigma / np.sqrt(n * w[:, None] / sigma)
    gs = (pxx - 2 * mu * px + s[:, None] * (mu * mu - sigma)) / (sigma * np.sqrt(2 * n * w[:, None]))
    return np.concatenate([gw, gm.ravel(), gs.ravel()])


def _squares(df: DataFrame) -> DataFrame:
    """(qid, id, dist): squared distance of each row's ``qvec`` and ``vec``, never of a vector to itself."""
    dist = F.aggregate(F.zip_with(F.col("vec").cast("array<double>"), F.col("qvec").cast("array<double>"), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    return df.where("id <> qid").select("qid", "id", dist.alias("dist"))


def _open_cells(df: DataFrame, centroids: Centroids, radius: np.ndarray) -> DataFrame:
    """df(qid, qvec, word, reach) with ``also``: the other cells that can hold a vector within ``reach`` of the query.

    A cell is left out only where a bound on its distance says so: that of the ball round its centroid, or that of the
    plane halfway to the query's own centroid, which no vector of the cell lies beyond.
    """
    shared = df.sparkSession.sparkContext.broadcast((np.asarray(centroids, np.float64), radius))

    @F.pandas_udf("array<int>")
    def cells(vec: pd.Series, word: pd.Series, reach: pd.Series) -> pd.Series:
        c, r = shared.value
        out = []
        for v, w, most in zip(vec, word, reach):
            d = np.sqrt(((np.asarray(v, np.float64) - c) ** 2).sum(1))
            between = np.sqrt(((c - c[w]) ** 2).sum(1))
            plane = np.where(between > 0, (d * d - d[w] * d[w]) / np.where(between > 0, 2 * between, 1), 0.0)
            can = (np.maximum(d - r, plane) <= most * (1 + 1e-9) + 1e-9) & (r >= 0)
            can[w] = False
            out.append(np.flatnonzero(can).astype(np.int32))
        return pd.Series(out, dtype=object)

    return df.withColumn("also", cells("qvec", "word", "reach"))


def cell_neighbours(df: DataFrame, queries: DataFrame, k: int, tables: int = 3, cells: int = 16) -> DataFrame:
    """Exact k-NN by k-means partitions: (qid, id, dist, rank), squared distances, ties by id.

    A query first searches its own cell of each table; the k-th distance found bounds the search of the first table's
    other cells, of which only those go unsearched that can hold nothing nearer. Vectors without any structure
    rule out few cells, so the work on them is that of all pairs.
    """
    found = first = None
    base = df.select("id", "vec").where(F.col("vec").isNotNull())
    asked = queries.select("id", "vec").where(F.col("vec").isNotNull())
    for t in range(tables):
        start = np.array([r["vec"] for r in base.orderBy(F.xxhash64("id", F.lit(t))).limit(cells).collect()], np.float64)
        c = lloyd(base, start, 2)
        a = nearest_word(base, c).select(F.col("word"), F.col("id"), F.col("vec"))
        b = nearest_word(asked, c).select(F.col("word"), F.col("id").alias("qid"), F.col("vec").alias("qvec"))
        part = _squares(b.join(a, "word"))
        found = part if found is None else found.unionByName(part)
        first = (c, a, b) if first is None else first
    best = Window.partitionBy("qid").orderBy("dist", "id")
    found = checkpoint(found.groupBy("qid", "id").agg(F.min("dist").alias("dist")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
    c, a, b = first
    radius = np.full(len(c), -1.0)
    at = F.pandas_udf(lambda word, vec: pd.Series([float(((np.asarray(v, np.float64) - c[w]) ** 2).sum()) for w, v in zip(word, vec)], dtype="float64"), "double")
    for r in a.select("word", at("word", "vec").alias("x")).groupBy("word").agg(F.max("x").alias("x")).collect():
        radius[r["word"]] = np.sqrt(r["x"])
    reach = found.where(F.col("rank") == k).select("qid", F.sqrt("dist").alias("reach"))
    open_ = _open_cells(b.join(reach, "qid", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf")))), c, radius)
    rest = _squares(open_.select("qid", "qvec", F.explode("also").alias("word")).join(a, "word"))
    merged = found.drop("rank").unionByName(rest).groupBy("qid", "id").agg(F.min("dist").alias("dist"))
    return merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
