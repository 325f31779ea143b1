"""Vector and code search: exact k-NN, Hamming joins, inverted lists, votes."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quoin.session import prepare

#: Queries held by a task at a time.
BLOCK = 2048
#: Items whose votes a task counts at a time.
ITEMS = 8192
#: Codes compared in blocks in the time a row takes in an index join.
COMPARED = 50


def _distances(kind: str, q: np.ndarray, b: np.ndarray) -> np.ndarray:
    if kind == "l2sq":
        return np.maximum((q * q).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * q @ b.T, 0)
    if kind == "cosine":
        return 1 - (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
    if kind == "dot":
        return -(q @ b.T)
    out = np.empty((len(q), len(b)))
    for i, x in enumerate(q):
        out[i] = np.abs(x - b).sum(1) if kind == "l1" else 0.5 * ((x - b) ** 2 / (x + b + 1e-10)).sum(1)
    return out


def _block_pairs(base: DataFrame, queries: DataFrame, columns: list[str], key: str | None = None) -> tuple[DataFrame, list[str]]:
    """(rows, group): rows (item, *columns, x, y) of both sides so that each pair of a block of ITEMS base rows and one of BLOCK queries is a group.

    With ``key`` only rows of equal key meet, and a key of very many rows has blocks of its own. Nothing is gathered
    but counts; how many blocks there are only decides how the work is cut.
    """
    place = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    if key:
        count = lambda df, size, n: df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(n))
        sizes = count(base, ITEMS, "nb").join(count(queries, BLOCK, "nq"), key)
        base, queries, nb, nq = base.join(sizes, key), queries.join(sizes, key), F.col("nb"), F.col("nq")
    else:
        nb, nq = (F.lit(max(1, -(-df.count() // size))) for df, size in ((base, ITEMS), (queries, BLOCK)))
    rows = base.withColumn("x", place(nb)).withColumn("y", every(nq)).select(F.lit(True).alias("item"), *columns, "x", "y")
    rows = rows.unionByName(queries.withColumn("y", place(nq)).withColumn("x", every(nb)).select(F.lit(False).alias("item"), *columns, "x", "y"))
    return rows, ["x", "y", *([key] if key else [])]


def knn(base: DataFrame, queries: DataFrame, k: int, kind: str = "l2sq", exclude_self: bool = False, key: str | None = None) -> DataFrame:
    """Exact k nearest base vectors of each query: (qid, id, dist, rank) from base(id, vec), queries(id, vec).

    kind: l2sq, l1, chi2, cosine or dot (negated). Base and queries are cut into blocks and each pair of blocks is a
    task's, of which only the k best of each query leave it; ties go by id. Null vectors are left out. With ``key``, a
    column of both, only rows of equal key are compared; a key of very many rows is cut into blocks of its own.
    """
    prepare(base.sparkSession)
    columns = ["id", "vec", *([key] if key else [])]
    some = lambda df: df.where(F.col("vec").isNotNull()).select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"), *([F.col(key).cast("string").alias(key)] if key else []))
    base, queries = some(base), some(queries)
    rows, group = _block_pairs(base, queries, columns, key)

    def top(pdf: pd.DataFrame) -> pd.DataFrame:
        out = {"qid": [np.empty(0, np.int64)], "id": [np.empty(0, np.int64)], "dist": [np.empty(0)]}
        held, ask = pdf[pdf["item"]], pdf[~pdf["item"]]
        if len(held) and len(ask):
            held = held.sort_values("id")
            bid, b = held["id"].to_numpy(), np.stack(held["vec"].to_numpy())
            for lo in range(0, len(ask), 256):
                qid, q = ask["id"].to_numpy()[lo : lo + 256], np.stack(ask["vec"].to_numpy()[lo : lo + 256])
                d = _distances(kind, q, b)
                if exclude_self:
                    d[qid[:, None] == bid[None, :]] = np.inf
                d[np.isnan(d)] = np.inf
                # The k best and those as good as the last of them: of equal ones the smaller ids stay.
                last = np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] > k else np.full(len(d), np.inf)
                r, c = np.nonzero((d <= last[:, None] * (1 + 1e-9) + 1e-9) & np.isfinite(d))
                if kind == "l2sq":  # the fast form above is off by rounding, which equal vectors would show
                    d[r, c] = ((q[r] - b[c]) ** 2).sum(1)
                order = np.lexsort((bid[c], d[r, c], r))
                r, c = r[order], c[order]
                rank = np.arange(len(r)) - np.searchsorted(r, r)
                r, c = r[rank < k], c[rank < k]
                for name, v in (("qid", qid[r]), ("id", bid[c]), ("dist", d[r, c])):
                    out[name].append(v)
        return pd.DataFrame({name: np.concatenate(v) for name, v in out.items()})

    best = rows.groupBy(*group).applyInPandas(top, "qid long, id long, dist double")
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("dist", "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k)


def _probes(bits: int, m: int, most: int) -> tuple[int, int]:
    """(probes of a query, bits of the narrowest block) of a search with m blocks: each within most // m bits."""
    widths = [(i + 1) * bits // m - i * bits // m for i in range(m)]
    return sum(math.comb(w, t) for w in widths for t in range(most // m + 1)), min(widths)


def _blocks_of(bits: int, most: int, rows: int) -> tuple[int, float]:
    """(blocks, cost of a query in rows joined) of the cheapest index over so many rows."""
    costs = []
    for m in range(1, min(bits, most + 1) + 1):
        probes, width = _probes(bits, m, most)
        if probes <= 4096:
            costs.append((probes * (1 + rows / 2.0**width), m))
    cost, m = min(costs)
    return m, cost


def hamming_join(a: DataFrame, b: DataFrame, most: int, bits: int = 64, index: bool | None = None) -> DataFrame:
    """(a_id, b_id, dist) of all pairs of codes at most ``most`` bits apart, from a(id, code long), b(id, code long).

    Of m blocks of two such codes one differs in at most most // m bits, so b is listed under each of its blocks and
    a looked up under all values so near to its own; a pair is kept at the first block that finds it. m is the number
    with the least work. Where even that comes near comparing all codes (a wide radius), codes are compared in blocks
    of rows, with one XOR and count a pair; the result is the same. ``index`` forces one of the two.
    """
    a, b = (df.where(F.col("code").isNotNull()).select("id", F.col("code").cast("long").alias("code")) for df in (a, b))
    rows = max(1, b.count())
    m, cost = _blocks_of(bits, most, rows)
    if index is False or (index is None and cost * COMPARED > rows):
        return _hamming_blocks(a, b, most)
    cut = [(i * bits // m, (i + 1) * bits // m) for i in range(m)]
    value = lambda lo, hi: F.shiftrightunsigned(F.col("code"), lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 64 else -1).cast("long"))
    near = [[sum(1 << i for i in c) for t in range(most // m + 1) for c in itertools.combinations(range(hi - lo), t)] for lo, hi in cut]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    masks = a.sparkSession.createDataFrame([(i, signed(x)) for i, xs in enumerate(near) for x in xs], "blk int, mask long")
    asked = a.select(F.col("id").alias("a_id"), F.col("code").alias("ca"), F.posexplode(F.array(*(value(lo, hi) for lo, hi in cut))).alias("blk", "v"))
    # At most 4096 masks, whatever the data.
    asked = asked.join(F.broadcast(masks), "blk").select("a_id", "ca", "blk", F.col("v").bitwiseXOR(F.col("mask")).alias("val"))
    listed = b.select(F.col("id").alias("b_id"), F.col("code").alias("cb"), F.posexplode(F.array(*(value(lo, hi) for lo, hi in cut))).alias("blk", "val"))
    met = asked.join(listed, ["blk", "val"]).withColumn("x", F.col("ca").bitwiseXOR(F.col("cb"))).withColumn("dist", F.bit_count("x"))
    earlier = F.lit(False)
    for i, (lo, hi) in enumerate(cut[:-1]):
        part = F.shiftrightunsigned(F.col("x"), lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long"))
        earlier = earlier | ((F.col("blk") > i) & (F.bit_count(part) <= most // m))
    return met.where((F.col("dist") <= most) & ~earlier).select("a_id", "b_id", "dist")


def _hamming_blocks(a: DataFrame, b: DataFrame, most: int, key: str | None = None) -> DataFrame:
    rows, group = _block_pairs(b, a, ["id", "code", *([key] if key else [])], key)
    kind = dict(a.dtypes)["id"]

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        held, ask = pdf[pdf["item"]], pdf[~pdf["item"]]
        bid, bc = held["id"].to_numpy(), held["code"].to_numpy(np.int64).view(np.uint64)
        aid, ac = ask["id"].to_numpy(), ask["code"].to_numpy(np.int64).view(np.uint64)
        out = [(aid[:0], bid[:0], np.empty(0, np.int32))]
        for lo in range(0, len(ask), 64):
            d = np.bitwise_count(ac[lo : lo + 64, None] ^ bc[None, :])
            r, c = np.nonzero(d <= most)
            out.append((aid[lo : lo + 64][r], bid[c], d[r, c].astype(np.int32)))
        return pd.DataFrame({n: np.concatenate(v) for n, v in zip(("a_id", "b_id", "dist"), zip(*out))})

    return rows.groupBy(*group).applyInPandas(near, f"a_id {kind}, b_id {kind}, dist int")


def hamming_self_join(a: DataFrame, most: int, bits: int = 64) -> DataFrame:
    """Pairs a_id < b_id of one table: equal codes are compared once and opened again."""
    codes = a.where(F.col("code").isNotNull()).groupBy("code").agg(F.min("id").alias("id"))
    met = hamming_join(codes, codes, most, bits).where(F.col("a_id") <= F.col("b_id"))
    lead = codes.select(F.col("code").alias("c"), F.col("id").alias("lead"))
    rows = a.select("id", F.col("code").alias("c")).join(lead, "c")
    one, two = (rows.select(F.col("lead").alias(n), F.col("id").alias(f"{n[0]}")) for n in ("a_id", "b_id"))
    both = met.join(one, "a_id").join(two, "b_id").where((F.col("a") < F.col("b")) | (F.col("a_id") != F.col("b_id"))).where(F.col("a") != F.col("b"))
    return both.select(F.least("a", "b").alias("a_id"), F.greatest("a", "b").alias("b_id"), "dist")


def ivf_cross(index: DataFrame, most: int) -> DataFrame:
    """index(key, id, code) -> (a_id, b_id, dist), a_id < b_id: pairs of one inverted list at most ``most`` bits apart."""
    index = index.where(F.col("key").isNotNull() & F.col("code").isNotNull()).select("key", "id", "code")
    return _hamming_blocks(index, index, most, "key").where(F.col("a_id") < F.col("b_id"))


def ivf_scores(hits: DataFrame, weights: DataFrame, sigma: float) -> DataFrame:
    """hits(qid, id, dist, key), weights(key, weight) -> (qid, id, score): Gaussian of the Hamming distance times the list's weight squared."""
    score = F.exp(-F.col("dist") * F.col("dist") / (sigma * sigma)) * F.col("weight") * F.col("weight")
    return hits.join(weights, "key").groupBy("qid", "id").agg(F.sum(score).alias("score"))


def verified_votes(index: DataFrame, queries: DataFrame, limit: float, kind=None) -> tuple[DataFrame, DataFrame]:
    """index(code, owner, vec), queries(code, qid, pos, vec) -> (weights, votes) of codes' hits verified by squared distance.

    weights(qid, owner, weight): of the least distances of the query's elements to an owner the three smallest,
    summed, times 3 over their number squared. votes(qid, owner, votes): elements with a hit nearer than ``limit``.
    """
    met = queries.select("code", "qid", "pos", F.col("vec").alias("qv")).join(index, "code")
    d = F.sqrt(F.aggregate(F.zip_with("qv", "vec", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    least = met.groupBy("qid", "pos", "owner").agg(F.min(d).alias("d"))
    three = F.slice(F.array_sort(F.collect_list("d")), 1, 3)
    weights = least.groupBy("qid", "owner").agg(three.alias("t")).select("qid", "owner", (F.aggregate("t", F.lit(0.0), lambda s, x: s + x) * 3 / F.pow(F.size("t"), F.lit(2))).alias("weight"))
    return weights, least.where(F.col("d") < limit).groupBy("qid", "owner").agg(F.count(F.lit(1)).alias("votes"))


def ivf_query(index: DataFrame, queries: DataFrame, most: int) -> DataFrame:
    """index(key, id, code), queries(key, qid, qcode) -> (qid, id, dist) in equal cells, at most ``most`` bits apart (inclusive)."""
    met = queries.join(index, "key").withColumn("dist", F.bit_count(F.col("code").bitwiseXOR(F.col("qcode"))))
    return met.where(F.col("dist") <= most).select("qid", "id", "dist")


def ivf_stats(index: DataFrame) -> DataFrame:
    """(cells, elements, imbalance): the imbalance is 1 if all lists are as long."""
    n = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("elements"), (F.count(F.lit(1)) * F.sum(F.col("n") * F.col("n")) / F.pow(F.sum("n"), 2)).alias("imbalance"))


def vote_join(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """index(code, id), queries(qid, code) -> (qid, id, score, rank): 1 - votes / descriptors of the query.

    Each query descriptor votes once for an item, however often the item holds its code.
    """
    size = queries.groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    per = queries.groupBy("qid", "code").agg(F.count(F.lit(1)).alias("m"))
    votes = per.join(index.select("code", "id").distinct(), "code").groupBy("qid", "id").agg(F.sum("m").alias("votes"))
    scored = votes.join(size, "qid").select("qid", "id", (1 - F.col("votes") / F.col("n")).alias("score"))
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("score", "id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def vote_blocks(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """vote_join for codes that very many items hold: index(id, codes array), queries(qid, codes array), ids in any number of rows.

    Items and queries are cut into blocks of ITEMS and BLOCK, and a task counts the votes of one pair of blocks, of
    which only the k best items of each query leave it; no pair of a query and an item is ever a row.
    """
    whole = lambda df, name: df.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("long").alias("id")).agg(F.flatten(F.collect_list("codes")).alias("codes"))
    items, asked = whole(index, "id").withColumn("codes", F.array_distinct("codes")), whole(queries, "qid")
    n_items, n_asked = (max(1, -(-df.select(c).distinct().count() // size)) for df, c, size in ((index, "id", ITEMS), (queries, "qid", BLOCK)))
    place = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = items.select(F.lit(True).alias("item"), "id", "codes", place(n_items).alias("x"), every(n_asked).alias("y"))
    rows = rows.unionByName(asked.select(F.lit(False).alias("item"), "id", "codes", place(n_asked).alias("y"), every(n_items).alias("x")))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        held, ask = pdf[pdf["item"]].sort_values("id"), pdf[~pdf["item"]]
        out = {"qid": [np.empty(0, np.int64)], "id": [np.empty(0, np.int64)], "votes": [np.empty(0, np.int64)], "n": [np.empty(0, np.int64)]}
        if len(held) and len(ask):
            ids = held["id"].to_numpy()
            sizes = held["codes"].map(len).to_numpy()
            number, codes = pd.factorize(np.concatenate(held["codes"].to_numpy()))
            order = np.argsort(number, kind="stable")
            at = np.repeat(np.arange(len(ids)), sizes)[order]
            ends = np.concatenate([[0], np.cumsum(np.bincount(number[number >= 0], minlength=len(codes)))])
            skip = int((number < 0).sum())  # nulls sort first
            known = {c: i for i, c in enumerate(codes)}
            for qid, mine in zip(ask["id"], ask["codes"]):
                lists = [at[skip + ends[i] : skip + ends[i + 1]] for c in mine if (i := known.get(c)) is not None]
                if not lists:
                    continue
                votes = np.bincount(np.concatenate(lists), minlength=len(ids))
                last = max(1, np.partition(votes, len(ids) - k)[len(ids) - k] if len(ids) > k else 1)
                top = np.flatnonzero(votes > last)
                top = np.concatenate([top, np.flatnonzero(votes == last)[: max(0, k - len(top))]]) if len(ids) > k else np.flatnonzero(votes)
                for name, v in (("qid", np.full(len(top), qid)), ("id", ids[top]), ("votes", votes[top]), ("n", np.full(len(top), len(mine)))):
                    out[name].append(v)
        return pd.DataFrame({name: np.concatenate(v) for name, v in out.items()})

    best = rows.groupBy("x", "y").applyInPandas(count, "qid long, id long, votes long, n long")
    scored = best.select("qid", "id", (1 - F.col("votes") / F.col("n")).alias("score"))
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("score", "id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def top_codes(vec, dims: int = 5):
    """Symbolic code of a vector: its largest elements' places, largest first, with a dash between."""
    ranked = F.slice(F.array_sort(F.transform(vec.cast("array<double>"), lambda x, i: F.struct((-x).alias("x"), i.alias("i")))), 1, dims)
    return F.array_join(F.transform(ranked, lambda s: s["i"].cast("string")), "-")
