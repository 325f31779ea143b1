"""Mixing sources to target weights of tokens, with a cap on repeats, into shards of the same mixture.

For each plan the weights of the sources that are present are scaled to 1. The size of the mix is the largest at
which no source has to repeat beyond its cap (a null cap gives none); if no source has a cap, it is the tokens of
all its sources once. A source's quota is its share of that size: so many whole passes over the source, and a
part of one more.

The documents of a source fall into blocks by a hash of their id. Which block goes to which output shard is drawn
by a splitting tree: at each node the number of blocks of each source that go left is multivariate hypergeometric,
given how many go to the left in all, down to single shards; so every shard gets a random but exact part of every
source's blocks, and no block comes twice in a pass. As many whole passes as there are shards, or a multiple of it,
go one to each shard; only what is left over is drawn. So the tree handles less than shards + 1 passes of BLOCKS
blocks, and the plan has a row for a source's block and shard, with the number of copies: at most
BLOCKS * (SHARDS + 1) rows per source and plan, however often a source repeats and whatever the size of the corpus.
Within a shard documents have random places to be sorted by, so no shard is gathered into one task here.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quoin.llm import tokenizing
from quoin.session import checkpoint

BLOCKS, SHARDS, SEED = 1024, 16, 11

#: Rows of a plan up to which it is handed to every executor.
BROADCAST_ROWS = 500_000

BLOCK_ROW = "mix_plan string, source string, block int, shard int, first int, copies int, cut long"
SHARE_ROW = "mix_plan string, source string, weight double, target_share double, max_repeats int, source_tokens long, quota_tokens long"


class Mix(NamedTuple):
    selection: DataFrame
    shares: DataFrame


def split_tree(blocks: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Counts (shards x sources): how many of each source's blocks go to each shard.

    Shards differ by at most one block in all; rows add up to ``blocks``.
    """
    if shards == 1:
        return blocks[None, :]
    left = shards // 2
    total = int(blocks.sum())
    goes = total * left // shards
    if total % shards and rng.random() < 0.5:
        goes = -(-total * left // shards)
    part = rng.multivariate_hypergeometric(blocks, goes, method="marginals") if total else blocks * 0
    return np.vstack([split_tree(part, left, rng), split_tree(blocks - part, shards - left, rng)])


def quotas(weights: dict[str, tuple[float, int | None]], tokens: dict[str, int]) -> dict[str, int]:
    """Tokens to draw of each present source of a plan: weights are (weight, cap)."""
    here = {s: (w, cap) for s, (w, cap) in weights.items() if tokens.get(s, 0) > 0 and w and w > 0 and math.isfinite(w) and (cap is None or cap > 0)}
    total = sum(w for w, _ in here.values())
    if not total:
        return {}
    sizes = [cap * tokens[s] * total / w for s, (w, cap) in here.items() if cap is not None]
    size = min(sizes) if sizes else float(sum(tokens[s] for s in here))
    return {s: int(round(size * w / total)) for s, (w, _) in here.items()}


def plan_blocks(plan: str, want: dict[str, int], sums: dict[str, dict[int, int]], shards: int, seed: int) -> list[tuple]:
    """(plan, source, block, shard, first, copies, cut): copies of a block, in the passes from ``first`` on; cut is the tokens to take of it, null for all."""
    rng = np.random.default_rng([seed, *plan.encode()])
    out: list[tuple] = []
    left: dict[str, tuple[np.ndarray, int, list]] = {}
    for s in sorted(want):
        blocks = rng.permutation(sorted(sums[s]))
        passes, rest = divmod(want[s], sum(sums[s].values()))
        each, over = divmod(passes, shards)
        if each:
            out += [(plan, s, int(b), k, k * each, each, None) for b in blocks for k in range(shards)]
        last = []
        for b in rng.permutation(blocks):
            if rest <= 0:
                break
            n = sums[s][int(b)]
            last.append((int(b), None if n <= rest else rest))
            rest -= min(n, rest)
        left[s] = (blocks, over, last)
    names = sorted(left)
    counts = np.array([len(left[s][0]) * left[s][1] + len(left[s][2]) for s in names], np.int64)
    tree = split_tree(counts, shards, rng) if names else np.zeros((shards, 0), int)
    for j, s in enumerate(names):
        blocks, over, last = left[s]
        done = want[s] // sum(sums[s].values()) - over
        drawn = [(int(b), done + p, None) for p in range(over) for b in blocks] + [(b, done + over, cut) for b, cut in last]
        shard = np.repeat(np.arange(shards), tree[:, j])
        out += [(plan, s, drawn[k][0], int(shard[at]), drawn[k][1], 1, drawn[k][2]) for at, k in enumerate(rng.permutation(len(drawn)))]
    return out


def mix(docs: DataFrame, targets: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS, seed: int = SEED, tokenizer: str = "byte_bpe_50k", folder: str = tokenizing.TOKENIZER_DIR) -> Mix:
    """docs(doc_id, source, text), targets(mix_plan, source, weight, max_repeats) -> the selection and the shares.

    selection(mix_plan, shard, place, doc_id, source, pass, n_tokens): a document comes at most once a pass, so at most
    max_repeats times; a shard is read in the order of place, a random number, then doc_id. Documents without tokens (null and empty texts) or source are
    never drawn. A source of a plan that no document has gets no tokens and its weight goes to the others in
    proportion, as does that of a source whose cap is 0 or less; sources outside a plan aren't drawn for it; null, zero and negative weights draw nothing; of a plan's
    source given twice the weights are added and the smaller cap holds. The quota of a source is met up to part of
    one document.

    shares(mix_plan, source, weight, target_share, max_repeats, source_tokens, quota_tokens, tokens, share, repeats):
    share is of the tokens drawn for the plan, repeats the most often a document of the source was drawn.
    """
    spark = docs.sparkSession
    counted = tokenizing.count_tokens(docs.select("doc_id", "source", "text").where(F.col("source").isNotNull() & (F.length("text") > 0)), name=tokenizer, folder=folder)
    block = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(blocks)).cast("int")
    counted = checkpoint(counted.where("n_tokens > 0").select("doc_id", "source", "n_tokens", block.alias("block")))
    plans = targets.where(F.col("mix_plan").isNotNull() & F.col("source").isNotNull()).groupBy("mix_plan", "source").agg(F.sum("weight").alias("weight"), F.min("max_repeats").alias("max_repeats"))
    # Bounded: sources named in the plans times blocks.
    named = counted.join(F.broadcast(plans.select("source").distinct()), "source", "left_semi")
    sums: dict[str, dict[int, int]] = {}
    for r in named.groupBy("source", "block").agg(F.sum("n_tokens").alias("n")).collect():
        sums.setdefault(r["source"], {})[r["block"]] = r["n"]
    tokens = {s: sum(b.values()) for s, b in sums.items()}
    weights: dict[str, dict] = {}
    for r in plans.collect():
        weights.setdefault(r["mix_plan"], {})[r["source"]] = (r["weight"], r["max_repeats"])
    rows, share_rows = [], []
    for plan in sorted(weights):
        want = quotas(weights[plan], tokens)
        rows += plan_blocks(plan, want, sums, shards, seed)
        total = sum(want.values())
        for s, (w, cap) in sorted(weights[plan].items()):
            share_rows.append((plan, s, w, want.get(s, 0) / total if total else 0.0, cap, tokens.get(s, 0), want.get(s, 0)))
    drawn = spark.createDataFrame(rows, BLOCK_ROW)
    plan = F.broadcast(drawn) if len(rows) <= BROADCAST_ROWS else drawn
    passes = F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)).alias("pass")
    picked = counted.join(plan, ["source", "block"]).select("doc_id", "source", "n_tokens", "block", "mix_plan", "shard", "cut", passes)
    # Only the last block of a source's last pass is cut: documents in the order of their hash until the quota is met.
    order = F.xxhash64("doc_id", "mix_plan", "pass", F.lit(seed))
    whole = picked.where(F.col("cut").isNull())
    run = Window.partitionBy("mix_plan", "source", "pass", "block").orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = picked.where(F.col("cut").isNotNull()).withColumn("sum", F.sum("n_tokens").over(run)).where(F.col("sum") - F.col("n_tokens") / 2 <= F.col("cut")).drop("sum")
    chosen = whole.unionByName(part)
    selection = chosen.select("mix_plan", "shard", order.alias("place"), "doc_id", "source", "pass", "n_tokens")
    got = chosen.groupBy("mix_plan", "source").agg(F.sum("n_tokens").alias("tokens"), (F.max("pass") + 1).alias("repeats"))
    shares = F.broadcast(spark.createDataFrame(share_rows, SHARE_ROW)).join(got, ["mix_plan", "source"], "left").na.fill(0, ["tokens", "repeats"])
    share = F.coalesce(F.try_divide(F.col("tokens"), F.sum("tokens").over(Window.partitionBy("mix_plan"))), F.lit(0.0))
    return Mix(selection, shares.withColumn("share", share))
