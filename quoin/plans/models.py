"""Trained models on top of the operators: match classifier, tag model, room clusters."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import CountVectorizer, IDF, OneHotEncoder, RegexTokenizer, StandardScaler, StopWordsRemover, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoin.functions import text
from quoin.operators import matching
from quoin.operators.regions import has_position
from quoin.session import checkpoint, spread, table

FEATURES = ["name_sim", "name_sim_sw", "dist_m", "included"]


def features(cands: DataFrame, src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Candidates with containment of names and the chains of both, none for missing and blank ones."""
    a = src.select("src_id", F.col("name").alias("na"), F.coalesce(F.nullif(F.trim("chain"), F.lit("")), F.lit("none")).alias("chain_a"))
    b = tgt.select("tgt_id", F.col("name").alias("nb"), F.coalesce(F.nullif(F.trim("chain"), F.lit("")), F.lit("none")).alias("chain_b"))
    got = cands.join(a, "src_id").join(b, "tgt_id")
    return got.withColumn("included", text.included(text.normalize(F.col("na")), text.normalize(F.col("nb"))).cast("double")).drop("na", "nb")


def match_classifier(labelled: DataFrame, seed: int = 42) -> PipelineModel:
    """Random forest on FEATURES and the chains (one-hot, unseen ones kept apart), classes weighted to balance."""
    share = labelled.agg(F.avg("label")).first()[0] or 0.5
    weighted = labelled.withColumn("weight", F.when(F.col("label") == 1, 1 - share).otherwise(share))
    chains = ["chain_a", "chain_b"]
    steps = [StringIndexer(inputCols=chains, outputCols=[f"{c}_i" for c in chains], handleInvalid="keep"), OneHotEncoder(inputCols=[f"{c}_i" for c in chains], outputCols=[f"{c}_v" for c in chains], handleInvalid="keep"), VectorAssembler(inputCols=[*FEATURES, *(f"{c}_v" for c in chains)], outputCol="features")]
    return Pipeline(stages=[*steps, RandomForestClassifier(labelCol="label", weightCol="weight", seed=seed, numTrees=40, maxDepth=6)]).fit(weighted)


def classified_matches(spark: SparkSession, sf_dir: str, km: float = 1.0) -> DataFrame:
    """(src_id, tgt_id, probability): candidates the classifier takes, best of each source, one to one."""
    h, b = table(spark, sf_dir, "leoh"), table(spark, sf_dir, "bkgh")
    src = h.where(has_position(F.col("lat"), F.col("lng"))).select(F.col("rec_id").alias("src_id"), "leo_id", "name", "lat", "lng", "chain")
    tgt = b.where("lat IS NOT NULL AND lng IS NOT NULL").select(F.col("bkg_id").alias("tgt_id"), "name", "lat", "lng", "chain")
    cands = checkpoint(spread(features(matching.candidates(src, tgt, km, 0.3), src, tgt)))  # read many times: by the training's steps and the scoring
    known = table(spark, sf_dir, "labelled_pairs").where("label IS NOT NULL").select("leo_id", F.col("bkg_id").alias("tgt_id"), F.col("label").cast("double").alias("label"))
    training = cands.join(src.select("src_id", "leo_id"), "src_id").join(known, ["leo_id", "tgt_id"])
    # Held in one order: the forest's samples go by partition and row.
    training = checkpoint(training.repartition("src_id", "tgt_id").sortWithinPartitions("src_id", "tgt_id"))
    if training.select("label").distinct().count() < 2:
        scored = cands.withColumn("p", F.col("name_sim"))
    else:
        scored = match_classifier(training).transform(cands).withColumn("p", vector_to_array("probability")[1])
    taken = matching.assign(scored.where("p >= 0.5").select("src_id", "tgt_id", "p"), "p")
    return taken.select("src_id", "tgt_id", F.round("p", 6).alias("probability"))


def tfidf(texts: DataFrame, column: str = "text", least: float = 0.02) -> PipelineModel:
    """Words of two letters or more without stop words; those in less than ``least`` of the texts are left out."""
    tok = RegexTokenizer(inputCol=column, outputCol="tok", pattern=r"[^\p{L}]+", minTokenLength=2)
    stop = StopWordsRemover(inputCol="tok", outputCol="words")
    return Pipeline(stages=[tok, stop, CountVectorizer(inputCol="words", outputCol="tf", minDF=least), IDF(inputCol="tf", outputCol="tfidf")]).fit(texts)


def two_clusters(df: DataFrame, columns: list[str], seed: int = 42) -> PipelineModel:
    """Two k-means clusters of standardised features."""
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="raw", handleInvalid="skip"), StandardScaler(inputCol="raw", outputCol="features", withMean=True), KMeans(k=2, seed=seed)]).fit(df)


def linkage_em(pairs: DataFrame, fields: list[str], rounds: int = 50, start: float = 0.1) -> tuple[dict, DataFrame]:
    """Fellegi-Sunter by EM: (parameters, pairs with ``match_weight`` and ``match_p``) from agreements 0/1 per field; null is disagreement.

    Pairs are counted by their pattern, of which there are at most 2^fields whatever the data, and only these counts
    come to the driver. Fields count as independent given a match or none.
    """
    import numpy as np

    bits = [F.coalesce(F.col(f).cast("int"), F.lit(0)).alias(f) for f in fields]
    seen = pairs.select(*bits).groupBy(*fields).agg(F.count(F.lit(1)).alias("n")).orderBy(*fields).collect()
    x, n = np.array([[r[f] for f in fields] for r in seen], float).reshape(-1, len(fields)), np.array([r["n"] for r in seen], float)
    share, m, u = start, np.full(len(fields), 0.9), np.full(len(fields), 0.1)
    for _ in range(rounds if len(x) else 0):
        a = share * np.prod(np.where(x == 1, m, 1 - m), 1)
        b = (1 - share) * np.prod(np.where(x == 1, u, 1 - u), 1)
        g = a / (a + b)
        w, v = g * n, (1 - g) * n
        share = float(np.clip(w.sum() / n.sum(), 1e-9, 1 - 1e-9))
        m, u = (np.clip((k[:, None] * x).sum(0) / max(k.sum(), 1e-12), 1e-6, 1 - 1e-6) for k in (w, v))
    weight = F.lit(float(np.log(share / (1 - share))))
    for f, bit, mi, ui in zip(fields, bits, m, u):
        weight = weight + F.when(bit == 1, float(np.log(mi / ui))).otherwise(float(np.log((1 - mi) / (1 - ui))))
    scored = pairs.withColumn("match_weight", weight).withColumn("match_p", 1 / (1 + F.exp(-F.col("match_weight"))))
    return {"share": share, "m": dict(zip(fields, m.tolist())), "u": dict(zip(fields, u.tolist()))}, scored


def linked_by_em(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src_id, tgt_id, match_p): pairs within 1 km with the probability the four agreements give."""
    h, b = table(spark, sf_dir, "leoh"), table(spark, sf_dir, "bkgh")
    src = h.where(has_position(F.col("lat"), F.col("lng"))).select(F.col("rec_id").alias("src_id"), "name", "lat", "lng", "chain")
    tgt = b.where("lat IS NOT NULL AND lng IS NOT NULL").select(F.col("bkg_id").alias("tgt_id"), "name", "lat", "lng", "chain")
    near = matching.radius_join(src, tgt, 1.0).join(src.select("src_id", F.col("name").alias("x"), F.col("chain").alias("cx")), "src_id").join(tgt.select("tgt_id", F.col("name").alias("y"), F.col("chain").alias("cy")), "tgt_id")
    x, y = (F.split(text.normalize(F.col(c)), " ") for c in "xy")
    agree = {"near": F.col("dist_m") <= 150, "word": F.arrays_overlap(F.filter(x, lambda t: t != ""), F.filter(y, lambda t: t != "")), "first": x[0] == y[0], "chain": F.lower("cx") == F.lower("cy")}
    return linkage_em(near.select("src_id", "tgt_id", *(c.cast("int").alias(k) for k, c in agree.items())), list(agree))[1].select("src_id", "tgt_id", F.round("match_p", 6).alias("match_p"))


def forest_importances(df: DataFrame, columns: list[str], label: str, seed: int = 42) -> dict[str, float]:
    """Share of each column in the splits of a random forest for the label; rows with a null are left out."""
    rows = VectorAssembler(inputCols=columns, outputCol="features").transform(df.na.drop(subset=[*columns, label]))
    return dict(zip(columns, RandomForestClassifier(labelCol=label, seed=seed, numTrees=20, maxDepth=5).fit(rows).featureImportances.toArray().tolist()))


def tag_models(texts: DataFrame, tags: int, text_column: str = "text", tag_column: str = "tags", seed: int = 42) -> dict[int, PipelineModel]:
    """A forest on TF-IDF for each tag that some but not all texts have; the words are fitted once."""
    from pyspark.ml.classification import RandomForestClassifier as Forest

    known = texts.where(F.col(text_column).isNotNull() & F.col(tag_column).isNotNull())
    words = tfidf(known, text_column)
    rows = words.transform(known)
    counts = rows.agg(F.count(F.lit(1)).alias("all"), *(F.count_if(F.get(tag_column, F.lit(i)) == 1).alias(f"t{i}") for i in range(tags))).first()
    out = {}
    for i in range(tags):
        if 0 < counts[f"t{i}"] < counts["all"]:
            forest = Forest(featuresCol="tfidf", labelCol="y", predictionCol=f"tag_{i}", rawPredictionCol=f"raw_{i}", probabilityCol=f"p_{i}", seed=seed, numTrees=10, maxDepth=4)
            out[i] = PipelineModel([words, forest.fit(rows.withColumn("y", (F.coalesce(F.get(tag_column, F.lit(i)), F.lit(0)) == 1).cast("double")))])
    return out
