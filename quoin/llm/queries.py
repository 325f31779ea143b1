"""Queries of the text problems and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quoin.llm import encoding_repair, entity_match, mixing, name_variants, nn_descent, sentences, tokenizing
from quoin.session import checkpoint, table


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, h = table(spark, sf_dir, "reviews"), table(spark, sf_dir, "leoh")
    part = lambda df, name, key, field: df.select(F.lit(name).alias("tbl"), F.col(key).alias("row_id"), F.lit(field).alias("field"), F.col(field).alias("text"))
    return part(r, "reviews", "review_id", "positive").unionByName(part(r, "reviews", "review_id", "negative")).unionByName(part(h, "leoh", "rec_id", "name"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_repair.find_damaged(_texts(spark, sf_dir), ["tbl", "row_id", "field"])[0]


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged fields with the text as it stands and as restored."""
    texts = _texts(spark, sf_dir)
    keys, model = encoding_repair.find_damaged(texts, ["tbl", "row_id", "field"])
    return encoding_repair.restore_texts(texts.join(keys, ["tbl", "row_id", "field"], "left_semi"), model)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = entity_match.match(*entity_match.tables(spark, sf_dir))
    return found.where(F.col("confidence") >= entity_match.CONFIDENT).select("leo_id", "bkg_id")


def p3_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All compared pairs near a source record's best, with their confidence."""
    return entity_match.match(*entity_match.tables(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "leoh")
    places = name_variants.link_places(h, table(spark, sf_dir, "cities")).select(F.lit("name").alias("field"), "key_a", "key_b")
    chains = name_variants.link_chains(h, table(spark, sf_dir, "chain_codes")).select(F.lit("chain").alias("field"), "key_a", "key_b")
    return places.unionByName(chains)


#: Length of room_images.features and the lowest similarity of a case.
IMAGE_DIM, IMAGE_LEAST = 96, 0.95


def _image_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = table(spark, sf_dir, "room_images").select(F.col("image_id").alias("id"), "features")
    return nn_descent.knn_graph(images, IMAGE_DIM, 5, IMAGE_LEAST)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _image_graph(spark, sf_dir)
    return g.select(F.least("id", "neighbour").alias("image_a"), F.greatest("id", "neighbour").alias("image_b")).distinct()


def image_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy search in the graph for the images whose id is divisible by 20, against all others: up to five each of similarity IMAGE_LEAST or more."""
    images = table(spark, sf_dir, "room_images").select(F.col("image_id").alias("id"), "features")
    graph = checkpoint(_image_graph(spark, sf_dir).select("id", "neighbour"))
    got = nn_descent.greedy_search(graph, images, images.where(F.col("id") % 20 == 0), IMAGE_DIM, 6)
    got = got.where((F.col("query") != F.col("id")) & (F.col("similarity") >= IMAGE_LEAST))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "id"))
    return got.withColumn("rank", rank).where(F.col("rank") <= 5)


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizing.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p8_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, table(spark, sf_dir, "mix_targets")).selection


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per plan and source: the target share, the tokens drawn and the share reached."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, table(spark, sf_dir, "mix_targets")).shares


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.split(table(spark, sf_dir, "documents"))


QUERIES = {"p1_found": p1_found, "p1_restored": p1_restored, "p3_found": p3_found, "p3_confidence": p3_confidence, "p5_found": p5_found, "p4_found": p4_found, "p7_ids": p7_ids, "p8_selection": p8_selection, "p8_shares": p8_shares, "p9_found": p9_found, "image_search": image_search}
ORACLE: dict[str, str] = {}
