"""The queries of the two general problems; those of the text problems are in the subpackage ``llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quoin.operators import nested, regions
from quoin.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.children(table(spark, sf_dir, "details"), table(spark, sf_dir, "raw_details"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.pairs_within(table(spark, sf_dir, "leoh"), "rec_id", "leo_id", 0.25).toDF("rec_a", "rec_b")


QUERIES = {"p2_found": p2_found, "p6_found": p6_found}

# No SQL for p2_found: the bodies of raw_details change their shape, which SQL can't follow.
ORACLE: dict[str, str] = {
    "p6_found": """
with p as (select rec_id, leo_id, lat, lng, cast(floor(lat / 0.02) as bigint) as s from leoh
  where lat is not null and lng is not null and not isnan(lat) and not isnan(lng) and abs(lat) < 90 and abs(lng) <= 180 and not (lat = 0 and lng = 0)),
n as (select a.rec_id as x, b.rec_id as y, a.lat as lat_a, a.lng as lng_a, b.lat as lat_b, b.lng as lng_b from p a
  join (select *, unnest([s - 1, s, s + 1]) as t from p) b on a.s = b.t where a.rec_id < b.rec_id and a.leo_id is distinct from b.leo_id)
select x as rec_a, y as rec_b from n
where 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(lat_b - lat_a) / 2), 2) + cos(radians(lat_a)) * cos(radians(lat_b)) * pow(sin(radians(lng_b - lng_a) / 2), 2)))) <= 0.25
""",
}
