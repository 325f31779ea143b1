"""Queries over the reference operators, each over whole tables, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quoin.functions import geo, text
from quoin.functions import vectors as V
from quoin.operators import cluster, fusion, images, matching, scoring, search
from quoin.operators.regions import has_position
from quoin.session import table
from quoin.streaming.windows import windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _r(c, n: int = 6):
    return F.round(c, n)


# --- positions and radius joins -------------------------------------------------------------------------------------
_SRC = "select rec_id as src_id, lat, lng, name from leoh where lat is not null and lng is not null and not isnan(lat) and not isnan(lng) and abs(lat) < 90 and abs(lng) <= 180 and not (lat = 0 and lng = 0)"
_TGT = "select bkg_id as tgt_id, lat, lng, name from bkgh where lat is not null and lng is not null"
_HAV = "2 * 6371000 * atan2(sqrt(h), sqrt(1 - h))"
_H = "least(1.0, greatest(0.0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2)))"
_NEAR = f"a as ({_SRC}), b as ({_TGT}), g as (select a.src_id, b.tgt_id, a.name as name_a, b.name as name_b, {_H} as h from a join b on abs(a.lat - b.lat) < 0.02), n as (select *, {_HAV} as dist_m from g where {_HAV} <= 1000)"


def _src(spark, d):
    h = table(spark, d, "leoh")
    return h.where(has_position(F.col("lat"), F.col("lng"))).select(F.col("rec_id").alias("src_id"), "lat", "lng", "name")


def _tgt(spark, d):
    return table(spark, d, "bkgh").where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select(F.col("bkg_id").alias("tgt_id"), "lat", "lng", "name")


@query(f"with {_NEAR} select src_id, tgt_id, round(dist_m, 3) as dist_m from n")
def geo_radius_join(spark, d):
    return matching.radius_join(_src(spark, d), _tgt(spark, d), 1.0).withColumn("dist_m", _r("dist_m", 3))


@query(f"with {_NEAR} select src_id, tgt_id, round(pow(0.5, dist_m / 50), 6) as sim from n")
def geo_sim_decay(spark, d):
    return matching.radius_join(_src(spark, d), _tgt(spark, d), 1.0).select("src_id", "tgt_id", _r(geo.dist_to_sim(F.col("dist_m"))).alias("sim"))


@query(f"with {_NEAR}, k as (select src_id, tgt_id, row_number() over (partition by src_id order by dist_m, tgt_id) as rank from n) select src_id, tgt_id, cast(rank as integer) as rank from k where rank <= 3")
def nearest_k(spark, d):
    near = matching.radius_join(_src(spark, d), _tgt(spark, d), 1.0)
    rank = F.row_number().over(Window.partitionBy("src_id").orderBy("dist_m", "tgt_id"))
    return near.withColumn("rank", rank).where("rank <= 3").select("src_id", "tgt_id", "rank")


@query("""select rec_id, round(case when lat <> floor(lat) then lat when length(cast(cast(abs(lat) as bigint) as varchar)) = 6 then lat * 10 / 1e5
 when length(cast(cast(abs(lat) as bigint) as varchar)) = 7 then lat / 1e5 when length(cast(cast(abs(lat) as bigint) as varchar)) = 8 then lat / 1e6 end, 6) as lat,
 case when lat = 90 then -90.0 else round(lat, 6) end as pole from leoh where lat is not null and not isnan(lat)""")
def coordinate_repair(spark, d):
    h = table(spark, d, "leoh").where(F.col("lat").isNotNull() & ~F.isnan("lat"))
    return h.select("rec_id", _r(geo.repair_scaled(F.col("lat"))).alias("lat"), geo.fix_pole(_r("lat")).alias("pole"))


# --- names ----------------------------------------------------------------------------------------------------------
def _sql_normalize(col: str) -> str:
    s = f"translate(translate(lower(coalesce({col}, '')), '{text.ACCENTED}', '{text.PLAIN}'), '-&/''', '    ')"
    s = f"regexp_replace({s}, '[,.:;!|_()\\[\\]<>{{}}\"]', '', 'g')"
    for a, b in text.ABBREVIATIONS.items():
        s = f"replace({s}, '{a}', '{b}')"
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in text.STOPWORDS)
    return f"array_to_string(list_filter(regexp_split_to_array(trim({s}, E' \\t'), '\\s+'), lambda t: t <> '' and not list_contains([{stop}], t)), ' ')"


@query(f"select rec_id, {_sql_normalize('name')} as norm from leoh")
def name_normalize(spark, d):
    return table(spark, d, "leoh").select("rec_id", text.normalize(F.col("name")).alias("norm"))


@query(f"select chain_code, translate(lower(chain_name), '{text.ACCENTED}', '{text.PLAIN}') as folded from chain_codes")
def accent_fold(spark, d):
    return table(spark, d, "chain_codes").select("chain_code", text.fold(F.col("chain_name")).alias("folded"))


_WORDS = f"t as (select city_id, {_sql_normalize('name')} as n from bkgh), s as (select city_id, count(*) as size from t group by city_id), w as (select city_id, w, count(*) as cnt from (select city_id, unnest(string_split(n, ' ')) as w from t) where w <> '' group by city_id, w), r as (select *, row_number() over (partition by city_id order by cnt desc, w) as k from w)"


@query(f"with {_WORDS} select r.city_id, string_agg(w, ' ' order by w) as words from r join s on r.city_id = s.city_id where k <= 20 and cnt > size // 3 group by r.city_id")
def token_freq_stopwords(spark, d):
    return matching.local_stopwords(table(spark, d, "bkgh"), "city_id", "name").select("city_id", F.array_join("words", " ").alias("words"))


@query(f"with {_NEAR}, m as (select src_id, tgt_id, replace({_sql_normalize('name_a')}, ' ', '') as x, replace({_sql_normalize('name_b')}, ' ', '') as y from n) select src_id, tgt_id, x <> '' and y <> '' and (contains(x, y) or contains(y, x)) as included from m")
def name_included(spark, d):
    near = matching.radius_join(_src(spark, d), _tgt(spark, d), 1.0)
    near = near.join(_src(spark, d).select("src_id", F.col("name").alias("a")), "src_id").join(_tgt(spark, d).select("tgt_id", F.col("name").alias("b")), "tgt_id")
    return near.select("src_id", "tgt_id", text.included(text.normalize(F.col("a")), text.normalize(F.col("b"))).alias("included"))


@query()
def candidates_with_similarity(spark, d):
    return matching.candidates(_src(spark, d), _tgt(spark, d), 1.0, 0.7, stopwords=True)


@query()
def greedy_cascade(spark, d):
    return matching.cascade(_src(spark, d).dropDuplicates(["src_id"]), _tgt(spark, d))


@query(f"with {_NEAR} select coalesce(nullif(trim(l.chain), ''), 'NONE') as a, coalesce(nullif(trim(k.chain), ''), 'NONE') as b, count(*) as cnt from n join leoh l on l.rec_id = n.src_id join bkgh k on k.bkg_id = n.tgt_id where n.dist_m <= 100 group by 1, 2")
def cooccurrence(spark, d):
    near = matching.radius_join(_src(spark, d), _tgt(spark, d), 0.1)
    near = near.join(table(spark, d, "leoh").select(F.col("rec_id").alias("src_id"), F.col("chain").alias("ca")), "src_id").join(table(spark, d, "bkgh").select(F.col("bkg_id").alias("tgt_id"), F.col("chain").alias("cb")), "tgt_id")
    return matching.cooccurrence(near, "ca", "cb")


@query("""with p as (select l.leo_id, l.bkg_id, h.chain, h.name, b.chain as chain_b, b.name as name_b from labelled_pairs l join leoh h on h.leo_id = l.leo_id join bkgh b on b.bkg_id = l.bkg_id)
 select leo_id, bkg_id, chain, chain_b from p join (select chain_name as a, chain_name as b from chain_codes) r on p.chain = r.a and p.chain_b = r.b
 where not contains(lower(coalesce(name_b, '')), lower(a)) and not contains(lower(coalesce(name, '')), lower(b))""")
def suspicious_pairs(spark, d):
    h, b = table(spark, d, "leoh").select("leo_id", "chain", "name"), table(spark, d, "bkgh").select("bkg_id", F.col("chain").alias("chain_b"), F.col("name").alias("name_b"))
    rules = table(spark, d, "chain_codes").select(F.col("chain_name").alias("a"), F.col("chain_name").alias("b"))
    return matching.suspicious(table(spark, d, "labelled_pairs").join(h, "leo_id").join(b, "bkg_id"), rules).select("leo_id", "bkg_id", "chain", "chain_b")


@query(f"with {_NEAR}, s as (select *, 1.0 / (1 + dist_m) as f from n where dist_m > 0), q as (select src_id, tgt_id, f / sum(f) over w + (1 / dist_m) / sum(1 / dist_m) over w as sc from s window w as (partition by src_id)), r as (select *, row_number() over (partition by src_id order by round(sc, 9) desc, tgt_id) as k from q) select src_id, tgt_id, round(sc, 6) as group_score, cast(k = 1 as integer) as label from r")
def group_score_best(spark, d):
    near = matching.radius_join(_src(spark, d), _tgt(spark, d), 1.0).where("dist_m > 0").withColumn("f", 1 / (1 + F.col("dist_m")))
    out = matching.best_of_group(near, "src_id", ["f"], "dist_m", "tgt_id").withColumn("s", F.round("group_score", 9))
    best = F.row_number().over(Window.partitionBy("src_id").orderBy(F.desc("s"), "tgt_id")) == 1
    return out.select("src_id", "tgt_id", _r("group_score").alias("group_score"), best.cast("int").alias("label"))


# --- relational -----------------------------------------------------------------------------------------------------
@query("select bkg_id, name from bkgh b where not exists (select 1 from labelled_pairs l where l.bkg_id = b.bkg_id)")
def anti_matched(spark, d):
    return table(spark, d, "bkgh").join(table(spark, d, "labelled_pairs"), "bkg_id", "left_anti").select("bkg_id", "name")


@query("select rec_id, leo_id from leoh where leo_id in (select leo_id from labelled_pairs)")
def semi_selected(spark, d):
    return table(spark, d, "leoh").join(table(spark, d, "labelled_pairs"), "leo_id", "left_semi").select("rec_id", "leo_id")


@query("select l.l_orderkey, l.l_linenumber, o.o_custkey, c.c_name from lineitem l left join orders o on l.l_orderkey = o.o_orderkey left join customer c on o.o_custkey = c.c_custkey")
def two_hop_lookup(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").join(o, "l_orderkey", "left").join(c, "o_custkey", "left").select("l_orderkey", "l_linenumber", "o_custkey", "c_name")


@query("select b.bkg_id, c.city_name, c.country_code from bkgh b left join cities c on b.city_id = c.city_id")
def city_lookup(spark, d):
    return table(spark, d, "bkgh").join(table(spark, d, "cities"), "city_id", "left").select("bkg_id", "city_name", "country_code")


@query("select count(distinct l.leo_id) filter (where l.label = 1) * 100.0 / (select count(distinct leo_id) from leoh) as coverage from labelled_pairs l")
def coverage(spark, d):
    hit = table(spark, d, "labelled_pairs").where("label = 1").agg(F.countDistinct("leo_id").alias("a"))
    return hit.join(F.broadcast(table(spark, d, "leoh").agg(F.countDistinct("leo_id").alias("n")))).select((F.col("a") * 100.0 / F.col("n")).alias("coverage"))


@query("select * from (select leo_id as k, 'src' as side from leoh union select cast(bkg_id as varchar), 'tgt' from bkgh) except select leo_id, 'src' from labelled_pairs")
def set_operations(spark, d):
    a = table(spark, d, "leoh").select(F.col("leo_id").alias("k"), F.lit("src").alias("side"))
    b = table(spark, d, "bkgh").select(F.col("bkg_id").cast("string"), F.lit("tgt"))
    return a.union(b).distinct().exceptAll(table(spark, d, "labelled_pairs").select("leo_id", F.lit("src")).distinct())


# --- nested documents and scores --------------------------------------------------------------------------------------
@query("""with s as (select det_id, list_transform(list_filter(rooms, lambda r: r.livingscore is not null and not isnan(r.livingscore)), lambda r: r.livingscore) as v from details where rooms is not null)
 select det_id, len(v) as n, list_min(v) as low, list_max(v) as high, round(list_sum(v) / len(v), 6) as mean from s where len(v) > 0""")
def minmaxavg_nested(spark, d):
    return scoring.room_scores(table(spark, d, "details"), "det_id").withColumn("mean", _r("mean")).withColumn("n", F.col("n").cast("long"))


@query("""with r as (select det_id, generate_subscripts(rooms, 1) - 1 as pos, unnest(rooms) as r from details where rooms is not null)
 select det_id, cast(pos as integer) as pos, r.name as name, coalesce(try_cast(nullif(regexp_extract(r.facilities, '(\\d+(?:\\.\\d+)?) *m²', 1), '') as double), 0.0) as size from r where r is not null""")
def room_sizes(spark, d):
    rooms = table(spark, d, "details").select("det_id", F.posexplode("rooms").alias("pos", "r")).where(F.col("r").isNotNull())
    return rooms.select("det_id", "pos", F.col("r.name").alias("name"), text.room_size(F.col("r.facilities")).alias("size"))


@query("""with f as (select det_id, unnest(map_keys(facilities)) as category, unnest(map_values(facilities)) as items from details where facilities is not null), i as (select det_id, category, unnest(items) as item from f)
 select category, item, count(distinct det_id) as hotels from i where item is not null group by category, item""")
def facility_counts(spark, d):
    f = table(spark, d, "details").select("det_id", F.explode("facilities").alias("category", "items"))
    return f.select("det_id", "category", F.explode("items").alias("item")).where("item is not null").groupBy("category", "item").agg(F.countDistinct("det_id").alias("hotels"))


_BLANK = "coalesce(trim({0}), '')"


@query(f"""with v as (select hotel_id, {_BLANK.format('positive')} as pos, {_BLANK.format('negative')} as neg, unnest(tags) as flag, generate_subscripts(tags, 1) - 1 as i from reviews where tags is not null),
 s as (select hotel_id, i, sum(cast(pos <> '' as integer)) as p, sum(cast(neg <> '' as integer)) as n from v where flag = 1 group by hotel_id, i)
 select hotel_id, ([{", ".join("'" + t + "'" for t in scoring.TAGS)}])[i + 1] as tag, cast(p as bigint) as p, cast(n as bigint) as n, case when p + n = 0 then 0.5 else round(p / (p + n), 6) end as score from s""")
def tag_polarity_score(spark, d):
    return scoring.tag_polarity(table(spark, d, "reviews")).withColumn("score", _r("score"))


@query(f"""with r as (select hotel_id, trim(coalesce(positive, '')) as positive, trim(coalesce(negative, '')) as negative, tags from reviews)
 select hotel_id, positive, negative, {", ".join(f"max(coalesce(tags[{i + 1}], 0)) as t{i}" for i in range(19))} from r where positive <> '' or negative <> '' group by 1, 2, 3""")
def union_dedupe_or_tags(spark, d):
    m = scoring.merge_reviews(table(spark, d, "reviews"))
    return m.select("hotel_id", "positive", "negative", *(F.get("tags", F.lit(i)).alias(f"t{i}") for i in range(19)))


@query("with c as (select user_id, event_type, count(*) as cnt from events group by 1, 2), r as (select *, rank() over (partition by user_id order by cnt desc) as k from c) select user_id, event_type, cnt from r where k = 1")
def mode_with_ties(spark, d):
    return scoring.modes(table(spark, d, "events"), "user_id", "event_type")


@query("""with v as (select p_brand, list(p_retailprice order by p_retailprice) as v from part group by p_brand), x as (select p_brand, v, len(v) as n, i, i * len(v) / 4.0 as x from v, generate_series(0, 4) t(i))
 select p_brand, cast(i as integer) as pos, round(v[least(n - 1, cast(floor(x) as integer)) + 1] + (v[least(n - 1, cast(ceil(x) as integer)) + 1] - v[least(n - 1, cast(floor(x) as integer)) + 1]) * (x - floor(x)), 4) as value from x""")
def piecewise_interp(spark, d):
    v = table(spark, d, "part").groupBy("p_brand").agg(F.collect_list("p_retailprice").alias("v"))
    return v.select("p_brand", F.posexplode(scoring.interpolate(F.col("v"), F.lit(5))).alias("pos", "value")).withColumn("value", _r("value", 4))


@query("""with t as (select unnest([0.0, 100.0, 200.0, 300.0, 400.0]) as threshold), c as (select threshold, count(*) filter (where value >= threshold and event_type = 'purchase') as tp, count(*) filter (where value >= threshold and event_type <> 'purchase') as fp,
 count(*) filter (where value < threshold and event_type = 'purchase') as fn, count(*) filter (where value < threshold and event_type <> 'purchase') as tn from events, t where value is not null and event_type is not null group by threshold)
 select cast(threshold as double) as threshold, tp, fp, fn, tn, case when tp + fp = 0 then 0.0 else round(tp / (tp + fp), 6) end as precision, case when tp + fn = 0 then 0.0 else round(tp / (tp + fn), 6) end as recall from c""")
def threshold_sweep(spark, d):
    e = table(spark, d, "events").select("value", F.when(F.col("event_type").isNotNull(), (F.col("event_type") == "purchase").cast("int")).alias("y"))
    return scoring.threshold_sweep(e, "value", "y", [0, 100, 200, 300, 400]).select("threshold", "tp", "fp", "fn", "tn", _r("precision").alias("precision"), _r("recall").alias("recall"))


@query("select user_id, count(*) filter (where event_type = 'view') as view, count(*) filter (where event_type = 'click') as click, count(*) filter (where event_type = 'purchase') as purchase from events group by user_id")
def onehot_pivot(spark, d):
    return scoring.one_hot(table(spark, d, "events"), "user_id", "event_type", ["view", "click", "purchase"])


# --- vectors ----------------------------------------------------------------------------------------------------------
_EMB = "e as (select vec_id as id, list_transform(embedding, lambda x: cast(x as double)) as v, label from embeddings)"


def _emb(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")


def _knn_sql(dist: str) -> str:
    return f"with {_EMB}, p as (select q.id as qid, b.id as id, {dist} as dist from e q join e b on q.id <> b.id where q.id % 20 = 0), r as (select *, row_number() over (partition by qid order by round(dist, 9), id) as rank from p) select qid, id, round(dist, 5) as dist, cast(rank as integer) as rank from r where rank <= 5"


def _knn(spark, d, kind):
    e = _emb(spark, d)
    got = search.knn(e, e.where(F.col("id") % 20 == 0), 8, kind, exclude_self=True).withColumn("r9", F.round("dist", 9))
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("r9", "id"))
    return got.withColumn("rank", rank).where("rank <= 5").select("qid", "id", _r("dist", 5).alias("dist"), "rank")


@query(_knn_sql("pow(list_distance(q.v, b.v), 2)"))
def knn_l2(spark, d):
    return _knn(spark, d, "l2sq")


@query(_knn_sql("1 - list_cosine_similarity(q.v, b.v)"))
def knn_cos(spark, d):
    return _knn(spark, d, "cosine")


@query(_knn_sql("list_sum(list_transform(list_zip(q.v, b.v), lambda z: abs(z[1] - z[2])))"))
def knn_l1(spark, d):
    return _knn(spark, d, "l1")


@query(f"""with {_EMB}, f as (select id, label, v, list_sum(v) as s, list_max(v) as hi, list_min(v) as lo from e)
 select id, round(s, 5) as total, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 5) as norm2, round(list_sum(list_transform(v, lambda x: abs(x))), 5) as norm1, round(greatest(abs(hi), abs(lo)), 6) as norm_max,
 cast(list_position(v, hi) - 1 as integer) as arg_max, len(list_filter(v, lambda x: x >= 0 and x < 0.1)) as inside, round(list_median(v), 6) as median from f""")
def vector_reductions(spark, d):
    v = F.col("vec")
    return _emb(spark, d).select("id", _r(V.total(v), 5).alias("total"), _r(V.norm(v), 5).alias("norm2"), _r(V.norm(v, 1), 5).alias("norm1"), _r(V.norm(v, -1)).alias("norm_max"), V.arg_max(v).alias("arg_max"), V.count_in(v, 0, 0.1).cast("long").alias("inside"), _r(V.median_of(v)).alias("median"))


_SIGN = "cast(case when bits >= 9223372036854775808 then bits - 18446744073709551616 else bits end as bigint)"
_CODES = f"{_EMB}, s as (select id, label, list_sum(list_transform(range(0, 64), lambda i: case when v[i + 1] > 0 then cast(1 as hugeint) << cast(i as integer) else 0 end)) as bits from e), c as (select id, label, {_SIGN} as code from s)"


@query(f"with {_CODES} select id, code from c")
def binary_signature(spark, d):
    return _emb(spark, d).select("id", V.sign_code(F.col("vec"), 0, 64).alias("code"))


def _codes(spark, d):
    return _emb(spark, d).select("id", "label", V.sign_code(F.col("vec"), 0, 64).alias("code"))


def _phash(spark, d):
    return table(spark, d, "room_images").where("phash IS NOT NULL").select(F.col("image_id").alias("id"), F.col("phash").alias("code"))


_PHASH = "c as (select image_id as id, phash as code from room_images where phash is not null)"


@query(f"with {_PHASH} select a.id as a_id, b.id as b_id, cast(bit_count(xor(a.code, b.code)) as integer) as dist from c a join c b on a.id < b.id where bit_count(xor(a.code, b.code)) <= 6")
def hamming_self_join(spark, d):
    return search.hamming_self_join(_phash(spark, d), 6)


@query(f"with {_PHASH} select a.id as a_id, b.id as b_id, cast(bit_count(xor(a.code, b.code)) as integer) as dist from c a join c b on a.id % 20 = 0 and a.id <> b.id where bit_count(xor(a.code, b.code)) <= 10")
def hamming_join(spark, d):
    c = _phash(spark, d)
    return search.hamming_join(c.where(F.col("id") % 20 == 0), c, 10).where("a_id <> b_id")


@query(f"with {_CODES} select q.id as a_id, b.id as b_id, cast(bit_count(xor(q.code, b.code)) as integer) as dist from c q join c b on q.id % 20 = 0 and q.id <> b.id where bit_count(xor(q.code, b.code)) <= 20")
def hamming_wide_join(spark, d):
    c = _codes(spark, d)
    return search.hamming_join(c.where(F.col("id") % 20 == 0), c, 20).where("a_id <> b_id")


@query(f"with {_CODES} select q.id as qid, b.id as id, cast(bit_count(xor(q.code, b.code)) as integer) as dist from c q join c b on q.label = b.label and q.id <> b.id where q.id % 20 = 0 and bit_count(xor(q.code, b.code)) <= 24")
def ivf_query(spark, d):
    c = _codes(spark, d).withColumnRenamed("label", "key")
    q = c.where(F.col("id") % 20 == 0).select("key", F.col("id").alias("qid"), F.col("code").alias("qcode"))
    return search.ivf_query(c, q, 24).where("id <> qid")


@query(f"with {_CODES} select a.id as a_id, b.id as b_id, cast(bit_count(xor(a.code, b.code)) as integer) as dist from c a join c b on a.label = b.label and a.id < b.id where bit_count(xor(a.code, b.code)) <= 20")
def ivf_cross_match(spark, d):
    return search.ivf_cross(_codes(spark, d).withColumnRenamed("label", "key"), 20)


@query(f"""with {_CODES}, w as (select label, ln((select count(*) from c) / count(*)) as weight from c group by label), h as (select q.id as qid, b.id as id, q.label, cast(bit_count(xor(q.code, b.code)) as double) as dist from c q join c b on q.label = b.label and q.id <> b.id where q.id % 20 = 0)
 select qid, id, round(exp(-dist * dist / 256.0) * weight * weight, 6) as score from h join w on h.label = w.label where dist <= 24""")
def ivf_score_map(spark, d):
    c = _codes(spark, d).withColumnRenamed("label", "key")
    q = c.where(F.col("id") % 20 == 0).select("key", F.col("id").alias("qid"), F.col("code").alias("qcode"))
    hits = search.ivf_query(c, q, 24).where("id <> qid").join(c.select("id", "key"), "id")
    total = c.count()
    weights = c.groupBy("key").agg(F.log(F.lit(float(total)) / F.count(F.lit(1))).alias("weight"))
    return search.ivf_scores(hits, weights, 16.0).withColumn("score", _r("score"))


@query("with n as (select label, count(*) as n from embeddings group by label) select count(*) as cells, cast(sum(n) as bigint) as elements, round(count(*) * sum(n * n) / pow(sum(n), 2), 6) as imbalance from n")
def ivf_imbalance(spark, d):
    return search.ivf_stats(_codes(spark, d).withColumnRenamed("label", "key")).withColumn("imbalance", _r("imbalance"))


@query("""with w as (select distinct doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) as code from documents where lang = 'en' and text is not null), i as (select * from w where length(code) > 9),
 q as (select doc_id as qid, code from i where doc_id % 20 = 0), s as (select qid, count(*) as n from q group by qid), v as (select q.qid, i.doc_id as id, count(*) as votes from q join i on q.code = i.code group by 1, 2),
 r as (select v.qid, v.id, round(1 - votes / n, 6) as score, row_number() over (partition by v.qid order by 1 - votes / n, v.id) as rank from v join s on s.qid = v.qid) select qid, id, score, cast(rank as integer) as rank from r where rank <= 5""")
def lsh_vote(spark, d):
    words = table(spark, d, "documents").where("lang = 'en' AND text IS NOT NULL").select(F.col("doc_id").alias("id"), F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("code")).where("length(code) > 9")
    return search.vote_join(words, words.where(F.col("id") % 20 == 0).select(F.col("id").alias("qid"), "code")).withColumn("score", _r("score"))


@query("""with w as (select distinct doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}]+')) as code from documents where text is not null), i as (select * from w where code <> ''),
 q as (select doc_id as qid, code from i where doc_id % 20 = 0), s as (select qid, count(*) as n from q group by qid), v as (select q.qid, i.doc_id as id, count(*) as votes from q join i on q.code = i.code group by 1, 2),
 r as (select v.qid, v.id, round(1 - votes / n, 6) as score, row_number() over (partition by v.qid order by 1 - votes / n, v.id) as rank from v join s on s.qid = v.qid) select qid, id, score, cast(rank as integer) as rank from r where rank <= 5""")
def lsh_vote_all(spark, d):
    """The vote join over all documents and all their words, in whatever language, the common ones included."""
    words = F.array_distinct(F.array_remove(F.split(F.lower("text"), r"[^\p{L}\p{M}\p{N}]+"), ""))
    docs = table(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("id"), words.alias("codes"))
    return search.vote_blocks(docs, docs.where(F.col("id") % 20 == 0).select(F.col("id").alias("qid"), "codes")).withColumn("score", _r("score"))


_LISTS = f"{_EMB}, p as (select q.id as qid, b.id as id, list_distance(q.v, b.v) as d1, 1 - list_cosine_similarity(q.v, b.v) as d2 from e q join e b on q.id <> b.id where q.id % 20 = 0), l as (select qid, 'l2' as list_id, id, d1 as d from (select *, row_number() over (partition by qid order by round(d1, 9), id) as k from p) where k <= 20 union all select qid, 'cos', id, d2 from (select *, row_number() over (partition by qid order by round(d2, 9), id) as k from p) where k <= 20), w as (select qid, list_id, id, d * case list_id when 'l2' then 0.4 else 0.6 end as d from l)"


def _lists(spark, d):
    e = _emb(spark, d)
    q = e.where(F.col("id") % 20 == 0)
    top = lambda kind, name, f: search.knn(e, q, 24, kind, exclude_self=True).withColumn("dist", f(F.col("dist"))).withColumn("k", F.row_number().over(Window.partitionBy("qid").orderBy(F.round("dist", 9), "id"))).where("k <= 20").select("qid", F.lit(name).alias("list_id"), "id", "dist")
    return top("l2sq", "l2", F.sqrt).unionByName(top("cosine", "cos", lambda c: c))


@query(f"with {_LISTS}, s as (select qid, id, min(d) as score from w group by qid, id), r as (select *, row_number() over (partition by qid order by round(score, 9), id) as rank from s) select qid, id, round(score, 5) as score from r where rank <= 5")
def blend_fusion(spark, d):
    got = fusion.blending(_lists(spark, d), {"l2": 0.4, "cos": 0.6}, 8).withColumn("k", F.row_number().over(Window.partitionBy("qid").orderBy(F.round("score", 9), "id")))
    return got.where("k <= 5").select("qid", "id", _r("score", 5).alias("score"))


@query(f"with {_LISTS}, f as (select qid, list_id, list_reduce(list_prepend(0.0, list(d order by d)), lambda a, x: case when x > a then 1.5 * x else a end) as def from w group by qid, list_id), o as (select w.qid, w.id, sum(w.d - f.def) as diff from w join f on w.qid = f.qid and w.list_id = f.list_id group by w.qid, w.id), t as (select qid, sum(def) as tot from f group by qid), s as (select o.qid, o.id, o.diff + t.tot as score from o join t on o.qid = t.qid), r as (select *, row_number() over (partition by qid order by round(score, 9), id) as rank from s) select qid, id, round(score, 5) as score from r where rank <= 5")
def ensemble_fusion(spark, d):
    got = fusion.ensembling(_lists(spark, d), {"l2": 0.4, "cos": 0.6}, 8).withColumn("k", F.row_number().over(Window.partitionBy("qid").orderBy(F.round("score", 9), "id")))
    return got.where("k <= 5").select("qid", "id", _r("score", 5).alias("score"))


_CELLS = f"{_EMB}, c as (select row_number() over (order by id) - 1 as word, v as c from (select * from e order by id limit 8)), a as (select e.id, e.label, e.v, (select word from c order by round(list_distance(e.v, c.c), 9), word limit 1) as word from e)"


def _cells(spark, d):
    e = _emb(spark, d)
    c = cluster.first_vectors(e, 8)
    return cluster.nearest_word(e, c), c


@query(f"with {_CELLS}, n as (select label, word, count(*) as n from a group by label, word) select label, cast(word as integer) as word, n, round(n / sum(n) over (partition by label), 6) as share from n")
def bof(spark, d):
    return cluster.bag_of_words(_cells(spark, d)[0], "label").withColumn("share", _r("share"))


@query(f"with {_CELLS} select cast(word as integer) as word, round(ln((select count(*) from a) / (count(*) + pow(2.0, -23))), 6) as idf from a group by word")
def bow_idf(spark, d):
    return cluster.idf(_cells(spark, d)[0]).withColumn("idf", _r("idf"))


@query(f"with {_CELLS}, x as (select a.label, a.word, unnest(a.v) as x, unnest(c.c) as c, generate_subscripts(a.v, 1) - 1 as dim from a join c on c.word = a.word) select label, cast(word as integer) as word, cast(dim as integer) as dim, round(sum(x - c), 4) as value from x group by 1, 2, 3")
def vlad(spark, d):
    a, c = _cells(spark, d)
    return cluster.vlad(a, "label", c).withColumn("value", F.round("value", 4) + 0.0)


@query(f"with {_CELLS}, x as (select word, unnest(v) as x, generate_subscripts(v, 1) - 1 as dim from a) select cast(word as integer) as word, cast(dim as integer) as dim, round(avg(x), 5) as value from x group by 1, 2")
def lloyd_step(spark, d):
    return cluster.cell_means(_cells(spark, d)[0]).withColumn("value", F.round("value", 5) + 0.0)


@query(f"with {_EMB}, x as (select id, unnest(v) as x, generate_subscripts(v, 1) - 1 as i from e) select cast(a.i as integer) as i, cast(b.i as integer) as j, round(covar_pop(a.x, b.x), 6) as cov from x a join x b on a.id = b.id and a.i <= b.i group by 1, 2")
def pca_cov(spark, d):
    return cluster.covariance(_emb(spark, d)).withColumn("cov", F.round("cov", 6) + 0.0)


@query(f"with {_EMB}, m as (select id, v, list_sum(v) / 64 as mean from e) select id, cast(case when bits >= 9223372036854775808 then bits - 18446744073709551616 else bits end as bigint) as hash from (select id, list_sum(list_transform(range(0, 64), lambda i: case when v[i + 1] >= mean then cast(1 as hugeint) << cast(i as integer) else 0 end)) as bits from m)")
def hash_average(spark, d):
    return _emb(spark, d).select("id", images.average_hash(F.col("vec")).alias("hash"))


@query(f"with {_EMB}, p as (select q.id as qid, b.id as id, cast(q.label = b.label as integer) as relevant, row_number() over (partition by q.id order by round(list_distance(q.v, b.v), 9), b.id) as rank from e q join e b on q.id <> b.id where q.id % 20 = 0), k as (select *, sum(relevant) over (partition by qid order by rank) as hits from p where rank <= 20), h as (select *, case when rank = 1 then 1.0 else (hits - 1) / (rank - 1) end as prev from k where relevant = 1) select qid, round(sum((prev + hits / rank) / 2) / count(*), 6) as ap from h group by qid")
def average_precision(spark, d):
    e = _emb(spark, d)
    lab = e.select("id", F.col("label").alias("l"))
    got = search.knn(e, e.where(F.col("id") % 20 == 0), 24, "l2sq", exclude_self=True).withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.round(F.sqrt("dist"), 9), "id"))).where("rank <= 20")
    ranked = got.join(lab, "id").join(lab.select(F.col("id").alias("qid"), F.col("l").alias("ql")), "qid").select("qid", "rank", (F.col("l") == F.col("ql")).cast("int").alias("relevant"))
    return scoring.average_precision(ranked).withColumn("ap", _r("ap"))


@query("select image_id, provider, property_id, 'r' || lpad(cast(room_idx as varchar), 2, '0') || ' - ' || room_name as room from room_images where room_idx is not null and room_name is not null")
def room_labels(spark, d):
    return table(spark, d, "room_images").where("room_idx IS NOT NULL AND room_name IS NOT NULL").select("image_id", "provider", "property_id", F.format_string("r%02d - %s", "room_idx", "room_name").alias("room"))


@query("""with i as (select * from room_images where phash is not null and property_id is not null), q as (select distinct image_id, property_id, phash from i where provider = 'bkg'), t as (select distinct image_id, property_id, phash from i where provider <> 'bkg')
 select q.image_id as qid, t.image_id as id, cast(bit_count(xor(q.phash, t.phash)) as integer) as dist from q join t on q.property_id = t.property_id where bit_count(xor(q.phash, t.phash)) <= 6""")
def duplicate_images(spark, d):
    i = table(spark, d, "room_images").where("phash IS NOT NULL AND property_id IS NOT NULL").select("image_id", "property_id", "phash", "provider")
    q = i.where("provider = 'bkg'").select(F.col("property_id").alias("key"), F.col("image_id").alias("qid"), F.col("phash").alias("qcode"))
    return search.ivf_query(i.where("provider <> 'bkg'").select(F.col("property_id").alias("key"), F.col("image_id").alias("id"), F.col("phash").alias("code")), q, 6)


@query("select date_trunc('hour', ts) as start, event_type, count(*) as n, round(sum(value), 3) as total from events group by 1, 2")
def windowed_event_counts(spark, d):
    return windowed_counts(table(spark, d, "events")).withColumn("total", _r("total", 3))


@query()
def cell_neighbours(spark, d):
    e = _emb(spark, d)
    return cluster.cell_neighbours(e, e.where(F.col("id") % 20 == 0), 5)


@query()
def mixture_components(spark, d):
    w, mu, sigma = cluster.fit_mixture(_emb(spark, d), 4, 5)
    return spark.createDataFrame([(i, float(w[i]), [float(x) for x in mu[i]]) for i in range(len(w))], "component int, weight double, mean array<double>")


@query()
def classified_matches(spark, d):
    from quoin.plans.models import classified_matches as run

    return run(spark, d)
