"""Queries of the matching, photo and room pipelines and of the vector tail, each over whole tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quoin.functions import geo, text
from quoin.functions import vectors as V
from quoin.operators import matching, records, rooms, scoring, search
from quoin.operators.regions import has_position, points_in_regions
from quoin.plans.catalog import _EMB, _NEAR, _emb, _r, _src, _tgt
from quoin.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# --- sources and records ----------------------------------------------------------------------------------------------
@query("select distinct substr(l.chain, 1, 2) as prefix, c.chain_name from leoh l join chain_codes c on substr(upper(l.chain), 1, 2) = c.chain_code where c.chain_code <> 'PM'")
def chain_prefixes(spark, d):
    codes = table(spark, d, "chain_codes").where("chain_code <> 'PM'").select(F.col("chain_code").alias("up"), "chain_name")
    return table(spark, d, "leoh").select(F.substring("chain", 1, 2).alias("prefix")).distinct().withColumn("up", F.upper("prefix")).join(codes, "up").select("prefix", "chain_name")


_DIGITS = "length(cast(cast(abs({0}) as bigint) as varchar))"
_REPAIR = "case when {0} <> floor({0}) then {0} when " + _DIGITS + " = 6 then {0} * 10 / 1e5 when " + _DIGITS + " = 7 then {0} / 1e5 when " + _DIGITS + " = 8 then {0} / 1e6 end"


@query(f"select leo_id as src_id, name, chain, round({_REPAIR.format('lat')}, 6) as lat, round({_REPAIR.format('lng')}, 6) as lng from leoh where lat is not null and lng is not null and not isnan(lat) and not isnan(lng)")
def sheet_scan(spark, d):
    h = table(spark, d, "leoh").where(F.col("lat").isNotNull() & F.col("lng").isNotNull() & ~F.isnan("lat") & ~F.isnan("lng"))
    return h.select(F.col("leo_id").alias("src_id"), "name", "chain", _r(geo.repair_scaled(F.col("lat"))).alias("lat"), _r(geo.repair_scaled(F.col("lng"))).alias("lng"))


@query("select det_id, title, type from details where type = 'Hotel' or type like '%ostel%' or title is null order by det_id limit 1100")
def or_limit_scan(spark, d):
    return table(spark, d, "details").where("type = 'Hotel' OR type LIKE '%ostel%' OR title IS NULL").select("det_id", "title", "type").orderBy("det_id").limit(1100)


@query("select r.image_id, r.path, b.bkg_id, c.city_name from room_images r join bkgh b on r.property_id = cast(b.bkg_id as varchar) join cities c on b.city_id = c.city_id where r.provider = 'bkg'")
def photo_join(spark, d):
    b = table(spark, d, "bkgh").select("bkg_id", "city_id", F.col("bkg_id").cast("string").alias("property_id"))
    r = table(spark, d, "room_images").where("provider = 'bkg'").select("image_id", "path", "property_id")
    return r.join(b, "property_id").join(table(spark, d, "cities"), "city_id").select("image_id", "path", "bkg_id", "city_name")


@query("select d.det_id, b.bkg_id, cast(d.pos as integer) as pos, d.r.name as room from (select det_id, hotel_id, unnest(rooms) as r, generate_subscripts(rooms, 1) - 1 as pos from details where rooms is not null) d join bkgh b on d.hotel_id = cast(b.bkg_id as varchar) where d.r.name is not null")
def property_rooms(spark, d):
    r = table(spark, d, "details").select("det_id", "hotel_id", F.posexplode("rooms").alias("pos", "r")).where(F.col("r.name").isNotNull())
    b = table(spark, d, "bkgh").select("bkg_id", F.col("bkg_id").cast("string").alias("hotel_id"))
    return r.join(b, "hotel_id").select("det_id", "bkg_id", "pos", F.col("r.name").alias("room"))


@query("select leo_id, cast(to_json({'leo_id': leo_id, 'bkg_id': bkg_id, 'label': label}) as varchar) as line from labelled_pairs where label is not null")
def json_lines(spark, d):
    return table(spark, d, "labelled_pairs").where("label IS NOT NULL").select("leo_id", F.to_json(F.struct("leo_id", "bkg_id", "label")).alias("line"))


@query("select det_id, case when coalesce(len(list_filter(rooms, lambda r: r.livingscore is not null)), 0) > 0 then 'scored' else 'unscored' end as part from details")
def score_split(spark, d):
    return table(spark, d, "details").select("det_id", F.when(F.coalesce(F.size(F.filter("rooms", lambda r: r["livingscore"].isNotNull())), F.lit(0)) > 0, "scored").otherwise("unscored").alias("part"))


@query("""with f as (select det_id, unnest(map_keys(facilities)) as category, unnest(map_values(facilities)) as items from details where facilities is not null),
 k as (select det_id, category, list_filter(items, lambda x: x is not null and trim(x) <> '') as items from f) select det_id, category, cast(len(items) as integer) as n from k where len(items) > 0""")
def pruned_nodes(spark, d):
    return table(spark, d, "details").select("det_id", F.explode(records.prune(F.col("facilities"))).alias("category", "items")).select("det_id", "category", F.size("items").alias("n"))


_HAS = "cast(len(list_filter(v, lambda x: contains(x, '{0}'))) > 0 as integer)"
_EITHER = "cast(len(list_filter(v, lambda x: contains(x, '{0}') or contains(x, '{1}'))) > 0 as integer)"


@query(f"""with f as (select det_id, unnest(map_keys(facilities)) as c, unnest(map_values(facilities)) as v from details where facilities is not null),
 i as (select det_id, {_HAS.format('Free')} as free_internet, {_EITHER.format('WiFi', 'Wireless')} as wifi, {_EITHER.format('and costs', 'paid')} as paid_internet from f where c = 'internet'),
 p as (select det_id, {_HAS.format('Free')} as free_parking, {_HAS.format('Private parking is possible')} as private_parking, {_HAS.format('Public parking is possible')} as public_parking,
 {_HAS.format('reservation is not needed')} as parking_reservation_not_needed, {_HAS.format('reservation is needed')} as parking_reservation_needed, {_HAS.format('reservation is not possible')} as parking_reservation_not_possible, {_HAS.format('and costs')} as paid_parking from f where c = 'parking')
 select d.det_id, {", ".join(f"coalesce({x}, 0) as {x}" for x in ("free_internet", "wifi", "paid_internet", "free_parking", "private_parking", "public_parking", "parking_reservation_not_needed", "parking_reservation_needed", "parking_reservation_not_possible", "paid_parking"))}
 from details d left join i on d.det_id = i.det_id left join p on d.det_id = p.det_id""")
def facility_flags(spark, d):
    return records.facility_flags(table(spark, d, "details"), "det_id")


@query("select det_id, coalesce(type, 'none') as type, coalesce(len(map_keys(facilities)), 0) as n_categories, coalesce(len(rooms), 0) as n_rooms, coalesce(try_cast(nullif(regexp_extract(number_of_rooms, '([0-9]+)', 1), '') as integer), -1) as rooms_named from details")
def hotel_records(spark, d):
    return records.hotel_records(table(spark, d, "details")).na.fill(-1, ["rooms_named"])


@query("""with r as (select det_id, unnest(rooms) as r, generate_subscripts(rooms, 1) - 1 as pos from details where rooms is not null)
 select det_id, cast(pos as integer) as pos, coalesce(try_cast(nullif(regexp_extract(r.facilities, '(\\d+(?:\\.\\d+)?) *m²', 1), '') as double), 0.0) as size, coalesce(len(r.gallery), 0) as images, r.livingscore as label from r where r is not null and r.livingscore is not null""")
def room_records(spark, d):
    return records.room_records(table(spark, d, "details"))


@query("select det_id, array_to_string(list_filter(flatten(map_values(facilities)), lambda x: x is not null), '|') as items from details where facilities is not null")
def concatenated_lists(spark, d):
    return table(spark, d, "details").where("facilities IS NOT NULL").select("det_id", F.array_join(records.concatenated(F.map_values("facilities")), "|").alias("items"))


@query("select image_id, string_split(path, '/')[2] as provider, string_split(path, '/')[3] as property, substr(string_split(path, '/')[4], 7) as room, string_split(path, '/')[5] as file from room_images where path is not null")
def path_parts(spark, d):
    part = F.split("path", "/")
    at = lambda i: F.get(part, F.lit(i))
    return table(spark, d, "room_images").where("path IS NOT NULL").select("image_id", at(1).alias("provider"), at(2).alias("property"), F.substring(at(3), 7, 1_000_000).alias("room"), at(4).alias("file"))


@query("select det_id, coalesce(try_cast(number_of_rooms as integer), -1) as rooms, lpad(cast(det_id // 60 as varchar), 2, '0') || ':' || lpad(cast(det_id % 60 as varchar), 2, '0') as clock from details")
def parsed_values(spark, d):
    return table(spark, d, "details").select("det_id", F.coalesce(F.col("number_of_rooms").try_cast("int"), F.lit(-1)).alias("rooms"), records.clock(F.col("det_id")).alias("clock"))


# --- filters, joins, sets ---------------------------------------------------------------------------------------------
@query("select doc_id, source, case when (doc_id * 7919 + 13) % 100 < 80 then 'train' else 'test' end as part from documents")
def train_test_split(spark, d):
    return table(spark, d, "documents").select("doc_id", "source", F.when(records.share_of(F.col("doc_id")) < 80, "train").otherwise("test").alias("part"))


@query("select source, count(*) as docs, cast(sum(length(text)) as bigint) as chars from documents where lower(lang) = 'en' group by source")
def language_filter(spark, d):
    return table(spark, d, "documents").where("lower(lang) = 'en'").groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length("text")).cast("long").alias("chars"))


@query(f"with {_NEAR} select src_id, tgt_id from n where name_a <> name_b and dist_m <= 200")
def different_names(spark, d):
    near = matching.radius_join(_src(spark, d), _tgt(spark, d), 0.2).join(_src(spark, d).select("src_id", F.col("name").alias("x")), "src_id").join(_tgt(spark, d).select("tgt_id", F.col("name").alias("y")), "tgt_id")
    return near.where("x <> y").select("src_id", "tgt_id")


@query(f"with {_NEAR} select n.src_id, n.tgt_id, h.leo_id from n join leoh h on h.rec_id = n.src_id where exists (select 1 from labelled_pairs p where p.leo_id = h.leo_id and p.bkg_id = n.tgt_id)")
def labelled_candidates(spark, d):
    h = table(spark, d, "leoh").select(F.col("rec_id").alias("src_id"), "leo_id")
    near = matching.radius_join(_src(spark, d), _tgt(spark, d), 1.0).join(h, "src_id").select("src_id", "tgt_id", "leo_id")
    return near.join(table(spark, d, "labelled_pairs").select("leo_id", F.col("bkg_id").alias("tgt_id")), ["leo_id", "tgt_id"], "left_semi")


@query(f"""with {_NEAR}, p as (select n.src_id, n.tgt_id, coalesce(nullif(trim(l.chain), ''), 'none') as chain, coalesce(nullif(trim(k.chain), ''), 'none') as chain_b, coalesce(n.name_a, '') as x, coalesce(n.name_b, '') as y from n join leoh l on l.rec_id = n.src_id join bkgh k on k.bkg_id = n.tgt_id where n.dist_m <= 300),
 r as (select a.chain_name as a, a.chain_name as b from chain_codes a union all select chain_name, 'none' from chain_codes union all select 'none', chain_name from chain_codes)
 select src_id, tgt_id, chain, chain_b from p join r on p.chain = r.a and p.chain_b = r.b where not contains(lower(y), lower(a)) and not contains(lower(x), lower(b))""")
def suspicious_candidates(spark, d):
    near = matching.radius_join(_src(spark, d), _tgt(spark, d), 0.3)
    some = lambda c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("none"))
    near = near.join(table(spark, d, "leoh").select(F.col("rec_id").alias("src_id"), some("chain").alias("chain"), "name"), "src_id").join(table(spark, d, "bkgh").select(F.col("bkg_id").alias("tgt_id"), some("chain").alias("chain_b"), F.col("name").alias("name_b")), "tgt_id")
    c = table(spark, d, "chain_codes").select(F.col("chain_name").alias("a"))
    rules = c.withColumn("b", F.col("a")).unionByName(c.withColumn("b", F.lit("none"))).unionByName(c.select(F.lit("none").alias("a"), F.col("a").alias("b")))
    return matching.suspicious(near, rules).select("src_id", "tgt_id", "chain", "chain_b")


@query("""with r as (select *, row_number() over (partition by leo_id order by loaded_at desc, rec_id desc) as k from leoh where leo_id is not null) select leo_id, rec_id, name, chain from r where k = 1""")
def last_wins(spark, d):
    h = table(spark, d, "leoh").where("leo_id IS NOT NULL").select("leo_id", F.struct("loaded_at", "rec_id", "name", "chain").alias("x"))
    return h.groupBy("leo_id").agg(F.max_by("x", F.struct("x.loaded_at", "x.rec_id")).alias("x")).select("leo_id", "x.rec_id", "x.name", "x.chain")


@query("select count(*) as listed, count(*) filter (where phash is not null) as hashed, count(*) filter (where features is not null and len(features) = 96) as usable, count(*) filter (where property_id is null) as lost from room_images")
def status_counts(spark, d):
    return table(spark, d, "room_images").agg(F.count(F.lit(1)).alias("listed"), F.count("phash").alias("hashed"), F.count_if(F.size("features") == 96).alias("usable"), F.count_if(F.col("property_id").isNull()).alias("lost"))


@query("select hotel_id, " + ", ".join(f"round(avg(tags[{i + 1}]), 6) as f{i}" for i in range(19)) + " from reviews where tags is not null group by hotel_id")
def flag_means(spark, d):
    r = table(spark, d, "reviews").where("tags IS NOT NULL")
    return r.groupBy("hotel_id").agg(*(_r(F.avg(F.get("tags", F.lit(i)))).alias(f"f{i}") for i in range(19)))


@query("""with c as (select city_id, median(lat) as y, median(lng) as x from bkgh where lat is not null and lng is not null and city_id is not null group by city_id)
 select h.rec_id, c.city_id from leoh h join c on abs(h.lat - c.y) < 0.041 and abs(h.lng - c.x) < 0.061 where not isnan(h.lat) and not isnan(h.lng) and abs(h.lat) < 90 and abs(h.lng) <= 180 and not (h.lat = 0 and h.lng = 0)
 and abs(h.lat - c.y) / 0.04 + abs(h.lng - c.x) / 0.06 <= 1""")
def city_polygons(spark, d):
    """Records in the diamond round each town's middle."""
    b = table(spark, d, "bkgh").where(F.col("lat").isNotNull() & F.col("lng").isNotNull() & F.col("city_id").isNotNull())
    mid = b.groupBy("city_id").agg(F.median("lat").alias("y"), F.median("lng").alias("x"))
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("lng"), (F.col("y") + dy).alias("lat"))
    regions = mid.select(F.col("city_id").alias("rid"), F.array(corner(-0.06, 0.0), corner(0.0, 0.04), corner(0.06, 0.0), corner(0.0, -0.04)).alias("ring"))
    h = table(spark, d, "leoh").where(has_position(F.col("lat"), F.col("lng"))).select(F.col("rec_id").alias("pid"), "lat", "lng")
    return points_in_regions(h, regions).select(F.col("pid").alias("rec_id"), F.col("rid").alias("city_id"))


@query(f"with {_NEAR}, m as (select src_id, tgt_id, dist_m, min(dist_m) over (partition by src_id) as least from n) select src_id, tgt_id, round(dist_m, 3) as dist_m from m where dist_m < 1.5 * least")
def ratio_of_least(spark, d):
    near = matching.radius_join(_src(spark, d), _tgt(spark, d), 1.0)
    return matching.within_ratio(near, "src_id", "dist_m", 1.5).select("src_id", "tgt_id", _r("dist_m", 3).alias("dist_m"))


@query("select p, n, cast(row_number() over (order by p, s, n) as integer) as pos from (select p_partkey as p, 'part' as s, p_name as n from part union all select s_suppkey, 'supplier', s_name from supplier)")
def ordered_merge(spark, d):
    a = table(spark, d, "part").select(F.col("p_partkey").alias("p"), F.lit("part").alias("s"), F.col("p_name").alias("n"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("p"), F.lit("supplier").alias("s"), F.col("s_name").alias("n"))
    return records.merged([a, b], ["p", "s", "n"], "pos").select("p", "n", "pos")


# --- photos and rooms -------------------------------------------------------------------------------------------------
def _photos(spark, d, bkg: bool):
    r = table(spark, d, "room_images").where("property_id IS NOT NULL").where("provider = 'bkg'" if bkg else "provider <> 'bkg'")
    return r.select(F.col("property_id").alias("key"), F.col("image_id").alias("id"), F.col("phash").alias("code"), F.when(_usable(), F.col("features")).alias("vec"), F.col("room_name").alias("room"))


def _usable():
    return (F.size("features") == 96) & F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x)) & F.exists("features", lambda x: x != 0)


_PHOTOS = "i as (select image_id as id, property_id as key, provider, phash as code, room_name as room, case when len(features) = 96 and len(list_filter(features, lambda x: x is null or isnan(x))) = 0 and len(list_filter(features, lambda x: x <> 0)) > 0 then list_transform(features, lambda x: cast(x as double)) end as v from room_images where property_id is not null), q as (select * from i where provider = 'bkg'), t as (select * from i where provider <> 'bkg')"
_TOP5 = "m as (select q.id as qid, t.id as id, list_distance(q.v, t.v) as d from q join t on q.key = t.key where q.v is not null and t.v is not null), k as (select *, row_number() over (partition by qid order by round(d, 9), id) as rank from m)"


@query(f"with {_PHOTOS}, {_TOP5} select qid, id, round(d, 5) as dist, cast(rank as integer) as rank from k where rank <= 5")
def match_top5(spark, d):
    got = rooms.best_matches(_photos(spark, d, True), _photos(spark, d, False), 8)
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.round(F.sqrt("dist"), 9), "id"))
    return got.withColumn("rank", rank).where("rank <= 5").select("qid", "id", F.round(F.sqrt("dist"), 5).alias("dist"), "rank")


_DUP = "h as (select q.id as qid, t.id as id, bit_count(xor(q.code, t.code)) as d from q join t on q.key = t.key where q.code is not null and t.code is not null), u as (select qid, id, d from (select *, row_number() over (partition by qid order by d, id) as k from h) where k = 1 and d <= 6)"


@query(f"with {_PHOTOS}, {_DUP} select qid, id, cast(d as double) as dist from u")
def photo_duplicates(spark, d):
    return rooms.nearest_duplicates(_photos(spark, d, True), _photos(spark, d, False)).select("qid", "id", F.col("dist").cast("double").alias("dist"))


@query(f"""with {_PHOTOS}, {_DUP}, p as (select q.id as qid, t.id as id, round(list_distance(q.v, t.v), 9) as d1, round(1 - list_cosine_similarity(q.v, t.v), 9) as d2 from q join t on q.key = t.key where q.v is not null and t.v is not null and q.id not in (select qid from u)),
 l as (select qid, id, d1 * 0.5 as d from (select *, row_number() over (partition by qid order by d1, id) as k from p) where k <= 20 union all select qid, id, d2 * 0.5 from (select *, row_number() over (partition by qid order by d2, id) as k from p) where k <= 20),
 s as (select qid, id, min(d) as score from l group by qid, id), r as (select *, row_number() over (partition by qid order by round(score, 8), id) as k from s)
 select qid, id, cast(d as double) as score, 'duplicate' as how from u union all select qid, id, round(score, 5), 'similar' from r where k <= 5""")
def similar_images(spark, d):
    got = rooms.similar_photos(_photos(spark, d, True), _photos(spark, d, False), k=8)
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("how", F.round("score", 8), "id"))
    return got.withColumn("k", rank).where("k <= 5").select("qid", "id", _r("score", 5).alias("score"), "how")


_RULES = """w(key, type) as (values ('studio','Studio'), ('apartment','Residential apartment'), ('business','Business room'), ('standard','Standard'), ('superior','Superior'), ('penthouse','Penthouse'), ('deluxe','Deluxe Room'), ('executive','Executive room'),
 ('king room','Executive room'), ('queen room','Executive room'), ('king suite','Concierge/Executive Suite'), ('queen suite','Concierge/Executive Suite'), ('conference suite','Concierge/Executive Suite'), ('comfort','Comfort room'), ('family','Family Room'),
 ('accessible','Accessible room'), ('presidential','Penthouse'), ('basic','Budget room'), ('classic','Budget room')),
 n as (select distinct room_name as room from room_images where room_name is not null union select distinct r.name from (select unnest(rooms) as r from details where rooms is not null) where r.name is not null),
 tk as (select room, string_split(trim(regexp_replace(lower(room), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') as toks from n),
 h as (select distinct tk.room, w.type from tk join w on list_has_all(toks, string_split(w.key, ' '))),
 hs as (select room, type from h union select room, 'Junior Suite/Mini Suite' from tk where contains(lower(room), 'suite') and room not in (select room from h where type = 'Concierge/Executive Suite')),
 rt as (select room, type from hs union select room, 'Standard' from tk where room not in (select room from hs))"""


@query(f"with {_RULES}, c as (select room_name as room, count(*) as images from room_images where room_name is not null group by room_name) select c.room as room_name, c.images, string_agg(rt.type, '|' order by rt.type) as types from c join rt on c.room = rt.room group by c.room, c.images")
def room_type_names(spark, d):
    got = table(spark, d, "room_images").where(F.col("room_name").isNotNull()).groupBy("room_name").agg(F.count(F.lit(1)).alias("images"))
    return got.select("room_name", "images", F.array_join(scoring.room_types(F.col("room_name")), "|").alias("types"))


@query(f"with {_PHOTOS}, {_DUP.replace('h as', 'hh as').replace('from h)', 'from hh)')}, {_RULES}, own as (select distinct q.key, rt.type from q join rt on q.room = rt.room), g as (select u.qid, rt.type, count(*) as cnt from u join t on t.id = u.id join rt on rt.room = t.room join q on q.id = u.qid join own on own.key = q.key and own.type = rt.type group by 1, 2), k as (select *, rank() over (partition by qid order by cnt desc) as r from g) select qid, type, cnt from k where r = 1")
def room_type_transfer(spark, d):
    q, t = _photos(spark, d, True), _photos(spark, d, False)
    return rooms.transfer_types(rooms.nearest_duplicates(q, t), q.select("id", "key", "room"), t.select("id", "room"))


_ORDER = "o(type, ord) as (values ('Accessible room', 1), ('Budget room', 2), ('Business room', 3), ('Comfort room', 4), ('Deluxe Room', 5), ('Duplex', 6), ('Executive room', 7), ('Concierge/Executive Suite', 8), ('Family Room', 9), ('Junior Suite/Mini Suite', 10), ('Penthouse', 11), ('Residential apartment', 12), ('Standard', 13), ('Studio', 14), ('Superior', 15), ('Villa', 16))"


@query(f"""with {_RULES}, {_ORDER}, p as (select distinct property_id as key, room_name as room from room_images where property_id is not null and room_name is not null), x as (select key, p.room, rt.type, row_number() over (partition by key order by ord, p.room, rt.type) - 1 as i, count(*) over (partition by key) as k from p join rt on p.room = rt.room join o on o.type = rt.type),
 sr as (select hotel_id as key, unnest(rooms) as r from details where rooms is not null and hotel_id is not null), s as (select key, list(r.livingscore order by r.livingscore) as v from sr where r.livingscore is not null and not isnan(r.livingscore) group by key),
 y as (select x.key, x.type, case when k = 1 then list_sum(v) / len(v) else v[least(len(v) - 1, cast(floor(i * len(v) / (k - 1)) as integer)) + 1] + (v[least(len(v) - 1, cast(ceil(i * len(v) / (k - 1)) as integer)) + 1] - v[least(len(v) - 1, cast(floor(i * len(v) / (k - 1)) as integer)) + 1]) * (i * len(v) / (k - 1) - floor(i * len(v) / (k - 1))) end as sc from x join s on s.key = x.key)
 select key, type, round(avg(sc), 5) as score from y group by key, type""")
def room_score_interp(spark, d):
    named = table(spark, d, "room_images").where("property_id IS NOT NULL").select(F.col("property_id").alias("key"), F.col("room_name").alias("room"))
    s = table(spark, d, "details").where("hotel_id IS NOT NULL").select(F.col("hotel_id").alias("key"), F.explode("rooms.livingscore").alias("x")).where("x IS NOT NULL AND NOT isnan(x)").groupBy("key").agg(F.collect_list("x").alias("scores"))
    return rooms.score_types(named, s).withColumn("score", _r("score", 5))


@query(f"""with {_RULES.replace("n as (select", "n as (select distinct trim(string_split(surroundings, chr(10))[1]) as room from details where surroundings is not null union select")}, o(code, type) as (values ('H','Accessible room'), ('I','Budget room'), ('B','Business room'), ('G','Comfort room'), ('D','Deluxe Room'), ('X','Duplex'), ('E','Executive room'), ('C','Concierge/Executive Suite'), ('F','Family Room'), ('S','Junior Suite/Mini Suite'), ('P','Penthouse'), ('R','Residential apartment'), ('M','Standard'), ('L','Studio'), ('A','Superior'), ('V','Villa')),
 z as (select det_id, type, case when det_id % 2 = 0 then coalesce(title, '') else '' end as code, trim(string_split(coalesce(surroundings, ''), chr(10))[1]) as line from details)
 select det_id, case when type in (select type from o) then type when code <> '' then coalesce((select o.type from o where o.code = substr(z.code, 1, 1)), '') when line = '' then '' else (select string_agg(rt.type, '|' order by rt.type) from rt where rt.room = z.line) end as types from z""")
def type_precedence(spark, d):
    code = F.when(F.col("det_id") % 2 == 0, F.coalesce("title", F.lit(""))).otherwise("")
    return table(spark, d, "details").select("det_id", F.array_join(rooms.type_of(F.col("type"), code, F.col("surroundings")), "|").alias("types"))


@query("""with p as (select property_id, room_name, image_id from room_images where property_id is not null and room_name is not null), r as (select property_id, room_name, count(*) as n from p group by 1, 2), k as (select property_id from r group by 1 having count(*) >= 2 and min(n) >= 2)
 select p.property_id, p.room_name, p.image_id, cast(ntile(2) over (partition by p.property_id, p.room_name order by p.image_id) as integer) as half from p join k on p.property_id = k.property_id""")
def evaluation_halves(spark, d):
    p = table(spark, d, "room_images").where("property_id IS NOT NULL AND room_name IS NOT NULL").select("property_id", "room_name", "image_id")
    return rooms.halves(p, "property_id", "room_name", "image_id", 2, 2)


# --- vectors ----------------------------------------------------------------------------------------------------------
@query(f"with {_EMB}, m as (select label, unnest(v) as x, generate_subscripts(v, 1) as i from e), a as (select label, i, avg(x) as x from m group by 1, 2) select a.label as a, b.label as b, round(sqrt(sum((a.x - b.x) * (a.x - b.x))), 5) as dist from a join a b on a.i = b.i group by 1, 2")
def distance_matrix(spark, d):
    """All distances between the mean vectors of the labels."""
    m = _emb(spark, d).select("label", F.posexplode("vec").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    b = m.select(F.col("label").alias("b"), "i", F.col("x").alias("y"))
    return m.join(b, "i").groupBy(F.col("label").alias("a"), "b").agg(F.round(F.sqrt(F.sum((F.col("x") - F.col("y")) * (F.col("x") - F.col("y")))), 5).alias("dist"))


@query(f"""with {_EMB}, o as (select id, round(list_sum(list_transform(v, lambda x: sqrt(abs(x)))), 5) as roots, round(list_sum(list_transform(v, lambda x: exp(x))), 5) as exps, round(list_sum(list_transform(v, lambda x: ln(abs(x) + 1))), 5) as logs,
 round(list_sum(list_transform(v, lambda x: round(x, 2))), 5) as rounded, round(list_sum(list_transform(v, lambda x: 1 / (x + 3))), 5) as inverse, round(list_sum(list_transform(list_zip(v, list_reverse(v)), lambda z: z[1] * z[2] + 0.5 * z[2])), 5) as muladd from e) select * from o""")
def elementwise(spark, d):
    v = F.col("vec")
    s = lambda c: F.round(V.total(c), 5) + 0.0
    return _emb(spark, d).select(
        "id", s(V.mapped(V.mapped(v, F.abs), F.sqrt)).alias("roots"), s(V.mapped(v, F.exp)).alias("exps"), s(V.mapped(v, lambda x: F.log(F.abs(x) + 1))).alias("logs"), s(V.mapped(v, lambda x: F.round(x, 2))).alias("rounded"),
        s(V.mapped(v, lambda x: 1 / (x + 3))).alias("inverse"), s(V.paired(v, F.reverse(v), lambda x, y: x * y + 0.5 * y)).alias("muladd"),
    )


@query(f"with {_EMB} select id, round(list_product(list_transform(v, lambda x: x * 5)), 5) as product, round(quantile_cont(x, 0.25), 6) as quartile, round(v[64] - v[1], 6) as rise, round(max(abs(dx)), 6) as steepest from (select id, v, unnest(v) as x, unnest(list_prepend(0.0, list_transform(range(1, 64), lambda i: v[i + 1] - v[i]))) as dx from e) group by id, v")
def more_reductions(spark, d):
    v = F.col("vec")
    diff = V.differences(v)
    return _emb(spark, d).select("id", F.round(V.product(V.scale(v, F.lit(5.0))), 5).alias("product"), _r(V.quantile_of(v, 0.25)).alias("quartile"), _r(V.total(diff)).alias("rise"), _r(V.norm(diff, -1)).alias("steepest"))


@query(f"with {_EMB}, x as (select id, unnest(v) as x, generate_subscripts(v, 1) - 1 as i from e), r as (select id, i, row_number() over (partition by id order by x, i) - 1 as r from x) select id, cast(i as integer) as place, cast(r as integer) as rank from r")
def permutation_ranks(spark, d):
    return _emb(spark, d).select("id", F.posexplode(V.ranks(F.col("vec"))).alias("place", "rank"))


@query("select det_id, cast(list_position(list_sort(t), 'TV') - 1 as integer) as place, len(list_filter(t, lambda x: x = 'TV')) as times, len(list_distinct(t)) as kinds from (select det_id, string_split(string_agg(r.facilities, ', '), ', ') as t from (select det_id, unnest(rooms) as r from details where rooms is not null) where r.facilities is not null group by det_id) where list_contains(t, 'TV')")
def sorted_find(spark, d):
    t = table(spark, d, "details").select("det_id", F.flatten(F.transform(F.filter("rooms.facilities", lambda x: x.isNotNull()), lambda x: F.split(x, ", "))).alias("t"))
    return V.found(t, "t", F.lit("TV")).where("place >= 0").select("det_id", "place", "times", "kinds")


@query(f"with {_EMB}, x as (select label, generate_subscripts(v, 1) % 8 as slot, unnest(v) as x from e) select label, cast(slot as integer) as slot, round(sum(x), 4) as total from x group by 1, 2")
def scatter_add(spark, d):
    return V.scattered(_emb(spark, d), "label", F.transform(F.sequence(F.lit(1), F.size("vec")), lambda i: i % 8), F.col("vec")).select("label", "slot", (F.round("total", 4) + 0.0).alias("total"))


@query(f"with {_EMB} select id, array_to_string(list_transform(range(0, 5), lambda i: cast(i * 2 + id % 3 as varchar)), ' ') as span, cast(len(list_filter(v, lambda x: x < 0)) as integer) as replaced from e")
def ranges_and_replace(spark, d):
    v = V.replaced(F.col("vec"), lambda x: x < 0, -9.0)
    return _emb(spark, d).select("id", F.array_join(V.span(F.col("id") % 3, 5, 2).cast("array<string>"), " ").alias("span"), F.size(F.filter(v, lambda x: x == -9.0)).alias("replaced"))


@query(f"with {_EMB}, h as (select label, floor(greatest(0, least(3, (v[1] + 0.4) * 5))) as i, floor(greatest(0, least(3, (v[2] + 0.4) * 5))) as j from e) select cast(i as integer) as i, cast(j as integer) as j, count(*) as n from h group by 1, 2")
def joint_counts(spark, d):
    at = lambda k: F.floor(F.greatest(F.lit(0), F.least(F.lit(3), (F.get("vec", F.lit(k)) + 0.4) * 5))).cast("int")
    return _emb(spark, d).groupBy(at(0).alias("i"), at(1).alias("j")).agg(F.count(F.lit(1)).alias("n"))


_PARTS = f"{_EMB}, p as (select id, k, v[k * 16 + 1 : k * 16 + 16] as v from e, generate_series(0, 3) t(k)), c as (select id, k, v, list_position(v, list_max(v)) as m, list_position(v, list_min(v)) as w from p), g as (select id, k, v, k * 1000 + m * 20 + w as code from c)"


def _part_codes(spark, d):
    """Four parts of 16 elements of each vector, with the places of their largest and smallest element as code."""
    p = _emb(spark, d).select("id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"), "vec").select("id", "k", F.slice("vec", F.col("k") * 16 + 1, F.lit(16)).alias("vec"))
    return p.select("id", "k", "vec", (F.col("k") * 1000 + F.array_position("vec", F.array_max("vec")) * 20 + F.array_position("vec", F.array_min("vec"))).alias("code"))


_VERIFIED = f"{_PARTS}, l as (select q.id as qid, q.k as pos, b.id as owner, min(list_distance(q.v, b.v)) as d from g q join g b on q.code = b.code and q.id <> b.id where q.id % 20 = 0 group by 1, 2, 3)"


@query(f"with {_VERIFIED}, a as (select qid, owner, list(d order by d)[1:3] as t from l group by 1, 2) select qid, owner, round(list_sum(t) * 3 / (len(t) * len(t)), 5) as weight from a")
def verified_weights(spark, d):
    return _verified(spark, d)[0].withColumn("weight", _r("weight", 5))


@query(f"with {_VERIFIED} select qid, owner, count(*) as votes from l where d < 0.8 group by 1, 2")
def verified_vote_join(spark, d):
    return _verified(spark, d)[1]


def _verified(spark, d):
    p = _part_codes(spark, d)
    q = p.where(F.col("id") % 20 == 0).select("code", F.col("id").alias("qid"), F.col("k").alias("pos"), "vec")
    w, v = search.verified_votes(p.select("code", F.col("id").alias("owner"), "vec"), q, 0.8)
    return w.where("qid <> owner"), v.where("qid <> owner")


@query("""with g as (select embedding, vec_id as id from embeddings), p as (select id, unnest(list_transform(embedding, lambda x: least(255, greatest(0, cast(floor(cast(x as double) * 255 + 128) as integer))))) as px from g)
 select id, cast(px // 4 as integer) as bin, round(count(*) / 64.0, 6) as share from p group by 1, 2""")
def gray_shares(spark, d):
    from quoin.operators import images

    px = F.transform("vec", lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(x * 255 + 128))).cast("int"))
    return images.binned(_emb(spark, d).select("id", px.alias("px")), "id", "px", lambda x: F.floor(x / 4)).withColumn("share", _r("share"))


@query("with v as (select vec_id as id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings), p as (select id, unnest(v) as x, generate_subscripts(v, 1) - 1 as i from v), r as (select *, row_number() over (partition by id order by x desc, i) as k from p where x > 0.02) select id, string_agg(lpad(cast(i as varchar), 2, '0') || lpad(cast(cast(floor(x * 50) as integer) as varchar), 2, '0'), '' order by k) as code from r where k <= 5 group by id having count(*) >= 2")
def symbol_codes(spark, d):
    from quoin.operators import images

    return _emb(spark, d).select("id", images.symbol_code(F.col("vec")).alias("code")).where("length(code) >= 8")


# --- models and similarities that SQL can't say -----------------------------------------------------------------------
@query()
def linkage_em(spark, d):
    from quoin.plans.models import linked_by_em

    return linked_by_em(spark, d)


@query()
def geoname_similarity(spark, d):
    near = matching.candidates(_src(spark, d), _tgt(spark, d), 0.3, 0.5)
    return matching.geoname(near).select("src_id", "tgt_id", _r("geoname_sim").alias("geoname_sim"))


@query()
def ranked_candidates(spark, d):
    near = matching.candidates(_src(spark, d), _tgt(spark, d), 1.0, 0.5).withColumn("score", F.round("name_sim_sw", 9))
    return matching.ranked_candidates(near).select("src_id", "tgt_id", "score", "rank")
