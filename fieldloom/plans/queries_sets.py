"""Queries on names, files, samples and ledgers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldloom.functions import expressions as X
from fieldloom.functions import geometry as G
from fieldloom.functions.shared import shared_folder
from fieldloom.operators import ledger, manifest, score
from fieldloom.sources import vector

from .registry import query
from .views import fields, sql, table

STEM = "regexp_replace(list_last(string_split(replace(url, '\\', '/'), '/')), '(?i)\\.tiff?$', '')"


def _pages(spark, d):
    return table(spark, d, "pages")


@query("k1_chip_name", "select doc_id, case when doc_id % 5 = 0 then 'chip_unknown' when doc_id % 5 = 1 then lang || doc_id when doc_id % 5 = 2 then 'chip_' || doc_id when doc_id % 5 = 3 then 'chip_0' else 'chip_' || doc_id end as name from documents")
def k1(spark, d):
    k = F.col("doc_id").cast("string")
    v = F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 5 == 1, F.concat("lang", k)).when(F.col("doc_id") % 5 == 2, k).when(F.col("doc_id") % 5 == 3, "-/").otherwise(F.concat(F.lit("#"), k, F.lit(" ")))
    return table(spark, d, "documents").select("doc_id", X.chip_name(v).alias("name"))


@query("k2_id_column", "select c_custkey as id from customer")
def k2(spark, d):
    c = table(spark, d, "customer").withColumnRenamed("c_custkey", "Chip_ID")
    return c.select(F.col(X.resolve_id_column(c.columns)).alias("id"))


@query("k3_first_name", "select doc_id, case when doc_id % 3 = 0 then lang when doc_id % 3 = 1 then source else 'file_' || doc_id end as name from documents")
def k3(spark, d):
    a, b = F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise(F.lit("  ")), F.when(F.col("doc_id") % 3 == 1, F.col("source"))
    return table(spark, d, "documents").select("doc_id", X.first_name(a, b, F.lit("file"), F.col("doc_id")).alias("name"))


@query("k4_stem", "select page_id, 'p' || page_id as stem from pages")
def k4(spark, d):
    path = F.concat(F.lit("a\\b/"), F.lit("p"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, ".TIF").otherwise(".tiff"))
    p = _pages(spark, d).select("page_id", path.alias("filename"))
    return p.select("page_id", X.stem(F.col(X.stem_column(p))).alias("stem"))


@query("k6_regex_parts", "select page_id, regexp_extract(url, '^https?://(?:[a-z]+\\.)?([^./]+)\\.example', 1) as site, regexp_extract(url, '/([a-z]{2})/', 1) as lang, try_cast(nullif(regexp_extract(url, '/([0-9]+)', 1), '') as bigint) as num from pages")
def k6(spark, d):
    u = F.col("url")
    return _pages(spark, d).select("page_id", F.regexp_extract(u, r"^https?://(?:[a-z]+\.)?([^./]+)\.example", 1).alias("site"), F.regexp_extract(u, r"/([a-z]{2})/", 1).alias("lang"), F.nullif(F.regexp_extract(u, "/([0-9]+)", 1), F.lit("")).cast("bigint").alias("num"))


@query("k15_sizes_and_types", """select page_id, case when n < 1024 then printf('%.2f B', n) when n < 1048576 then printf('%.2f KB', n / 1024.0::double) else printf('%.2f MB', n / 1048576.0::double) end as shown,
 case page_id % 4 when 0 then '.tif' when 1 then '.jpg' when 2 then '.csv' else '[no extension]' end as ext from (select page_id, (length(html) * 37)::double as n from pages)""")
def k15(spark, d):
    name = F.concat(F.lit("f"), F.when(F.col("page_id") % 4 == 0, ".TIFF").when(F.col("page_id") % 4 == 1, ".jpeg").when(F.col("page_id") % 4 == 2, ".csv").otherwise(""))
    return _pages(spark, d).select("page_id", X.human_bytes(F.length("html") * 37).alias("shown"), X.extension(name).alias("ext"))


@query("k17_common_kind", """select * from (values ('uint16', 'uint16', 'uint16'), ('uint16', 'int16', 'int32'), ('float32', 'uint16', 'float32'), ('uint8', 'uint16', 'uint16'), ('int32', 'uint32', 'int64'), ('float32', 'float64', 'float64'),
 ('int8', 'uint8', 'int16'), ('int8', 'int64', 'int64'), ('uint64', 'int64', 'float64'), ('uint64', 'uint32', 'uint64'), ('int32', 'uint16', 'int32'), ('float16', 'int8', 'float16'), ('float16', 'uint16', 'float32'), ('float32', 'int32', 'float64'), ('uint64', 'float32', 'float64'), ('int16', 'int8', 'int16'), ('bool8', 'int8', null)) t(a, b, kind)""")
def k17(spark, d):
    given = "uint16 uint16, uint16 int16, float32 uint16, uint8 uint16, int32 uint32, float32 float64, int8 uint8, int8 int64, uint64 int64, uint64 uint32, int32 uint16, float16 int8, float16 uint16, float32 int32, uint64 float32, int16 int8, bool8 int8"
    pairs = spark.createDataFrame([tuple(x.split()) for x in given.split(", ")], "a string, b string")
    return pairs.select("a", "b", X.common_kind(F.col("a"), F.col("b")).alias("kind"))


@query("k18_path_template", "select page_id, 'out/' || (page_id % 5) || '/chip_' || printf('%05d', page_id) || '.tif' as path from pages")
def k18(spark, d):
    return _pages(spark, d).select("page_id", X.path_from("out/%d/chip_%05d.tif", F.col("page_id") % 5, F.col("page_id")).alias("path"))


@query("d6_prefixed_tags", "select doc_id, lang as a_lang, source as b_source, 2 as n from documents")
def d6(spark, d):
    a, b = F.create_map(F.lit("lang"), F.col("lang")), F.create_map(F.lit("source"), F.col("source"))
    m = F.map_concat(X.prefix_tags(a, "A_"), X.prefix_tags(b, "B_"))
    return table(spark, d, "documents").withColumn("m", m).select("doc_id", F.col("m")["A_lang"].alias("a_lang"), F.col("m")["B_source"].alias("b_source"), F.size("m").alias("n"))


@query("f3_drop_columns", "select c_custkey, c_name from customer")
def f3(spark, d):
    return manifest.drop_columns(table(spark, d, "customer"), ("C_NationKey", "c_acctbal", "C_MKTSEGMENT"))


@query("f4_window_a_chips", "select doc_id from documents where doc_id in (select doc_id from labels)")
def f4(spark, d):
    return manifest.only_present(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("f4_window_a_empty", "select doc_id from documents where false")
def f4e(spark, d):
    return manifest.only_present(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").filter("doc_id < 0"), "doc_id")


@query("f5_empty_set_skipped", "select doc_id from documents")
def f5(spark, d):
    return manifest.restrict(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").filter("doc_id < 0"), "doc_id")


@query("f6_usable_samples", """select lang as country, doc_id as idx from documents where doc_id % 10 < 8 and not (doc_id % 7 = 0) and exists (select 1 from labels l where l.doc_id = documents.doc_id)""")
def f6(spark, d):
    docs = table(spark, d, "documents")
    s = docs.select(F.col("lang").alias("country"), F.col("doc_id").alias("idx"), F.when(F.col("doc_id") % 10 < 8, "train").otherwise("test").alias("split"))
    bad = s.filter("idx % 7 = 0").select("country", "idx")
    files = docs.join(table(spark, d, "labels"), "doc_id").select(F.col("lang").alias("country"), F.col("doc_id").alias("idx"))
    return manifest.usable_samples(s, bad, [files], "train").select("country", "idx")


F7 = """with p as (select c_custkey as k, case when c_custkey % 11 = 0 then 3 else 4 end as na, case when c_custkey % 13 = 0 then 5 else 4 end as nb, c_nationkey % 4 as ca, case when c_nationkey = 3 then null else c_nationkey % 4 end as cb, c_custkey % 3 as ta, c_custkey % 9 % 4 as tb, c_custkey % 5 as w, c_custkey % 10 as v from customer)
select k, case when na <> 4 then 'Window A has ' || na || ' bands (expected 4).' when nb <> 4 then 'Window B has ' || nb || ' bands (expected 4).' when ca is distinct from cb then 'CRS mismatch.' when ta <> tb then 'Affine transform mismatch.' when w <> v then 'Raster dimension mismatch.' else '' end as reason from p"""


@query("f7_pair_reason", F7)
def f7(spark, d):
    p = table(spark, d, "customer").selectExpr(
        "c_custkey as k", "case when c_custkey % 11 = 0 then 3 else 4 end as na", "case when c_custkey % 13 = 0 then 5 else 4 end as nb", "c_nationkey % 4 as ca", "case when c_nationkey = 3 then null else c_nationkey % 4 end as cb",
        "c_custkey % 3 as ta", "c_custkey % 9 % 4 as tb", "c_custkey % 5 as w", "c_custkey % 10 as v",
    )
    side = lambda n, c, t, w: {"bands": F.col(n), "crs": F.col(c), "transform": F.col(t), "width": F.col(w), "height": F.lit(256)}
    return p.select("k", X.pair_reason(side("na", "ca", "ta", "w"), side("nb", "cb", "tb", "v")).alias("reason"))


@query("f11_exact_size", "select vec_id from embeddings where vec_id % 3 <> 0 and vec_id % 4 <> 0 and vec_id % 7 <> 0")
def f11(spark, d):
    e = table(spark, d, "embeddings").selectExpr("vec_id", "case when vec_id % 3 = 0 then 255 else 256 end as width", "case when vec_id % 4 = 0 then 300 else 256 end as height", "case when vec_id % 7 <> 0 then 'EPSG:32723' end as crs")
    return manifest.exact_chips(e).select("vec_id")


@query("f13_distinct_tiles", "select distinct n_name as tile from nation where n_regionkey in (1, 3)")
def f13(spark, d):
    return manifest.tiles_of(table(spark, d, "nation"), "n_name", n_regionkey=[1, 3])


@query("f16_drop_suffixed", "select n_nationkey, n_name, r_name as area from nation join region on n_regionkey = r_regionkey")
def f16(spark, d):
    n = table(spark, d, "nation").withColumnsRenamed({"n_comment": "comment_left", "n_regionkey": "key_left"})
    r = table(spark, d, "region").selectExpr("r_regionkey as key_right", "r_name as area")
    return manifest.drop_suffixed(n.join(r, F.col("key_left") == F.col("key_right")))


@query("f17_dropna", "select doc_id, n from (select doc_id, lang, case when doc_id % 4 = 0 then null else n_chars end as n from documents) where n is not null and lang is not null")
def f17(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", F.when(F.col("doc_id") % 4 != 0, F.col("n_chars")).alias("n")).dropna(subset=["n", "lang"]).select("doc_id", "n")


@query("f18_tile_names", "select distinct p_brand as name from part")
def f18(spark, d):
    return manifest.tile_names(table(spark, d, "part"), "p_brand")


@query("j5_paired_names", "select a.doc_id as name from documents a join labels b on a.doc_id = b.doc_id")
def j5(spark, d):
    return manifest.paired(table(spark, d, "documents").select(F.col("doc_id").alias("name")), table(spark, d, "labels").select(F.col("doc_id").alias("name")), "name")


@query("j13_models_by_stacks", "select n_nationkey as stack, r_name || '/' || n_name as path from nation, region where not (n_nationkey % 4 = 0 and r_regionkey = 0)")
def j13(spark, d):
    # a few checkpoints by all stacks, less what is done
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    every = n.crossJoin(F.broadcast(r)).select(F.col("n_nationkey").alias("stack"), F.concat_ws("/", "r_name", "n_name").alias("path"))
    done = n.filter("n_nationkey % 4 = 0").crossJoin(F.broadcast(r.filter("r_regionkey = 0"))).select(F.concat_ws("/", "r_name", "n_name").alias("path"))
    return manifest.missing(every, done, "path")


@query("u1_shared_names", "select doc_id from documents intersect select doc_id from labels")
def u1(spark, d):
    return ledger.shared_names(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


@query("u2_remaining_tiles", "select distinct o_custkey % 200 as tile from orders where o_custkey % 200 not in (select c_custkey from customer where c_custkey < 50 union select s_suppkey from supplier where s_suppkey > 80)")
def u2(spark, d):
    every = table(spark, d, "orders").select((F.col("o_custkey") % 200).alias("tile"))
    done = table(spark, d, "customer").filter("c_custkey < 50").select(F.col("c_custkey").alias("tile"))
    active = table(spark, d, "supplier").filter("s_suppkey > 80").select(F.col("s_suppkey").alias("tile"))
    return ledger.remaining(every, [done, active], "tile")


@query("u4_logs", "select c_name as name, 'missing' as kind from customer union all select s_name, 'error' from supplier")
def u4(spark, d):
    return ledger.all_logs({"missing": table(spark, d, "customer").select(F.col("c_name").alias("name")), "error": table(spark, d, "supplier").select(F.col("s_name").alias("name"))})


@query("u5_lists_by_country", "select doc_id, lang as kind from documents where lang in ('en', 'de')")
def u5(spark, d):
    docs = table(spark, d, "documents")
    return ledger.all_logs({c: docs.filter(F.col("lang") == c).select("doc_id") for c in ("en", "de")})


@query("u6_columns", "select c_custkey, c_name from customer")
def u6(spark, d):
    c = table(spark, d, "customer")
    ledger.require_columns(c, ["c_custkey", "c_name"])
    return c.select("c_custkey", "c_name")


@query("u8_layer_ids", "select page_id::varchar as stem from pages")
def u8(spark, d):
    layer = _pages(spark, d).select(F.col("page_id").alias("row"), F.concat(F.lit("x/"), F.col("page_id").cast("string"), F.lit(".TIF")).alias("FileName"))
    return manifest.id_set(layer)


SAMPLE = "md5('{seed}:' || doc_id::varchar), doc_id"


@query("u7_disjoint_splits", f"with r as (select doc_id, row_number() over (order by {SAMPLE.format(seed=42)}) as n from documents) select doc_id, case when n <= 100 then 'train' when n <= 140 then 'val' else 'test' end as part from r where n <= 170")
def u7(spark, d):
    return score.disjoint_split(table(spark, d, "documents").select("doc_id"), "doc_id", 42, {"train": 100, "val": 40, "test": 30})


@query("w13_seeded_sample", f"select doc_id from documents order by {SAMPLE.format(seed=7)} limit 100")
def w13(spark, d):
    return score.seeded_sample(table(spark, d, "documents").select("doc_id"), "doc_id", 100, 7)


@query("w12_first_row", "select c_nationkey, c_custkey, c_name from customer qualify row_number() over (partition by c_nationkey order by c_acctbal, c_custkey) = 1")
def w12(spark, d):
    c = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name", "c_acctbal")
    return manifest.first_rows(c, "c_nationkey", ["c_acctbal", "c_custkey"]).drop("c_acctbal")


@query("g14_same_group", "select lang, source, string_agg(doc_id::varchar, ',' order by doc_id) as members, count(*)::int as n from documents group by 1, 2 having count(*) > 1")
def g14(spark, d):
    return ledger.same_group(table(spark, d, "documents"), ["lang", "source"], "doc_id")


@query("g15_type_stats", """select case page_id % 4 when 0 then '.tif' when 1 then '.jpg' when 2 then '.csv' else '[no extension]' end as ext, count(*) as n, sum(length(html))::bigint as bytes, min(url) as first,
 max(struct_pack(a := length(html), b := url)).b as largest, max(struct_pack(a := page_id % 97, b := url)).b as newest from pages group by 1""")
def g15(spark, d):
    name = F.concat(F.lit("f"), F.when(F.col("page_id") % 4 == 0, ".TIFF").when(F.col("page_id") % 4 == 1, ".jpeg").when(F.col("page_id") % 4 == 2, ".csv").otherwise(""))
    f = _pages(spark, d).select(F.col("url").alias("name"), F.length("html").cast("bigint").alias("size"), (F.col("page_id") % 97).alias("modified"), name.alias("file"))
    return ledger.type_stats(f, X.extension(F.col("file")))


def _ledger(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey as path", "cast(floor(o_totalprice) as bigint) as size")
    l = table(spark, d, "orders").filter("o_orderkey % 6 <> 0").selectExpr("o_orderkey as path", "cast(floor(o_totalprice) as bigint) + case when o_orderkey % 5 = 0 then 1 else 0 end as size")
    return ledger.copy_status(o, l)


LEDGER = """with l as (select o_orderkey as path, cast(floor(o_totalprice) as bigint) as src_size, case when o_orderkey % 6 <> 0 then cast(floor(o_totalprice) as bigint) + case when o_orderkey % 5 = 0 then 1 else 0 end end as dst_size from orders),
s as (select *, case when dst_size is null then 'pending' when dst_size = src_size then 'completed' else 'mismatched' end as status from l)
"""


@query("s23_copy_status", LEDGER + "select path, src_size, dst_size, status from s")
def s23(spark, d):
    return _ledger(spark, d)


@query("s23_resume", LEDGER + "select path from s where status in ('pending', 'failed')")
def s23r(spark, d):
    return ledger.resumable(_ledger(spark, d)).select("path")


@query("s23_merge_status", LEDGER + "select path, case when path % 12 = 0 then 'failed' else status end as status from s")
def s23m(spark, d):
    l = _ledger(spark, d)
    return ledger.merge_status(l, l.filter("path % 12 = 0").select("path", F.lit("failed").alias("status"))).select("path", "status")


@query("g23_estimate", LEDGER + "select status, count(*) as n, sum(src_size)::bigint as bytes, sum(src_size) / 500000000.0::double as seconds from s group by 1")
def g23(spark, d):
    return ledger.estimate(_ledger(spark, d), 10, 50e6)


@query("s24_checksums", "select page_id::varchar as path, page_id % 3 <> 0 as ok from pages")
def s24(spark, d):
    p = _pages(spark, d)
    lines = p.select(F.concat_ws("  ", F.when(F.col("page_id") % 3 == 0, F.md5(F.lit("x"))).otherwise(F.md5("html")), F.col("page_id").cast("string")).alias("value"))
    bad = p.limit(1).select(F.lit("no checksum here").alias("value"))
    listed = ledger.checksum_lines(lines.unionByName(bad))
    return ledger.checksums_ok(listed, p.select(F.col("page_id").cast("string").alias("path"), F.col("html").cast("binary").alias("content")))


@query("s12_unique_check", sql("fields", "select field_id as aoi_id, 'train' as split, true as has_fields, 1 as n_fields, x0::double as x0, y0::double as y0, x1::double as x1, y1::double as y1 from fields"))
def s12(spark, d):
    """A manifest with polygons, written as GeoParquet, read back and validated."""
    m = fields(spark, d).select(F.col("field_id").alias("aoi_id"), F.lit("train").alias("split"), F.lit(True).alias("has_fields"), F.lit(1).alias("n_fields"), F.array(F.array(G.box_ring(*G.box()))).alias("parts"))
    path = f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}.parquet"
    vector.write_geoparquet(m, path)
    back = vector.read_geoparquet(spark, path)
    manifest.check_manifest(back)
    return back.drop("parts")


@query("s14_score_json", """select doc_id, '{"doc_id":' || doc_id || ',"lang":"' || lang || '","n":' || n_chars || ',"mean":' || case when n_chars % 3 = 0 then 'NaN' else (n_chars // 3) || '.5' end || '}' as line from documents""")
def s14(spark, d):
    mean = F.expr("if(n_chars % 3 = 0, double('NaN'), n_chars div 3 + 0.5D)").alias("mean")
    return score.score_lines(table(spark, d, "documents").select("doc_id", "lang", F.col("n_chars").alias("n"), mean), "doc_id", "lang", "n", "mean").select("doc_id", "line")


@query("s17_missing_outputs", "select doc_id from documents where doc_id not in (select doc_id from labels)")
def s17(spark, d):
    return manifest.missing(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("s18_countries", "select site as country from (select regexp_extract(url, '^https?://([^/]+)', 1) as site from pages) group by 1 having count(*) = 1")
def s18(spark, d):
    f = _pages(spark, d).select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("country"), F.concat(F.lit("chips_"), F.col("page_id").cast("string"), F.lit(".parquet")).alias("name"))
    return manifest.single_manifest_countries(f)


@query("s19_preferred_file", """with f as (select source as country, case when doc_id % 9 = 0 then 'aoi_bahia' when doc_id % 4 = 0 then 'field' else 'x' end || '_' || doc_id || '.shp' as name from documents),
r as (select *, row_number() over (partition by country order by case when contains(name, 'bahia') then 0 when contains(name, 'field') then 1 else 2 end, name) as rn from f) select country, name from r where rn = 1""")
def s19(spark, d):
    kind = F.when(F.col("doc_id") % 9 == 0, "aoi_bahia").when(F.col("doc_id") % 4 == 0, "field").otherwise("x")
    f = table(spark, d, "documents").select(F.col("source").alias("country"), F.concat(kind, F.lit("_"), F.col("doc_id").cast("string"), F.lit(".shp")).alias("name"))
    return manifest.preferred_file(f, "bahia")


@query("s20_selected_chips", "select d.doc_id, l.doc_id is not null as found from documents d left join labels l using (doc_id)")
def s20(spark, d):
    return manifest.selected(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("s22_years_by_region", "select r_regionkey, y::int as year, 'map/' || r_name || '_' || y || '.tif' as path from region, (select unnest(range(1985, 2024)) as y) where not (r_regionkey = 0 and y < 2000)")
def s22(spark, d):
    r = table(spark, d, "region")
    every = manifest.by_year(r, 1985, 2023, "map/%s_%d.tif", "r_name").select("r_regionkey", "year", "path")
    return manifest.missing(every, every.filter("r_regionkey = 0 and year < 2000"), "path")


@query("s28_triples_present", "select doc_id from documents where doc_id in (select doc_id from labels) and doc_id in (select vec_id from embeddings)")
def s28(spark, d):
    return manifest.complete(table(spark, d, "documents").select("doc_id"), [table(spark, d, "labels"), table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"))], "doc_id")


@query("s15_packed_samples", "select vec_id, label, (unnest(range(128)))::int as pos, unnest(list_concat(list_reverse(embedding), embedding))::double as v from embeddings")
def s15(spark, d):
    e = table(spark, d, "embeddings")
    packed = manifest.pack_samples(e.select("vec_id", "label", F.col("embedding").alias("bands")), e.select("vec_id", F.reverse("embedding").alias("bands")), "vec_id")
    return packed.select("vec_id", "label", F.posexplode("image").alias("pos", "v")).withColumn("v", F.col("v").cast("double"))
