"""The engine's queries over the driver's tables, each with its SQL.

Names begin with the operator's id in the inventory. The Spark side calls the
operators of this package; the SQL side says independently what they compute.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import imaging as I
from ..functions import ontology as O
from ..operators import dedupe, ingest, merge, review, samples, verify
from ..operators.order import places
from ..shared import fresh_folder, made_folder, opened
from ..sources import files as S
from ..sources import markup as M
from ..sources import sinks as K
from ..sources.paged import register
from .fixtures import CLASSES, FILES, GRIDS, ROOTS, files, grids, pick_sql, table

lit, col = F.lit, F.col
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def of_files(name: str, columns: Callable[[], dict], sql: str, where: Callable[[], object] | None = None, sql_where: str = "true"):
    """A query that computes columns of each file."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = files(spark, d)
        if where is not None:
            rows = rows.where(where())
        return rows.select("doc_id", *[c.alias(k) for k, c in columns().items()])

    query(name, f"with {FILES} select doc_id, {sql} from files where {sql_where}")(run)


def text_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def rows_of(name: str, mapping: dict[str, str], a: str, b: str) -> str:
    """A CTE with the rows of a mapping."""
    return f"{name}({a}, {b}) as (values " + ", ".join(f"('{k}', '{v}')" for k, v in mapping.items()) + ")"


EXT = "lower(regexp_extract(name, '.(\\.[^.]*)$', 1))"
IMG = f"{EXT} in ('.png', '.jpg', '.jpeg', '.bmp', '.gif', '.webp')"
IMG5 = f"{EXT} in ('.jpg', '.jpeg', '.png', '.bmp', '.webp')"
IMG4 = f"{EXT} in ('.jpg', '.jpeg', '.png', '.webp')"
REL = "substr(path, length('datasets/' || root) + 2)"

# ---------------------------------------------------------------- sources

query("s01_list_images", f"with {FILES} select path, n_chars from files where {IMG}")(lambda s, d: S.list_images(files(s, d)).select("path", "n_chars"))


def _planted(spark, d):
    """The corpus as empty files: the folder they lie in, and ``doc_id, path, tree`` of each. Documents of one path lie in trees of their own, by number."""
    folder = made_folder(spark)
    rows = files(spark, d).where("path is not null").select("doc_id", "path").withColumn("tree", F.row_number().over(Window.partitionBy("path").orderBy("doc_id")))
    S.touch(rows.select(F.concat_ws("/", lit(folder), "tree", "path").alias("path")))
    return folder, rows


def _found(spark, folder):
    """What lies in the trees below ``folder``, listed level by level, with ``path`` as it is in its tree."""
    return S.walk(spark, folder).withColumn("path", F.regexp_replace(F.substring("path", len(S.root_uri(folder)) + 2, 10_000), r"^\d+/", ""))


def _walked(spark, d):
    return _found(spark, _planted(spark, d)[0])


def _by_root(spark, d):
    """Files by root; a document without a text has no name, so no file, and counts by its root alone."""
    nameless = files(spark, d).where("path is null").select("root", "path")
    rows = _walked(spark, d).select(F.split("path", "/")[1].alias("root"), "path").unionByName(nameless)
    return rows.groupBy("root").agg(F.count(lit(1)).alias("n"), F.count_if(F.contains("path", lit("/.trash/"))).alias("hidden"))


query("s01_walked_tree", f"with {FILES} select path, 0::bigint as length from files where {IMG}")(lambda s, d: S.list_images(_walked(s, d)).select("path", "length"))
query("s03_walked_tree", f"with {FILES} select root, count(*) as n, count(*) filter (where contains(path, '/.trash/')) as hidden from files group by root")(_by_root)
query("s02_collect_images", f"with {FILES} select root, count(*) as n from files where {IMG} group by root")(lambda s, d: S.list_images(files(s, d)).groupBy("root").agg(F.count(lit(1)).alias("n")))
query("s03_iter_files", f"with {FILES} select path, {IMG5} as is_image from files")(lambda s, d: files(s, d).select("path", C.is_image(col("name"), O.EXTS_NO_GIF).alias("is_image")))


@query("s04_class_dirs", f"with {FILES} select split_part(substr(path, 19), '/', 1) as class_dir, count(*) filter (where {IMG}) as images, count(*) filter (where not ({IMG})) as others from files where root = 'diseases' group by 1")
def s04(spark, d):
    rows = S.listed_with_kind(files(spark, d), "datasets/diseases")
    return rows.groupBy("class_dir").agg(F.count_if("is_image").alias("images"), F.count_if(~col("is_image")).alias("others"))


query("s05_direct_children", f"with {FILES} select path from files where root = 'crops' and len(string_split(path, '/')) = 4")(lambda s, d: S.direct_children(files(s, d), "datasets/crops").select("path"))
query("s06_images_with_trash", f"with {FILES} select path, contains(path, '/.trash/') as in_trash from files where {IMG5}")(lambda s, d: S.list_images(files(s, d), O.EXTS_NO_GIF).select("path", F.contains("path", lit("/.trash/")).alias("in_trash")))
query("s07_trash_blurs", f"with {FILES} select path from files where root = 'pests' and {IMG} and contains(path, 'datasets/pests/.trash/blur_')")(lambda s, d: S.trashed_blurs(files(s, d), "datasets/pests").select("path"))
query("s08_images_by_mode", f"with {FILES} select path, split_part(substr(path, 16), '/', 1) as expected from files where root = 'pests' and {IMG4} and not contains(path, '/.trash/')")(lambda s, d: S.images_by_mode(files(s, d), "datasets/pests"))
query("s08_images_by_mode_flat", f"with {FILES} select path, class_raw as expected from files where dir = 'datasets/crops/rice' and {IMG4}")(lambda s, d: S.images_by_mode(files(s, d), "datasets/crops/rice"))
query("s09_class_folders", f"with {FILES} select distinct lower(split_part(substr(path, 19), '/', 1)) as key, split_part(substr(path, 19), '/', 1) as class_dir from files where root = 'diseases'")(lambda s, d: S.class_folders(files(s, d), "datasets/diseases"))


@query("s10_json_map", "select n_name as raw, r_name as canonical from nation join region on n_regionkey = r_regionkey where n_nationkey % 7 <> 3")
def s10(spark, d):
    n = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), col("n_regionkey") == col("r_regionkey"))
    good = F.to_json(F.create_map("n_name", "r_name"))
    return S.json_map(n.select(F.when(col("n_nationkey") % 7 == 3, "{broken").otherwise(good).alias("value")))


@query("s11_case_folded_map", "select key, max_by(canonical, raw) as canonical from (select lower(n_name) as key, n_name as raw, r_name as canonical from nation join region on n_regionkey = r_regionkey union all select lower(r_name), n_name, r_name from nation join region on n_regionkey = r_regionkey) group by key")
def s11(spark, d):
    n = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), col("n_regionkey") == col("r_regionkey"))
    return review.case_folded(n.select(col("n_name").alias("raw"), col("r_name").alias("canonical")))


def _as_csv(rows: DataFrame) -> DataFrame:
    """``rows`` written as CSV files with headers, and read by the engine's reader."""
    folder = fresh_folder(rows.sparkSession)
    rows.write.option("header", "true").csv(folder)
    return S.read_table(rows.sparkSession, folder)


def _hot2020(spark, d):
    lab = table(spark, d, "labels").select("doc_id", col("toxic").cast("string").alias("rust"), col("quality").cast("string").alias("healthy"), F.when(col("doc_id") % 3 == 0, "1").otherwise("0").alias("scab"), F.when(col("doc_id") % 5 == 0, "1").otherwise("0").alias("multiple_diseases"))
    return lab.withColumn("image_id", F.concat(lit("Train_"), "doc_id"))


HOT = "hot as (select doc_id, 'Train_' || doc_id as image_id, toxic::varchar as rust, quality::varchar as healthy, case when doc_id % 3 = 0 then '1' else '0' end as scab, case when doc_id % 5 = 0 then '1' else '0' end as multiple_diseases from labels)"
query("s12_one_hot_rows", f"with {HOT} select image_id, healthy, multiple_diseases, rust, scab from hot")(lambda s, d: _as_csv(_hot2020(s, d).select("image_id", "healthy", "multiple_diseases", "rust", "scab")))


def _words2021(spark, d):
    words = F.concat_ws(" ", F.when(col("quality") == 1, "healthy"), F.when(col("toxic") == 1, "rust"), F.when(col("doc_id") % 3 == 0, "scab"), F.when(col("doc_id") % 9 == 0, "scab"))
    return table(spark, d, "labels").select("doc_id", F.concat("doc_id", lit(".jpg")).alias("image"), words.alias("labels"))


WORDS = "words as (select doc_id, doc_id || '.jpg' as image, concat_ws(' ', case when quality = 1 then 'healthy' end, case when toxic = 1 then 'rust' end, case when doc_id % 3 = 0 then 'scab' end, case when doc_id % 9 = 0 then 'scab' end) as labels from labels)"
query("s13_label_rows", f"with {WORDS} select image, nullif(labels, '') as labels from words")(lambda s, d: _as_csv(_words2021(s, d).select("image", "labels")))


@query("s14_side_labels", "select 'p/' || doc_id as path, list_filter(string_split(case when toxic = 1 then 'rust scab' else 'healthy' end, ' '), lambda x: x <> '') as multi_labels from labels")
def s14(spark, d):
    many = F.split(F.when(col("toxic") == 1, "rust scab").otherwise("healthy"), " ")
    text = table(spark, d, "labels").select(F.to_json(F.create_map(F.concat(lit("p/"), "doc_id"), F.struct(F.struct(many.alias("multi_labels")).alias("pp2021")))).alias("value"))
    return S.side_labels(text)


def _entries(spark, d):
    e = table(spark, d, "events")
    return e.select(F.to_json(F.array(F.struct(col("event_id").cast("string").alias("id"), col("event_type").alias("keyword"), F.when(col("event_id") % 4 == 0, "accepted").otherwise("rejected").alias("status")))).alias("value"))


ENTRIES = "select event_id::varchar as id, event_type as keyword, null::varchar as source, null::varchar as path, null::boolean as in_trash, null::varchar as trash_reason, case when event_id % 4 = 0 then 'accepted' else 'rejected' end as status from events"
query("s15_review_entries", ENTRIES)(lambda s, d: S.review_entries(_entries(s, d)))
query("s16_wrapped_manifest", ENTRIES)(lambda s, d: S.review_entries(_entries(s, d).select(F.concat(lit("const m = "), "value", lit(";\n")).alias("value")), wrapped=True))
LINES = "select case when n_nationkey % 5 = 0 then '# ' || n_name when n_nationkey % 5 = 1 then '  ' else '  ' || n_name || ' ' end as value from nation"


def _lines(spark, d):
    k = col("n_nationkey") % 5
    return table(spark, d, "nation").select(F.when(k == 0, F.concat(lit("# "), "n_name")).when(k == 1, "  ").otherwise(F.concat(lit("  "), "n_name", lit(" "))).alias("value"))


query("s17_keywords", f"select trim(value) as keyword from ({LINES}) where trim(value) <> '' and trim(value) not like '#%'")(lambda s, d: S.keywords(_lines(s, d)))
query("s17_keywords_with_comments", f"select trim(value) as keyword from ({LINES}) where trim(value) <> ''")(lambda s, d: S.keywords(_lines(s, d), comments=False))


def _sites(spark, d):
    t = F.element_at(F.array(*map(lit, ["html", "api", "commons", "gbif", "ftp"])), (col("s_suppkey") % 5 + 1).cast("int"))
    one = F.struct(col("s_name").alias("name"), t.alias("type"), F.when(col("s_suppkey") % 7 == 0, False).when(col("s_suppkey") % 2 == 0, True).alias("enabled"), (col("s_suppkey") % 3).cast("int").alias("max_pages"))
    return S.sites(table(spark, d, "supplier").select(F.to_json(F.array(one)).alias("value")))


SITES = "sites as (select s_name as name, (['html', 'api', 'commons', 'gbif', 'ftp'])[s_suppkey % 5 + 1] as type, case when s_suppkey % 7 = 0 then false when s_suppkey % 2 = 0 then true end as enabled, (s_suppkey % 3)::int as max_pages from supplier)"
query("s18_sites", f"with {SITES} select * from sites")(lambda s, d: _sites(s, d).select("name", "type", "enabled", "max_pages"))


def _tile_pages(spark, d):
    p = table(spark, d, "pages")
    m = F.when(col("page_id") % 6 == 0, "{bad").when(col("page_id") % 6 == 1, '{"purl":"x"}').otherwise(F.to_json(F.struct(col("url").alias("murl"), F.when(col("page_id") % 4 == 0, "").otherwise(F.concat("url", lit("/p"))).alias("purl"), lit("https://s").alias("surl"), F.concat(lit("t & "), col("page_id").cast("string")).alias("t"), (col("page_id") * 3).alias("w"), lit("12 kB").alias("size"))))
    esc = F.replace(F.replace(m, lit("&"), lit("&amp;")), lit('"'), lit("&quot;"))
    return p.select("page_id", F.concat(lit('<div><a class="iusc x" href="#" m="'), esc, lit('">i</a><a class="other" m="no"></a></div>')).alias("html"))


def _tiles(spark, d):
    """A tile's JSON for each event: fields empty, missing or not numbers by residue."""
    k = col("event_id") % 3
    one = F.struct(F.when(col("event_id") % 4 != 0, F.concat(lit("u"), "event_id")).alias("murl"), F.when(k == 0, "p").otherwise("").alias("purl"), F.when(k == 1, "s").when(k == 0, "no").alias("surl"), F.when(k == 0, "d").alias("desc"), F.when(k < 2, "t").otherwise("").alias("t"), F.when(col("event_id") % 2 == 0, (col("event_id") % 1000).cast("string")).otherwise("wide").alias("w"))
    return table(spark, d, "events").select("event_id", F.to_json(one).alias("m"))


TILES = "select page_id, url as image_url, case when page_id % 4 = 0 then 'https://s' else url || '/p' end as page_url, 't & ' || page_id as caption, null::varchar as thumbnail_url, (page_id * 3)::int as width, null::int as height, '12 kB' as size from pages where page_id % 6 > 1"
query("s19_search_tiles", TILES)(lambda s, d: ingest.tiles(S.page_tiles(_tile_pages(s, d))))
query("p48_tile_fields", "select event_id, 'u' || event_id as image_url, case event_id % 3 when 0 then 'p' when 1 then 's' end as page_url, case event_id % 3 when 0 then 'd' when 1 then 't' end as caption, case when event_id % 2 = 0 then (event_id % 1000)::int end as width, null::int as height from events where event_id % 4 <> 0")(lambda s, d: ingest.tiles(_tiles(s, d)).select("event_id", "image_url", "page_url", "caption", "width", "height"))
query("f09_bad_tiles", "select count(*) as n from pages where page_id % 6 > 1")(lambda s, d: ingest.tiles(S.page_tiles(_tile_pages(s, d))).agg(F.count(lit(1)).alias("n")))
LISTING = {"listing_selector": "nav > ul > li", "link_selector": "a::attr(href)", "title_selector": "a::text", "next_page_selector": "nav li a[href]::attr(href)"}
GALLERY = {"gallery_selector": "nav li a, article img", "original_attr": "href", "thumbnail_attr": "src", "caption_attrs": ["title", "href"], "filters": {"allow_substrings": ["a", "é"], "deny_substrings": ["the", "Th"]}}
SITE_OF = "regexp_extract(url, '^[a-z]+://[^/]+', 0)"
LINKED = f"linked as (select page_id, url, list_transform(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<li><a href=\"([^\"]*)\">', 1), lambda x: replace(x, '&amp;', '&')) as hrefs, list_transform(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<li><a href=\"[^\"]*\">([^<]*)</a>', 1), lambda x: nullif(trim(replace(x, '&amp;', '&')), '')) as texts from pages)"
query("s20_search_results", f"with {LINKED} select page_id, url, i as pos, {SITE_OF} || hrefs[i + 1] as link, texts[i + 1] as title, null::varchar as snippet, {SITE_OF} || hrefs[1] as next_page from (select *, unnest(range(len(hrefs)))::int as i from linked)")(lambda s, d: M.search_results(table(s, d, "pages"), LISTING))
query("s20_detail_images", f"with {LINKED}, found as (select page_id, url, list_filter(list_transform(hrefs, lambda x: {SITE_OF} || x), lambda x: (contains(x, 'a') or contains(x, 'é')) and not contains(x, 'the') and not contains(x, 'Th')) as images from linked) select page_id, url, images, images as thumbnails, list_transform(images, lambda x: substr(x, length({SITE_OF}) + 1)) as captions from found where len(images) > 0")(lambda s, d: M.detail_images(table(s, d, "pages"), GALLERY))


def _observations(spark, d):
    p = table(spark, d, "pages")
    photo = F.struct(F.concat("url", lit("/square.jpg")).alias("url"))
    photos = F.when(col("page_id") % 3 == 0, F.array().cast("array<struct<url:string>>")).otherwise(F.array(photo, photo))
    r = F.struct(col("page_id").alias("id"), F.when(col("page_id") % 2 == 0, "").otherwise(F.concat(lit("https://o/"), col("page_id").cast("string"))).alias("uri"), F.concat(lit("  sp\t"), col("page_id").cast("string"), lit(" ")).alias("species_guess"), photos.alias("photos"))
    return p.select("page_id", F.to_json(F.struct(F.array(r).alias("results"))).alias("body"))


OBS = "select page_id, [replace(url, 'square', 'large') || '/large.jpg', replace(url, 'square', 'large') || '/large.jpg'] as images, case when page_id % 2 = 0 then 'https://www.inaturalist.org/observations/' || page_id else 'https://o/' || page_id end as page_url, 'sp ' || page_id as caption from pages where page_id % 3 <> 0"
query("s21_observations", OBS)(lambda s, d: ingest.observations(_observations(s, d)))
query("f08_entries_without_photos", f"select count(*) as n from ({OBS})")(lambda s, d: ingest.observations(_observations(s, d)).agg(F.count(lit(1)).alias("n")))


def _commons(spark, d):
    p = table(spark, d, "pages")
    meta = F.create_map(lit("ObjectName"), F.struct(F.when(col("page_id") % 2 == 0, " ").otherwise("The  name").alias("value")), lit("ImageDescription"), F.struct(F.concat(lit("d "), col("page_id").cast("string")).alias("value")))
    info = F.struct(F.when(col("page_id") % 5 == 0, "").otherwise(col("url")).alias("url"), F.concat("url", lit("/t")).alias("thumburl"), meta.alias("extmetadata"))
    page = F.struct(F.concat(lit("File:a b "), col("page_id").cast("string")).alias("title"), F.array(info).alias("imageinfo"))
    return p.select("page_id", F.to_json(F.struct(F.struct(F.array(page).alias("pages")).alias("query"))).alias("body"))


COMM = "select page_id, url as image_url, url || '/t' as thumbnail_url, 'https://commons.wikimedia.org/wiki/File:a_b_' || page_id as page_url, case when page_id % 2 = 0 then 'd ' || page_id else 'The name' end as caption from pages where page_id % 5 <> 0"
query("s22_commons_pages", COMM)(lambda s, d: ingest.commons_pages(_commons(s, d)))
query("p42_first_metadata", f"select page_id, caption from ({COMM})")(lambda s, d: ingest.commons_pages(_commons(s, d)).select("page_id", "caption"))


def _occurrences(spark, d):
    e = table(spark, d, "events")
    m = lambda host, k: F.struct(F.concat(lit(f"https://{host}/"), col("event_id").cast("string"), lit(f"/{k}.jpg")).alias("identifier"), F.when(col("event_id") % 3 == 0, f"title {k}").otherwise("").alias("title"))
    media = F.slice(F.array(m("a.org", 0), m("b.org", 1), m("a.org", 2), m("c.org:8080", 3)), lit(1), (col("event_id") % 5).cast("int"))
    r = F.struct(F.concat(lit("sp "), "event_type").alias("scientificName"), col("event_id").cast("string").alias("occurrenceID"), media.alias("media"))
    return e.select("event_id", "event_type", F.to_json(F.struct(F.array(r).alias("results"))).alias("body"))


HOSTS = ["a.org", "c.org:8080"]
OCC = """occ as (select event_id, event_type, images, list_transform(images, lambda x: case when event_id % 3 = 0 then 'title ' || regexp_extract(x, '(\\d)\\.jpg$', 1) else 'sp ' || event_type end) as captions, event_id::varchar as page_url from (
  select event_id, event_type, list_filter((['https://a.org/' || event_id || '/0.jpg', 'https://b.org/' || event_id || '/1.jpg', 'https://a.org/' || event_id || '/2.jpg', 'https://c.org:8080/' || event_id || '/3.jpg'])[1:event_id % 5], lambda x: not contains(x, 'b.org')) as images from events) where len(images) > 0)"""
query("s23_occurrences", f"with {OCC} select event_id, event_type, 0 as pos, images, captions, page_url from occ")(lambda s, d: ingest.occurrences(_occurrences(s, d), HOSTS))
query("f06_media_hosts", f"with {OCC} select sum(len(images))::bigint as n from occ")(lambda s, d: ingest.occurrences(_occurrences(s, d), HOSTS).agg(F.sum(F.size("images")).alias("n")))


def _pictures(spark, d):
    """A black and white picture (WBMP, whose bytes are plain characters here) for each nation, some of them broken, as files."""
    head = F.concat(*[F.char(x) for x in (lit(0), lit(0), lit(16), (col("n_nationkey") + 1).cast("int"))])
    body = F.repeat(F.concat(F.char(lit(127)), F.char(lit(85))), (col("n_nationkey") + 1).cast("int"))
    folder = fresh_folder(spark)
    pixels = F.when(col("n_nationkey") % 9 == 4, lit("no picture")).otherwise(F.concat(head, F.substring(body, lit(1), F.char_length(body) - 1)))
    # The writer ends a line with the last byte of the picture.
    table(spark, d, "nation").select("n_nationkey", pixels.alias("value")).repartition("n_nationkey").write.partitionBy("n_nationkey").option("lineSep", "U").text(folder)
    rows = dedupe.image_features(S.read_images(spark, folder))
    return rows.withColumn("n_nationkey", F.regexp_extract("path", r"n_nationkey=(\d+)", 1).cast("int"))


query("s24_decode_errors", "select n_nationkey, n_nationkey % 9 = 4 as error, case when n_nationkey % 9 = 4 then -1 else 16 end as w, case when n_nationkey % 9 = 4 then -1 else n_nationkey + 1 end as h from nation")(lambda s, d: _pictures(s, d).select("n_nationkey", "error", "w", "h"))


def _answers(spark, d):
    rows = files(spark, d).select("path", C.class_of(col("path")).alias("expected"))
    return verify.analyze(rows, lambda path, klass: '{"is_match": %s}' % str(not path.endswith(".txt")).lower())


query("s25_model_client", f"with {FILES} select path, '{{\"is_match\": ' || (not ends_with(path, '.txt')) || '}}' as answer, null::varchar as error from files")(_answers)


def _resumed(spark, d):
    """A client that breaks on some files in a first run; the second, with the same log, asks for those alone."""
    rows = files(spark, d).select("path", C.class_of(col("path")).alias("expected"))
    log = fresh_folder(spark)

    def first(path: str, klass: str) -> str:
        if "7" in path[-9:]:
            raise OSError("busy")
        return f"first {klass}"

    verify.analyze(rows, first, tries=1, log=log)
    return verify.analyze(rows, lambda path, klass: f"second {klass}", log=log)


query("s25_resumed_calls", f"with {FILES} select path, case when contains(right(path, 9), '7') then 'second ' else 'first ' end || class_raw as answer, null::varchar as error from files")(_resumed)


SHELF = 1000  # pages in a file


def _keyword_folder(keyword: str | None) -> str:
    return "none" if keyword is None else f"k{keyword.encode().hex().upper()}"


@functools.lru_cache(maxsize=2)
def _shelf(folder: str, keyword: str | None, shelf: int) -> dict[int, str]:
    """Pages by number; a task asks for those of one file one after the other."""
    from pyarrow import fs

    system, at = opened(f"{folder}/keyword={_keyword_folder(keyword)}/shelf={shelf}")
    found = [e for e in system.get_file_info(fs.FileSelector(at, allow_not_found=True)) if e.base_name.startswith("part-")]
    lines = [line for e in found for line in system.open_input_stream(e.path).read().decode().splitlines()]
    return {int(page): body for page, body in (line.split(" ", 1) for line in lines)}


def _service(spark, d):
    """Events as pages of a service, of at most 35 events of a type each: a line for each page, and a thousand of them in a file, written by Spark."""
    folder = fresh_folder(spark)
    rows = places(table(spark, d, "events").select("event_type", "event_id"), ["event_id"], ("event_type",))
    pages = rows.withColumn("page", F.ceil(col("at") / 35)).groupBy("event_type", "page").agg(F.to_json(F.array_sort(F.collect_list("event_id"))).alias("body"))
    keyword = F.coalesce(F.concat(lit("k"), F.hex("event_type")), lit("none"))
    lines = pages.select(keyword.alias("keyword"), F.floor((col("page") - 1) / SHELF).alias("shelf"), F.concat_ws(" ", "page", "body").alias("value"))
    lines.repartition("keyword", "shelf").write.partitionBy("keyword", "shelf").text(folder)

    def fetch(keyword: str | None, page: int) -> str | None:
        return _shelf(folder, keyword, (page - 1) // SHELF).get(page)

    register(spark, "event_pages", fetch)
    kinds = [r[0] for r in table(spark, d, "events").select("event_type").distinct().collect()]  # the keywords: a configuration
    return {"keywords": json.dumps(sorted(kinds, key=lambda k: (k is None, k))), "pages": "400", "pagesPerTask": "100"}


EVENT_PAGES = "paged as (select event_id, event_type as keyword, ((row_number() over (partition by event_type order by event_id) - 1) // 35 + 1)::int as page from events)"


def _events_of(pages, *more):
    return pages.select("keyword", "page", *more, F.explode(F.from_json("body", "array<long>")).alias("event_id"))


query("p46_paged_source", f"with {EVENT_PAGES} select keyword, page, event_id from paged where keyword in ('click', 'purchase') and page <= 400")(lambda s, d: _events_of(s.read.format("event_pages").options(**_service(s, d)).load().where("keyword in ('click', 'purchase')")))
query("s26_dataset_names", "select page_id, string_split(url, '/')[-1] as name from pages")(lambda s, d: table(s, d, "pages").select("page_id", S.dataset_name(col("url")).alias("name")))

# ---------------------------------------------------------------- scalar derivations

of_files("p01_extension", lambda: {"ext": C.extension(col("name")), "is_image": C.is_image(col("name"))}, f"{EXT} as ext, {IMG} as is_image")
of_files("p02_class_of_path", lambda: {"class": C.class_of(col("path"))}, "string_split(path, '/')[-2] as class")
of_files("p03_source", lambda: {"source": C.source_of(col("name"), col("root"))}, "case when contains(name, '__cd__') then 'cd' when contains(name, '__pd__') then 'pd' when contains(name, '__ac__') then 'ac' when contains(name, '__ap__') then 'ap' when contains(name, '__kd__') then 'kd' else root end as source")


def _normal_sql(raw: str) -> str:
    crop = f"trim(replace(replace(replace(split_part({raw}, '___', 1), '(maize)', ''), 'Corn_', 'Corn'), 'Corn ', 'Corn'), ' _')"
    crop = f"replace(replace({crop}, 'Pepper,_bell', 'Bell_pepper'), 'Cherry_(including_sour)', 'Cherry')"
    crop = f"replace(case when {crop} = 'Grape' then 'grape' else {crop} end, 'Soybean', 'Soyabean')"
    disease = f"trim(replace(replace(substr({raw}, instr({raw}, '___') + 3), '_', ' '), '  ', ' '), ' _')"
    low = f"lower({disease})"
    cases = ""
    for of, words, name in O.DISEASE_RULES:
        test = f"starts_with({crop}, '{of[:-1]}')" if of.endswith("*") else f"lower({crop}) = 'grape'" if of == "grape" else f"{crop} = '{of}'"
        cases += f" when {test}" + "".join(f" and contains({low}, '{w}')" for w in words) + f" then '{name}'"
    plain = f"trim({crop} || ' ' || {disease})"
    return f"case when not contains({raw}, '___') then {raw} when {low} = 'healthy' then {crop} || ' leaf'{cases} when contains(lower({plain}), 'leaf') then trim(regexp_replace({plain}, '\\s+', ' ', 'g')) else trim(regexp_replace({plain} || ' leaf', '\\s+', ' ', 'g')) end"


NORMAL = _normal_sql("class_raw")
of_files("p04_normal_class", lambda: {"class": C.normal_class(col("class_raw"))}, f"{NORMAL} as class")
CANON = rows_of("names", O.CLASS_NAMES, "raw", "canonical")
CLASSED = f"classed as (select f.*, coalesce(n.canonical, {NORMAL}) as class from files f left join names n on n.raw = f.class_raw)"
ZH = rows_of("zh", O.CROP_ZH, "k", "v")
CROP = "case root when 'diseases' then split_part(class, ' ', 1) when 'crops' then class end"
TOKEN = "(" + " or ".join(f"contains(lower(class), '{t}')" for t in O.DISEASE_TOKENS) + ")"
HEALTHY = f"(ends_with(lower(trim(class)), 'leaf') and not {TOKEN})"


def _classed(spark, d):
    return samples.canonical_class(files(spark, d), samples.class_table(spark))


query("p05_crop", f"with {FILES}, {CANON}, {CLASSED} select doc_id, {CROP} as crop from classed")(lambda s, d: _classed(s, d).select("doc_id", C.crop_of(col("class"), col("root")).alias("crop")))
query("p06_crop_zh", f"with {FILES}, {CANON}, {ZH}, {CLASSED} select doc_id, coalesce((select v from zh where k = class), (select v from zh where k = lower(class)), class) as zh from classed")(lambda s, d: _classed(s, d).select("doc_id", C.crop_zh(col("class")).alias("zh")))
query("p07_health", f"with {FILES}, {CANON}, {CLASSED} select doc_id, {HEALTHY} as healthy, case when {TOKEN} then class end as disease from classed")(lambda s, d: _classed(s, d).select("doc_id", C.is_healthy(col("class")).alias("healthy"), C.disease_of(col("class")).alias("disease")))

SPLIT = """split as (select *, case when rn <= floor(n * 0.8e0) then 'train' when rn <= floor(n * 0.8e0) + floor(n * 0.1e0) then 'val' else 'test' end as split from (
  select *, row_number() over (partition by dir order by md5('42:' || path), path) as rn, count(*) over (partition by dir) as n from classed))"""
LABELLED = f"""lab as (select *, {CROP} as crop, case when root = 'diseases' then {HEALTHY} end as healthy, case when root = 'diseases' and {TOKEN} then class end as disease,
  case when contains(name, '__cd__') then 'cd' when contains(name, '__pd__') then 'pd' when contains(name, '__ac__') then 'ac' when contains(name, '__ap__') then 'ap' when contains(name, '__kd__') then 'kd' else root end as source,
  coalesce((select v from zh where k = {CROP}), (select v from zh where k = lower({CROP})), {CROP}) as czh, coalesce((select v from zh where k = class), (select v from zh where k = lower(class)), class) as pzh from split)"""
MADE = """made as (
  select *, unnest(case root
    when 'diseases' then [
      {task: 'caption', lang: 'en', text: case when healthy then 'A healthy ' || crop || ' leaf.' when disease is not null then 'A ' || crop || ' leaf showing ' || disease || '.' else 'A ' || class || '.' end, answer: null},
      {task: 'caption', lang: 'zh', text: case when healthy then '一张健康的' || czh || '叶片。' when disease is not null then '一张' || czh || '叶片，患有' || disease || '。' else '一张' || class || '。' end, answer: null},
      {task: 'vqa', lang: 'en', text: 'What crop is this?', answer: crop}, {task: 'vqa', lang: 'zh', text: '这是什么作物？', answer: czh}]
      || case when healthy then [{task: 'vqa', lang: 'en', text: 'Is the leaf healthy?', answer: 'yes'}, {task: 'vqa', lang: 'zh', text: '这片叶子是否健康？', answer: '是'}]
              when disease is not null then [{task: 'vqa', lang: 'en', text: 'What disease is present?', answer: disease}, {task: 'vqa', lang: 'zh', text: '这张叶片得了什么病？', answer: disease}]
              else [{task: 'vqa', lang: 'en', text: 'Is the leaf healthy?', answer: 'unknown'}] end
    when 'crops' then [
      {task: 'caption', lang: 'en', text: 'A photo of ' || class || '.', answer: null}, {task: 'caption', lang: 'zh', text: '一张' || czh || '的图像。', answer: null},
      {task: 'vqa', lang: 'en', text: 'What crop is this?', answer: crop}, {task: 'vqa', lang: 'zh', text: '这是什么作物？', answer: czh}]
    else [
      {task: 'caption', lang: 'en', text: 'An image of ' || class || '.', answer: null}, {task: 'caption', lang: 'zh', text: '一张' || pzh || '的图像。', answer: null},
      {task: 'vqa', lang: 'en', text: 'What pest is shown?', answer: class}, {task: 'vqa', lang: 'zh', text: '这是什么害虫？', answer: pzh}] end) as s from lab)"""
ALL = f"with {FILES}, {CANON}, {ZH}, {CLASSED}, {SPLIT}, {LABELLED}, {MADE}"


def _built(spark, d):
    return samples.build_samples(S.list_images(files(spark, d)), samples.class_table(spark))


BUILT = ALL.replace("from files f left join", f"from (select * from files where {IMG}) f left join")
query("p08_captions", f"{BUILT} select path as image, s.lang as lang, s.text as text from made where s.task = 'caption'")(lambda s, d: _built(s, d).where("task = 'caption'").select("image", "lang", "text"))
query("p09_questions", f"{BUILT} select path as image, s.lang as lang, s.text as text, s.answer as answer from made where s.task = 'vqa'")(lambda s, d: _built(s, d).where("task = 'vqa'").select("image", "lang", "text", "answer"))
query("w01_stratified_split", f"with {FILES}, {CANON}, {CLASSED}, {SPLIT} select doc_id, split from split")(lambda s, d: samples.with_split(_classed(s, d)).select("doc_id", "split"))
query("j04_split_of_samples", f"{BUILT} select split, s.task as task, s.lang as lang, count(*) as n from made group by all")(lambda s, d: _built(s, d).groupBy("split", "task", "lang").agg(F.count(lit(1)).alias("n")))
query("j01_ontology", f"with {FILES}, {CANON}, {CLASSED} select doc_id, class from classed")(lambda s, d: _classed(s, d).select("doc_id", "class"))
query("flagship_samples", f"{BUILT} select path as image, s.task as task, s.text as text, s.answer as answer, s.lang as lang, split, root, class, crop, disease, case when root not in ('diseases', 'crops') then class end as pest, healthy, source from made")(
    lambda s, d: _built(s, d).select("image", "task", "text", "answer", "lang", "split", *[col("labels")[c].alias(c) for c in ("root", "class", "crop", "disease", "pest", "healthy", "source")])
)


def _leaf2020(spark, d):
    present = table(spark, d, "documents").where("doc_id % 4 <> 1").select(F.concat(lit("pp2020/images/Train_"), "doc_id", lit(".jpg")).alias("path"))
    return samples.leaf_files_2020(_hot2020(spark, d), present, "pp2020/images")


LEAF20 = f"""{HOT}, leaf as (select 'pp2020/images/' || image_id || '.jpg' as path, case when rust = '1' then 'Apple rust leaf' when scab = '1' then 'Apple Scab Leaf' else 'Apple leaf' end as class,
  rust <> '1' and scab <> '1' and healthy = '1' as healthy, case when rust = '1' then 'Apple rust leaf' when scab = '1' then 'Apple Scab Leaf' end as disease,
  (healthy = '1')::int as f_healthy, (multiple_diseases = '1')::int as f_multiple, (rust = '1')::int as f_rust, (scab = '1')::int as f_scab from hot where doc_id % 4 <> 1)"""
query("p11_one_hot_leaf", f"with {LEAF20} select * from leaf")(lambda s, d: _leaf2020(s, d).select("path", "class", col("override.healthy").alias("healthy"), col("override.disease").alias("disease"), col("pp2020.healthy").alias("f_healthy"), col("pp2020.multiple_diseases").alias("f_multiple"), col("pp2020.rust").alias("f_rust"), col("pp2020.scab").alias("f_scab")))
query("j05_rows_with_files", f"with {LEAF20} select path from leaf")(lambda s, d: _leaf2020(s, d).select("path"))


def _leaf2021(spark, d):
    present = table(spark, d, "documents").where("doc_id % 4 <> 2").select(F.concat(lit("pp2021/train_images/"), "doc_id", lit(".jpg")).alias("path"))
    return samples.leaf_files_2021(_words2021(spark, d), present, "pp2021/train_images")


LEAF21 = f"""{WORDS}, leaf as (select 'pp2021/train_images/' || image as path, l as multi_labels,
  case when list_contains(l, 'healthy') then null when list_distinct(l) = ['rust'] then 'Apple rust leaf' when list_distinct(l) = ['scab'] then 'Apple Scab Leaf' end as disease, list_contains(l, 'healthy') and len(l) = 1 as healthy
  from (select *, list_filter(string_split(labels, ' '), lambda x: x <> '') as l from words where doc_id % 4 <> 2))"""
query("p12_label_list_leaf", f"with {LEAF21} select path, coalesce(disease, 'Apple leaf') as class, healthy, disease, multi_labels from leaf")(lambda s, d: _leaf2021(s, d).select("path", "class", col("override.healthy").alias("healthy"), col("override.disease").alias("disease"), col("pp2021.multi_labels").alias("multi_labels")))
query("p10_override", f"with {LEAF20} select path as image, 'kd' as source, healthy, disease, class, count(*) as n from (select *, unnest(range(case when healthy or disease is not null then 6 else 5 end)) from leaf) group by all")(
    lambda s, d: samples.explode_samples(samples.with_split(_leaf2020(s, d))).groupBy("image", *[col("labels")[c].alias(c) for c in ("source", "healthy", "disease", "class")]).agg(F.count(lit(1)).alias("n"))
)
query("u01_union_of_roots", f"with {FILES}, {LEAF20.replace('leaf as', 'leaf20 as')}, {LEAF21.replace('leaf as', 'leaf21 as')} select 1 as part, count(*) as n from files where {IMG} union all select 2, count(*) from leaf20 union all select 3, count(*) from leaf21")(
    lambda s, d: S.list_images(files(s, d)).select("path", lit(1).alias("part")).unionByName(_leaf2020(s, d).select("path", "pp2020", lit(2).alias("part")), allowMissingColumns=True).unionByName(_leaf2021(s, d).select("path", "pp2021", lit(3).alias("part")), allowMissingColumns=True).groupBy("part").agg(F.count(lit(1)).alias("n"))
)
query("j03_side_labels", f"with {FILES} select doc_id, case when root = 'diseases' then (select ['rust'] from labels l where l.doc_id = files.doc_id and toxic = 1) end as multi_labels from files")(
    lambda s, d: samples.with_side_labels(files(s, d), table(s, d, "labels").where("toxic = 1").join(files(s, d).select("doc_id", "path"), "doc_id").select("path", F.array(lit("rust")).alias("multi_labels"))).select("doc_id", col("pp2021.multi_labels").alias("multi_labels"))
)

INNER = [(y, x) for y in range(1, 7) for x in range(1, 7)]
P = lambda y, x: f"px[{y * 8 + x + 1}]"
LAP = "[" + ", ".join(f"{P(y - 1, x)} + {P(y + 1, x)} + {P(y, x - 1)} + {P(y, x + 1)} - 4 * {P(y, x)}" for y, x in INNER) + "]"
G2 = "[" + ", ".join(
    f"pow({P(y - 1, x + 1)} + 2 * {P(y, x + 1)} + {P(y + 1, x + 1)} - {P(y - 1, x - 1)} - 2 * {P(y, x - 1)} - {P(y + 1, x - 1)}, 2) + pow({P(y + 1, x - 1)} + 2 * {P(y + 1, x)} + {P(y + 1, x + 1)} - {P(y - 1, x - 1)} - 2 * {P(y - 1, x)} - {P(y - 1, x + 1)}, 2)"
    for y, x in INNER
) + "]"
SHARP = f"sharp as (select vec_id, list_var_pop({LAP}) as lap, list_avg({G2}) as ten from grids)"


def _sharp(spark, d):
    return grids(spark, d).select("vec_id", I.laplacian_variance(col("px"), 8, 8).alias("lap"), I.tenengrad(col("px"), 8, 8).alias("ten"))


query("p13_size_filter", "select p_partkey, p_size < 10 or p_retailprice < 910 as small from part")(lambda s, d: table(s, d, "part").select("p_partkey", C.is_small(col("p_size"), col("p_retailprice"), 10, 910).alias("small")))
query("f14_scrape_size", "select p_partkey from part where p_size >= 10 and p_retailprice >= 910")(lambda s, d: table(s, d, "part").where(~C.is_small(col("p_size"), col("p_retailprice"), 10, 910)).select("p_partkey"))
query("p14_laplacian", f"with {GRIDS}, {SHARP} select vec_id, round(lap, 6) as lap from sharp")(lambda s, d: _sharp(s, d).select("vec_id", F.round("lap", 6).alias("lap")))
query("p15_tenengrad", f"with {GRIDS}, {SHARP} select vec_id, round(ten, 6) as ten from sharp")(lambda s, d: _sharp(s, d).select("vec_id", F.round("ten", 6).alias("ten")))
query("p16_blur", f"with {GRIDS}, {SHARP} select vec_id, lap < 0.3 as l, ten < 0.2 as t, lap < 0.3 and ten < 0.2 as b from sharp")(lambda s, d: _sharp(s, d).select("vec_id", *[C.is_blurred(m, col("lap"), col("ten"), 0.3, 0.2).alias(m[0]) for m in ("laplacian", "tenengrad", "both")]))
BITS = lambda limit: "list_sum(list_transform(range(64), lambda i: case when px[i + 1] >= " + limit + " then case when i = 63 then -9223372036854775808 else (1::hugeint << i::int)::hugeint end else 0 end))::bigint"
MEAN = "(list_sum(px) / 64)"
MEDIAN = "((list_sort(px)[32] + list_sort(px)[33]) / 2)"
query("p17_average_hash", f"with {GRIDS} select vec_id, {BITS('(list_reduce(px, lambda a, b: a + b) / 64)')} as hash from grids")(lambda s, d: grids(s, d).select("vec_id", I.average_hash(col("px")).alias("hash")))

#: Embeddings as pictures of 16 x 4 bytes, and their pixels resampled to 8 x 8: cubic weights of 22 bits, rows first.
RESIZED = """bytes as (select vec_id, (i - 1) // 16 as y, (i - 1) % 16 as x, floor((embedding[i]::double + 1) * 120)::bigint as p from embeddings, range(1, 65) r(i)),
  taps as (select o, k, (k + 0.5) * o / 8 as c, greatest(o / 8, 1) as wide from (values (16), (4)) s(o), range(8) t(k)),
  reach as (select o, k, x, abs((x - c + 0.5) / wide) as u from taps, range(16) t(x) where x >= greatest(trunc(c - 2 * wide + 0.5), 0) and x < least(trunc(c + 2 * wide + 0.5), o)),
  cubic as (select o, k, x, case when u < 1 then (1.5 * u - 2.5) * u * u + 1 when u < 2 then ((-0.5 * u + 2.5) * u - 4) * u + 2 else 0 end as w from reach),
  fixed as (select o, k, x, trunc(w / sum(w) over (partition by o, k) * 4194304 + case when w < 0 then -0.5 else 0.5 end)::bigint as f from cubic),
  across as (select vec_id, y, k as x, least(255, greatest(0, floor((sum(p * f) + 2097152) / 4194304)))::bigint as p from bytes join fixed using (x) where o = 16 group by all),
  resized as (select vec_id, fixed.k as y, a.x, least(255, greatest(0, floor((sum(p * f) + 2097152) / 4194304)))::bigint as p from across a join fixed on o = 4 and fixed.x = a.y group by all)"""
query("p17_resized_hash", f"with {RESIZED}, meant as (select *, avg(p) over (partition by vec_id) as m from resized) select vec_id, sum(case when p >= m then case when y = 7 and x = 7 then -9223372036854775808::hugeint else (1::hugeint << (y * 8 + x)::int)::hugeint end else 0 end)::bigint as hash from meant group by vec_id")(
    lambda s, d: table(s, d, "embeddings").select("vec_id", I.resized_hash(F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 120).cast("int")), 16).alias("hash"))
)
HASHED = f"hashed as (select vec_id, label, {BITS(MEDIAN)} as hash from grids)"


def _hashed(spark, d):
    return grids(spark, d).select("vec_id", "label", I.median_hash(col("px")).alias("hash"))


query("p18_median_hash", f"with {GRIDS}, {HASHED} select vec_id, hash from hashed")(lambda s, d: _hashed(s, d).select("vec_id", "hash"))


def _pixels(spark, d):
    """32 x 32 pixels from each embedding."""
    px = F.transform(F.sequence(lit(0), lit(1023)), lambda i: F.element_at("px", (i % 61 + 1).cast("int")) * (1 + i % 47))
    return grids(spark, d).select("vec_id", px.alias("pixels"))


LOW = "low as (select vec_id, u, v, abs(sum(px[i % 61 + 1] * (1 + i % 47) * cos(2 * pi() * ((u * (i // 32) + v * (i % 32)) % 32) / 32))) as f from grids, range(1024) a(i), range(8) b(u), range(8) c(v) group by all)"
query("p18_frequency_hash", f"with {GRIDS}, {LOW}, ranked as (select *, median(f) over (partition by vec_id) as m from low) select vec_id, sum(case when f >= m then case when u = 7 and v = 7 then -9223372036854775808::hugeint else (1::hugeint << (u * 8 + v)::int)::hugeint end else 0 end)::bigint as hash from ranked group by vec_id")(lambda s, d: _pixels(s, d).select("vec_id", I.frequency_hash(col("pixels")).alias("hash")))
query("p19_hamming", f"with {GRIDS}, {HASHED} select a.vec_id as a, b.vec_id as b, bit_count(xor(a.hash, b.hash))::int as bits from hashed a join hashed b on b.vec_id = a.vec_id + 1")(
    lambda s, d: _hashed(s, d).select(col("vec_id").alias("a"), col("hash").alias("ha"), (col("vec_id") + 1).alias("b")).join(_hashed(s, d).select(col("vec_id").alias("b"), col("hash").alias("hb")), "b").select("a", "b", C.hamming(col("ha"), col("hb")).alias("bits"))
)
query("a11_grid_statistics", f"with {GRIDS} select vec_id, round({MEAN}, 6) as mean, round({MEDIAN}, 6) as median from grids")(lambda s, d: grids(s, d).select("vec_id", F.round(I.mean(col("px")), 6).alias("mean"), F.round(I.median(col("px")), 6).alias("median")))
of_files("p20_scope", lambda: {k: C.scope_key(F.substring(col("path"), lit(10), F.char_length("path")), k) for k in ("dir", "class", "root")}, "array_to_string(string_split(substr(path, 10), '/')[:-2], '/') as dir, split_part(substr(path, 10), '/', 1) as class, '' as root")


def _source_classes(spark, d):
    k = col("doc_id") % 4
    return files(spark, d).select("doc_id", F.when(k == 0, F.concat(lit("  "), "class_raw", lit("  PLANT "))).when(k == 1, F.concat(lit("Açaí é  "), "class_raw")).when(k == 2, F.concat(F.lower("class_raw"), lit("s"))).otherwise(col("class_raw")).alias("source_class"))


SOURCED = f"sourced as (select doc_id, case doc_id % 4 when 0 then '  ' || class_raw || '  PLANT ' when 1 then 'Açaí é  ' || class_raw when 2 then lower(class_raw) || 's' else class_raw end as source_class from files)"
NORM = "trim(regexp_replace(strip_accents(case when lower(trim(source_class)) like '% plant' then trim(source_class)[:-7] else trim(source_class) end), '\\s+', ' ', 'g'))"
query("p21_source_class", f"with {FILES}, {SOURCED} select doc_id, {NORM} as class from sourced")(lambda s, d: _source_classes(s, d).select("doc_id", C.source_class(col("source_class")).alias("class")))
query("p22_folder_name", "select page_id, trim(replace(replace(' ' || url || '\\x ', '/', '-'), '\\', '-')) as folder from pages")(lambda s, d: table(s, d, "pages").select("page_id", C.folder_name(F.concat(lit(" "), "url", lit("\\x "))).alias("folder")))
ALIAS = rows_of("aliases", O.CLASS_ALIASES, "key", "alias")


def _chosen(spark, d):
    existing = merge.existing_folders(files(spark, d).where("root = 'crops'").select(col("class_raw").alias("dir")))
    return merge.choose_folder(_source_classes(spark, d), existing, merge.alias_table(spark))


CHOSEN = f"""{FILES}, {SOURCED}, {ALIAS}, ex as (select lower(class_raw) as key, min(class_raw) as folder from files where root = 'crops' group by 1),
  n as (select *, {NORM} as norm, lower({NORM}) as k from sourced),
  chosen as (select doc_id, source_class, coalesce(b.folder, a.alias, e.folder, o.folder, trim(replace(replace(norm, '/', '-'), '\\', '-'))) as dest,
    case when a.alias is not null then b.folder is not null else coalesce(e.folder, o.folder) is not null end as existed
    from n left join aliases a on a.key = n.k left join ex b on b.key = lower(a.alias) left join ex e on e.key = n.k left join ex o on n.k like '%s' and o.key = n.k[:-2])"""
query("p23_choose_folder", f"with {CHOSEN} select * from chosen")(_chosen)
query("j06_folder_cascade", f"with {CHOSEN} select dest, existed, count(*) as n from chosen group by all")(lambda s, d: _chosen(s, d).groupBy("dest", "existed").agg(F.count(lit(1)).alias("n")))
UUID5 = lambda x: f"(select substr(h, 1, 12) || '5' || substr(h, 14, 3) || (['8', '9', 'a', 'b'])[(instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1] || substr(h, 18, 15) from (select sha1(unhex('{C.URL_SPACE}') || encode({x})) as h))"
of_files("p24_stable_name", lambda: {"name": C.stable_name(col("class_raw"), col("path"))}, f"trim(replace(class_raw, '/', '-')) || '__cd__' || {UUID5(chr(39) + 'crop-diseases::' + chr(39) + ' || trim(replace(class_raw, ' + chr(39) + '/' + chr(39) + ', ' + chr(39) + '-' + chr(39) + ')) || ' + chr(39) + '::' + chr(39) + ' || path')} || case when {IMG5} then {EXT} else '.jpg' end as name")
TAGGED = lambda tag: f"trim(replace(replace(class_raw, '/', '-'), '\\', '-')) || '__{tag}__' || {UUID5('path')} || {EXT}"
of_files("p25_tagged_name", lambda: {"name": C.tagged_name(col("class_raw"), "web", col("path"), col("name"))}, f"{TAGGED('web')} as name")

def _mode():
    return F.element_at(F.array(lit("keep"), lit("custom"), lit("uuid")), F.expr("cast(doc_id % 3 + 1 as int)"))


of_files("p26_rename_modes", lambda: {"name": C.new_name(_mode(), col("name"), F.when(col("doc_id") % 2 == 0, "my file.png").otherwise("../x"), col("class_raw"), "web", col("path"))}, f"case doc_id % 3 when 0 then name when 1 then case when doc_id % 2 = 0 then 'my file.png' end else {TAGGED('web')} end as name")
of_files("p27_valid_target", lambda: {"target": C.valid_target(F.when(col("doc_id") % 4 == 0, " a/b").when(col("doc_id") % 4 == 1, "  ").otherwise(F.concat(lit(" "), "class_raw")))}, "case when doc_id % 4 > 1 then trim(class_raw) end as target")
GUARD = ["datasets/crops", "datasets/pests/"]
of_files("p28_path_guard", lambda: {"error": C.path_error(col("path"), col("doc_id") % 5 != 0, GUARD), "root": C.matched_root(col("path"), GUARD)}, f"case when doc_id % 5 = 0 then 404 when root = 'diseases' then 403 when not ({IMG5}) then 400 end as error, case root when 'crops' then 'datasets/crops' when 'pests' then 'datasets/pests/' end as root")
of_files("p30_ids", lambda: {"id": F.sha1("path")}, "sha1(path) as id")
query("p31_component", "select page_id, coalesce(nullif(trim(regexp_replace(url, '[^\\p{L}\\p{N} _-]', '', 'g')), ''), 'x') as name from pages")(lambda s, d: table(s, d, "pages").select("page_id", C.component(col("url"), "x").alias("name")))
of_files("p32_reject_folder", lambda: {"folder": C.reject_folder(F.when(col("doc_id") % 3 == 0, "  ").otherwise(F.concat("class_raw", lit(" !? x "))), col("class_raw"))}, "case when doc_id % 3 = 0 then class_raw else replace(rtrim(regexp_replace(lower(trim(class_raw || ' !? x ')), '[^\\p{L}\\p{N} _]', '', 'g')), ' ', '_') end as folder")
of_files("p33_restored_path", lambda: {"rel": C.restored_path(col("path"))}, "array_to_string(list_filter(string_split(path, '/'), lambda s: s <> '.trash' and not starts_with(s, 'blur_') and not starts_with(s, 'dupe_') and not starts_with(s, 'small_')), '/') as rel")
of_files("p34_request", lambda: {"n": F.char_length(verify.request_body("m", F.concat(lit("Is this "), "class_raw", lit("?")), F.to_binary("h", lit("utf-8")), col("name"))), "mime": F.regexp_extract(verify.request_body("m", lit("p"), F.to_binary("h", lit("utf-8")), col("name")), "data:([^;]*);base64,([^\"]*)", 1), "b64": F.regexp_extract(verify.request_body("m", lit("p"), F.to_binary("h", lit("utf-8")), col("name")), "data:([^;]*);base64,([^\"]*)", 2)}, f"len('{{\"model\":\"m\",\"messages\":[{{\"role\":\"user\",\"content\":[{{\"type\":\"text\",\"text\":\"Is this ' || class_raw || '?\"}},{{\"type\":\"image_url\",\"image_url\":{{\"url\":\"data:' || case {EXT} when '.png' then 'image/png' when '.webp' then 'image/webp' else 'image/jpeg' end || ';base64,' || base64(encode(h)) || '\"}}}}]}}],\"temperature\":0.2,\"response_format\":{{\"type\":\"json_object\"}}}}')::int as n, case {EXT} when '.png' then 'image/png' when '.webp' then 'image/webp' else 'image/jpeg' end as mime, base64(encode(h)) as b64")


def _responses(spark, d):
    parts = F.array(F.struct(lit("text").alias("type"), col("text").alias("text")), F.struct(lit("image").alias("type"), lit("no").alias("text")), F.struct(lit("text").alias("type"), lit("!").alias("text")))
    one = lambda c: F.to_json(F.struct(F.array(F.struct(F.struct(c.alias("content")).alias("message"))).alias("choices")))
    return table(spark, d, "conversations").select("conv_id", "turn", F.when(col("turn") % 3 == 0, one(col("text"))).when(col("turn") % 3 == 1, one(parts)).otherwise("{}").alias("response"))


query("p35_answer_text", "select conv_id, turn, case turn % 3 when 0 then text when 1 then text || '!' end as answer from conversations")(lambda s, d: _responses(s, d).select("conv_id", "turn", verify.answer_text(col("response")).alias("answer")))


def _verdict_json():
    """A verdict for each event, wrong in a different way for each residue."""
    k = col("event_id") % 7
    good = F.to_json(F.struct((col("event_id") % 2 == 0).alias("is_match"), F.concat(lit("Class "), "event_type").alias("actual_class"), (col("event_id") % 10 / 10).alias("quality_score"), lit(None).cast("string").alias("rejection_reason"), lit("d").alias("description_en"), lit("描述").alias("description_zh")), {"ignoreNullFields": "false"})
    return F.when(k == 1, "not json").when(k == 2, "[1]").when(k == 3, '{"is_match": true}').when(k == 4, F.replace(good, lit('"description_en":"d"'), lit('"description_en":3'))).otherwise(good)


query("p36_verdict_errors", "select event_id, case event_id % 7 when 1 then 'bad_json' when 2 then 'bad_json' when 3 then 'missing:actual_class' when 4 then 'type:description_en' end as error from events")(lambda s, d: table(s, d, "events").select("event_id", verify.verdict_error(_verdict_json()).alias("error")))
of_files("p37_mock_verdict", lambda: {"actual_class": verify.mock_verdict(col("class_raw"))["actual_class"], "quality": verify.mock_verdict(col("class_raw"))["quality_score"]}, "class_raw as actual_class, 0.75::double as quality")
of_files("p38_expected_class", lambda: {"expected": verify.expected_class(F.when(col("doc_id") % 2 == 0, "").when(col("doc_id") % 3 == 0, "kw"), col("path"))}, "case when doc_id % 2 <> 0 and doc_id % 3 = 0 then 'kw' else string_split(path, '/')[-2] end as expected")
query("p39_squeeze", "select doc_id, nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '') as text from documents")(lambda s, d: table(s, d, "documents").select("doc_id", C.squeeze(col("text")).alias("text")))
query("p40_first_filled", "select event_id, coalesce(case when event_id % 2 = 0 then null else 'a' end, case when event_id % 3 = 0 then 'b' end, 'c') as v from events")(lambda s, d: table(s, d, "events").select("event_id", C.first_filled(F.when(col("event_id") % 2 == 0, "").otherwise("a"), F.when(col("event_id") % 3 == 0, "b"), lit("c")).alias("v")))
query("p41_photo_urls", "select page_id, replace(url || '/square.jpg', 'square', 'large') as photo, 'https://commons.wikimedia.org/wiki/' || replace('File:' || page_id || ' x', ' ', '_') as page from pages")(lambda s, d: table(s, d, "pages").select("page_id", C.large_photo(F.concat("url", lit("/square.jpg"))).alias("photo"), C.commons_page(F.concat(lit("File:"), "page_id", lit(" x"))).alias("page")))
QUOTE = lambda x: f"replace(url_encode({x}), '%20', '+')"
query("p43_query_string", f"select page_id, 'q=' || {QUOTE(chr(39) + 'a b~*&é ' + chr(39) + ' || url')} || '&page=' || page_id as q from pages")(lambda s, d: table(s, d, "pages").select("page_id", C.query_string({"q": F.concat(lit("a b~*&é "), "url"), "page": col("page_id")}).alias("q")))
query("p44_join_url", "select page_id, regexp_extract(url, '^[a-z]+://[^/]+', 0) || '/rel/' || page_id as link from pages")(lambda s, d: table(s, d, "pages").select("page_id", C.join_url(col("url"), F.concat(lit("/rel/"), col("page_id").cast("string"))).alias("link")))
query("p45_host", "select page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as host from pages")(lambda s, d: table(s, d, "pages").select("page_id", C.host(col("url")).alias("host")))
query("p46_page_sizes", "select event_id, greatest(10, least(100, coalesce(try_cast(case when event_id % 3 = 0 then 'x' else (event_id % 150)::varchar end as int), 35))) as size, greatest(1, coalesce((event_id % 5 - 1)::int, 1)) as pages from events")(lambda s, d: table(s, d, "events").select("event_id", C.page_size(F.when(col("event_id") % 3 == 0, "x").otherwise((col("event_id") % 150).cast("string"))).alias("size"), C.most_pages((col("event_id") % 5 - 1).cast("string")).alias("pages")))
query("p47_needed_pages", "select event_id, least((event_id % 6)::int, ceil((event_id % 97) / 20.0)::int) as pages from events")(lambda s, d: table(s, d, "events").select("event_id", C.needed_pages((col("event_id") % 6).cast("int"), col("event_id") % 97, lit(20)).alias("pages")))
KEY = "case when event_id % 4 = 0 then null when event_id % 4 = 1 then event_id when event_id % 4 = 2 then event_id + 1 else event_id + 2 end"


def _matches(spark, d):
    k = col("event_id") % 4
    return table(spark, d, "events").select(col("event_id").cast("string").alias("keyword"), F.to_json(F.struct(F.when(k == 1, col("event_id")).otherwise(0).alias("usageKey"), F.when(k == 2, col("event_id") + 1).alias("speciesKey"), F.when(k == 3, col("event_id") + 2).alias("acceptedKey"))).alias("match"))


query("p49_usage_key", f"select event_id::varchar as keyword, nullif({KEY}, 0) as key from events")(lambda s, d: _matches(s, d).select("keyword", ingest.usage_key().alias("key")))
query("j16_taxon_lookup", f"select event_id::varchar as keyword, case when event_id % 10 <> 0 then nullif({KEY}, 0) end as taxon_key, case when event_id % 10 = 0 or nullif({KEY}, 0) is null then 'text' else 'taxon' end as mode from events")(lambda s, d: ingest.occurrence_requests(_matches(s, d).select("keyword"), _matches(s, d).where("cast(keyword as bigint) % 10 <> 0")))

def _manifest(spark, d):
    return review.manifest(files(spark, d), "datasets")


MANIFEST = f"""{FILES}, parts as (select path, string_split(substr(path, 10), '/') as p from files where {IMG5}), manifest as (
  select sha1(path) as id, p[1] as keyword, p[-2] as source, path, false as in_trash, null::varchar as trash_reason from parts)"""
query("p29_manifest_plain", f"with {MANIFEST} select * from manifest")(_manifest)


def _trash_manifest(spark, d):
    """Each root as a scrape folder of its own, so that its trash is on top."""
    out = None
    for r in ROOTS:
        one = review.manifest(files(spark, d), f"datasets/{r}")
        out = one if out is None else out.unionByName(one)
    return out


TRASHED = f"""{FILES}, parts as (select path, string_split({REL}, '/') as p from files where {IMG5}), trashed as (
  select sha1(path) as id, case when p[1] = '.trash' then case when p[-3] <> '.trash' then p[-3] else '__trash__' end else p[1] end as keyword, p[-2] as source, path, p[1] = '.trash' as in_trash,
    case when p[1] = '.trash' and len(p) > 3 and p[-3] <> p[2] then p[2] end as trash_reason from parts)"""
query("p29_manifest", f"with {TRASHED} select * from trashed")(_trash_manifest)
query("f01_images_by_extension", f"with {FILES} select count(*) filter (where {IMG}) as six, count(*) filter (where {IMG5}) as five, count(*) filter (where {IMG4}) as four from files")(lambda s, d: files(s, d).agg(*[F.count_if(C.is_image(col("name"), e)).alias(n) for n, e in (("six", O.EXTS_ALL), ("five", O.EXTS_NO_GIF), ("four", O.EXTS_MODEL))]))


def _items(spark, d):
    e = table(spark, d, "events")
    return e.select(col("event_id").cast("string").alias("id"), F.when(col("event_id") % 6 == 0, "").otherwise(col("event_type")).alias("keyword"), F.concat(lit("p/"), "event_id").alias("path"), (col("event_id") % 3 == 0).alias("in_trash"), F.when(col("event_id") % 9 == 0, "blur_x/.trash/a").when(col("event_id") % 9 == 3, "").alias("trash_reason"))


ITEMS = "items as (select event_id::varchar as id, case when event_id % 6 = 0 then '' else event_type end as keyword, 'p/' || event_id as path, event_id % 3 = 0 as in_trash, case event_id % 9 when 0 then 'blur_x/.trash/a' when 3 then '' end as trash_reason from events)"
query("p50_shown_keyword", f"with {ITEMS} select id, coalesce(nullif(keyword, ''), '(未标注)') as keyword from items")(lambda s, d: _items(s, d).select("id", C.shown_keyword(col("keyword")).alias("keyword")))
CODE = "case when in_trash then 'trash|' || keyword || '|' || coalesce(nullif(trash_reason, ''), '__none__') else 'class|' || keyword end"
query("p51_selections", f"with {ITEMS} select id, coalesce(nullif(replace(replace(trash_reason, '.trash/', ' / '), '_', ' '), ''), '未标记') as reason, {CODE} as code, case when in_trash then coalesce(nullif(trash_reason, ''), '__none__') end as decoded from items")(
    lambda s, d: _items(s, d).select("id", C.reason_text(col("trash_reason")).alias("reason"), C.selection_code(col("in_trash"), col("keyword"), col("trash_reason")).alias("code"), C.selection_of(C.selection_code(col("in_trash"), col("keyword"), col("trash_reason")))["reason"].alias("decoded"))
)
query("p52_status_labels", "select event_id, case event_id % 3 when 0 then '已通过' when 1 then '已剔除' else '待审核' end as label, round(value * 100) as percent from events")(lambda s, d: table(s, d, "events").select("event_id", C.status_zh(F.when(col("event_id") % 3 == 0, "accepted").when(col("event_id") % 3 == 1, "rejected")).alias("label"), F.round(col("value") * 100).alias("percent")))
query("t01_stamps", "select event_id, strftime(ts, '%Y%m%d_%H%M%S') as stamp, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso, epoch_us(ts) // 1000 as millis from events")(
    lambda s, d: table(s, d, "events").withColumn("ts", col("ts").cast("timestamp")).select("event_id", C.stamp(col("ts")).alias("stamp"), C.iso_stamp(col("ts")).alias("iso"), C.epoch_millis(col("ts")).alias("millis"))
)
