"""Ingestion: request tables, parsers of fetched payloads, caps by site and keyword.

Fetching itself is outside; parsers are functions of payload columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .runs import first_rows

lit, col = F.lit, F.col


def requests(keywords: DataFrame, sites: DataFrame, page: Column | None = None) -> DataFrame:
    """Each keyword on each enabled site and page. The sites are a configuration of a few rows; the product is wanted."""
    rows = keywords.crossJoin(F.broadcast(sites.where(F.coalesce("enabled", lit(True)) & col("type").isin("html", "api", "commons", "gbif"))))
    return rows.withColumn("page", F.explode(F.sequence(lit(1), page if page is not None else C.most_pages(col("max_pages")))))


def first_n(rows: DataFrame, n: Column | int, by: list[str], order: list[str]) -> DataFrame:
    """The first ``n`` rows of each group.

    With a number, no task shuffles more than ``n`` rows of a group, whatever it
    is; a column may differ by group, and is only known after the shuffle.
    """
    if isinstance(n, int):
        return first_rows(rows, n, by, order)
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(col("_r") <= n).drop("_r")


def cap_images(rows: DataFrame, cap: int, by: list[str], order: list[str], images: str = "images") -> DataFrame:
    """Rows until their images reach ``cap`` in a group; the last row's list is cut.

    Each row has an image at least, so no more than the first ``cap`` rows of a
    group are shuffled by a task.
    """
    rows = first_rows(rows.where(F.size(images) > 0), cap, by, order)
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.size(images)).over(w), lit(0))
    return rows.withColumn("_before", before).where(col("_before") < cap).withColumn(images, F.slice(images, lit(1), (lit(cap) - col("_before")).cast("int"))).drop("_before")


def allowed_url(url: Column, allow: list[str], deny: list[str]) -> Column:
    """Has one of ``allow`` (if any are given) and none of ``deny``."""
    ok = lit(not allow)
    for s in allow:
        ok = ok | F.contains(url, lit(s))
    for s in deny:
        ok = ok & ~F.contains(url, lit(s))
    return ok


def allowed_host(url: Column, hosts: list[str]) -> Column:
    return C.host(url).isin(hosts) if hosts else lit(True)


TILE = "murl string, purl string, surl string, desc string, t string, turl string, w string, h string, size string"


def tiles(payload: DataFrame, column: str = "m") -> DataFrame:
    """Image, page, caption, thumbnail and size of a search tile's JSON; undecodable tiles and those without an image go."""
    rows = payload.withColumn("_t", F.from_json(col(column), TILE, {"mode": "PERMISSIVE"})).where(F.coalesce(col("_t.murl"), lit("")) != "")
    t = lambda n: col(f"_t.{n}")
    return rows.withColumns({"image_url": t("murl"), "page_url": C.first_filled(t("purl"), t("surl")), "caption": C.first_filled(t("desc"), t("t")), "thumbnail_url": t("turl"), "width": t("w").try_cast("int"), "height": t("h").try_cast("int"), "size": t("size")}).drop("_t", column)


PHOTO = "array<struct<id:string,original_url:string,large_url:string,url:string,license_code:string,attribution:string>>"
OBSERVATIONS = f"results array<struct<id:bigint,uri:string,species_guess:string,description:string,observed_on:string,photos:{PHOTO}>>"


def observations(payload: DataFrame, column: str = "body") -> DataFrame:
    """A row for each observation with photos; square photo URLs become large ones."""
    rows = payload.withColumn("r", F.explode(F.from_json(column, OBSERVATIONS)["results"])).where(F.size("r.photos") > 0)
    urls = F.filter(F.transform("r.photos", lambda p: C.large_photo(C.first_filled(p["original_url"], p["large_url"], p["url"]))), lambda u: u.isNotNull())
    page = F.coalesce(F.nullif(col("r.uri"), lit("")), F.concat(lit("https://www.inaturalist.org/observations/"), col("r.id").cast("string")))
    return rows.withColumns({"images": urls, "page_url": page, "caption": C.first_filled(C.squeeze(col("r.species_guess")), C.squeeze(col("r.description")))}).where(F.size("images") > 0).drop("r", column)


COMMONS = "query struct<pages:array<struct<title:string,imageinfo:array<struct<url:string,thumburl:string,width:int,height:int,mime:string,extmetadata:map<string,struct<value:string>>>>>>>"


def commons_pages(payload: DataFrame, column: str = "body") -> DataFrame:
    """A row for each page with an image URL; the caption is the first metadata field that says something."""
    rows = payload.withColumn("p", F.explode(F.from_json(column, COMMONS)["query"]["pages"])).withColumn("i", F.get(col("p.imageinfo"), lit(0))).where(F.coalesce(col("i.url"), lit("")) != "")
    meta = lambda k: C.squeeze(col("i.extmetadata")[k]["value"])
    return rows.withColumns({"image_url": col("i.url"), "thumbnail_url": col("i.thumburl"), "page_url": C.commons_page(col("p.title")), "caption": F.coalesce(meta("ObjectName"), meta("ImageDescription"), col("p.title"))}).drop("p", "i", column)


MATCH = "usageKey bigint, speciesKey bigint, acceptedUsageKey bigint, acceptedKey bigint"


def usage_key(column: str = "match") -> Column:
    m = F.from_json(column, MATCH)
    return F.coalesce(*[F.nullif(m[k], lit(0)) for k in ("usageKey", "speciesKey", "acceptedUsageKey", "acceptedKey")])


def occurrence_requests(keywords: DataFrame, matches: DataFrame) -> DataFrame:
    """Keywords with their taxon key, or to be searched by text where none was found."""
    rows = keywords.join(matches, "keyword", "left").withColumn("taxon_key", usage_key())
    return rows.withColumn("mode", F.when(col("taxon_key").isNull(), "text").otherwise("taxon")).drop("match")


OCCURRENCES = "results array<struct<scientificName:string,references:string,occurrenceID:string,media:array<struct<identifier:string,title:string,references:string,license:string,creator:string>>>>"


def occurrences(payload: DataFrame, hosts: list[str], column: str = "body") -> DataFrame:
    """A row for each occurrence with images from allowed hosts (parallel lists of images and captions)."""
    rows = payload.select("*", F.posexplode(F.from_json(column, OCCURRENCES)["results"]).alias("pos", "r"))
    media = F.filter("r.media", lambda m: (F.coalesce(m["identifier"], lit("")) != "") & allowed_host(m["identifier"], hosts))
    rows = rows.withColumn("m", media).where(F.size("m") > 0)
    return rows.withColumns({"images": F.transform("m", lambda m: m["identifier"]), "captions": F.transform("m", lambda m: C.first_filled(m["title"], col("r.scientificName"))), "page_url": C.first_filled(col("r.references"), col("r.occurrenceID"))}).drop("m", "r", column)


def stored_path(query: Column, source: Column, url: Column) -> Column:
    """``<query>/<source>/<sha1 of the URL>.jpg``."""
    return F.concat_ws("/", C.component(query, "unknown_query"), C.component(source, "unknown_source"), F.concat(F.sha1(url), lit(".jpg")))


def image_rows(items: DataFrame) -> DataFrame:
    """Parallel lists (image_urls, captions) to a row for each image."""
    return items.withColumn("z", F.explode(F.arrays_zip("image_urls", "captions"))).select(*[c for c in items.columns if c not in ("image_urls", "captions")], col("z.image_urls").alias("image_url"), col("z.captions").alias("caption"))
