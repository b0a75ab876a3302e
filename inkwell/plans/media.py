"""Queries of URLs, image elements, bytes, manifests and downloads; tables as in catalog.

The raw pages hold no images, so that pages of images are built from their ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, web
from ..operators import assets
from ..sources import readers, writers
from ..sources.scratch import scratch
from .catalog import query, table



def _p() -> Column:
    return F.col("page_id")


def _u() -> Column:
    return F.concat(F.lit("https://img.e.org/"), _p().cast("string"))


_SQL_U = "'https://img.e.org/' || page_id"


@query("""with b as (select page_id, url, 'https://img.e.org/' || page_id || '/a b_' || (page_id + 1) || 'x40.png' as inner_url from pages)
select page_id, regexp_matches(url, '^https?://') as valid, inner_url as direct, (page_id + 1)::bigint as width, 40::bigint as height, 'image/png' as mime, true as image,
case when page_id % 2 = 0 then 'https://c.e.org/' || page_id else null end as absolute, case when page_id % 3 = 0 then 'post-' || page_id else 'x.y' end as slug, case when page_id % 3 = 0 then 'post-' || page_id else 'x-y' end as safe_slug from b""")
def url_shapes(spark, d):
    inner = F.concat(_u(), F.lit("/a b_"), (_p() + 1).cast("string"), F.lit("x40.png"))
    coded = F.replace(F.replace(F.replace(inner, F.lit(":"), F.lit("%3A")), F.lit("/"), F.lit("%2F")), F.lit(" "), F.lit("%20"))
    wrapped = F.concat(F.lit("https://xcdn.com/image/fetch/w_100/"), coded)
    plain = F.when(_p() % 2 == 0, F.concat(F.lit("  //c.e.org/"), _p().cast("string"), F.lit(" "))).otherwise(F.lit("data:image/png;base64,x"))
    post = F.when(_p() % 3 == 0, F.concat(F.lit("https://n.e.org/p/post-"), _p().cast("string"), F.lit("?a=b"))).otherwise(F.lit("https://n.e.org/q/x.y/#c"))
    size = web.url_dimensions(F.replace(inner, F.lit(" "), F.lit("%20")))
    return table(spark, d, "pages").select("page_id", web.valid_url(F.col("url")).alias("valid"), web.unwrapped(wrapped).alias("direct"), size["width"].alias("width"), size["height"].alias("height"), web.url_mime(F.replace(inner, F.lit(" "), F.lit("%20"))).alias("mime"), web.looks_like_image(wrapped).alias("image"), web.absolute(plain).alias("absolute"), text.slug(post).alias("slug"), text.safe_slug(post).alias("safe_slug"))


@query(f"""select page_id, case when page_id % 3 = 0 then {_SQL_U} || '/2.jpg' when page_id * 10 >= page_id * 7 + 5 then {_SQL_U} || '/1.jpg' else {_SQL_U} || '/2.jpg' end as largest, 2::int as n_candidates, {_SQL_U} || '/s.gif' as css from pages""")
def srcset_choices(spark, d):
    marks = [F.when(_p() % 3 == 0, F.lit(low)).otherwise(F.concat(wide.cast("string"), F.lit("w"))) for low, wide in (("1.5x", _p() * 10), ("2x", _p() * 7 + 5))]
    value = F.concat(_u(), F.lit("/1.jpg "), marks[0], F.lit(", "), _u(), F.lit("/2.jpg "), marks[1])
    style = F.concat(F.lit("color:red;background:URL( '"), _u(), F.lit("/s.gif' )"))
    return table(spark, d, "pages").select("page_id", web.largest(web.srcset(value))["url"].alias("largest"), F.size(web.srcset(value)).alias("n_candidates"), F.get(web.css_urls(style), F.lit(0)).alias("css"))


_CONTEXTS = (("img beacon", 9.0, False, "tracking"), ("img", 1.0, False, "tracking"), ("img user-photo", 9.0, False, "avatar"), ("img plain", 9.0, True, "embed"), ("img newsletter-logo", 9.0, False, "publication-chrome"), ("img pixels", None, False, "post-content"))


@query("select n_nationkey, ['tracking', 'tracking', 'avatar', 'embed', 'publication-chrome', 'post-content'][n_nationkey % 6 + 1] as class from nation")
def element_classes(spark, d):
    at = (F.col("n_nationkey") % 6).cast("int")
    pick = lambda k, kind: F.get(F.array(*(F.lit(c[k]).cast(kind) for c in _CONTEXTS)), at)
    return table(spark, d, "nation").select("n_nationkey", web.classify(pick(0, "string"), pick(1, "double"), F.lit(None).cast("double"), pick(2, "boolean")).alias("class"))


def _image_pages(spark, d) -> DataFrame:
    parts = ['<div class="avatar"><img src="', _u(), '/1.png" width="40" alt="a"></div><a href="', _u(), '/big.jpg"><picture><source srcset="', _u(), '/2.webp 2x"><img src="', _u(), """/2.png" data-attrs='{"bytes": 77, "type": "image/png", "href": \"""", _u(), """/h"}'></picture></a><a href=\"""", _u(), '/x.jpg">x</a><img src="', _u(), '/1.png" width="1"><p style="background:url(', _u(), '/s.gif)">z</p><img src="data:x">']
    return table(spark, d, "pages").select("page_id", F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts)).alias("html"))


def _covers(spark, d) -> DataFrame:
    cover = F.when(_p() % 4 == 0, F.lit(None)).when(_p() % 5 == 1, F.concat(_u(), F.lit("/1.png"))).otherwise(F.concat(_u(), F.lit("/cover_30x40.png")))
    return table(spark, d, "pages").select(_p().cast("long").alias("doc_id"), cover.alias("cover"), F.col("url").alias("post_url"))


_ASSETS = f"""select page_id || '-' || case kind when 'css-background' then 'cssbac' when 'image-link' then 'imagel' when 'post-cover' then 'cover' else 'img' end || '-' || printf('%03d', ordinal) as asset_id, page_id::bigint as doc_id, ordinal::int as ordinal, kind, url, class, mime,
case when url is null then 'unresolved' else 'listed' end as status, refs::int as n_references, byte_estimate::double as byte_estimate, declared::double as declared_width, case when kind = 'img' and ordinal = 3 or kind = 'post-cover' and page_id % 4 <> 0 and page_id % 5 = 1 then page_id || '-img-001' end as duplicate_of
from (select page_id from pages), lateral (values (1, 'img', {_SQL_U} || '/1.png', 'avatar', 'image/png', 1, null, 40), (2, 'img', {_SQL_U} || '/2.png', 'post-content', 'image/png', 4, 77, null), (3, 'img', {_SQL_U} || '/1.png', 'tracking', 'image/png', 1, null, 1), (4, 'img', null, 'post-content', null, 1, null, null),
(5, 'css-background', {_SQL_U} || '/s.gif', 'post-content', 'image/gif', 1, null, null), (6, 'image-link', {_SQL_U} || '/x.jpg', 'post-content', 'image/jpeg', 2, null, null),
(1, 'post-cover', case when page_id % 4 = 0 then null when page_id % 5 = 1 then {_SQL_U} || '/1.png' else {_SQL_U} || '/cover_30x40.png' end, 'post-cover', case when page_id % 4 <> 0 then 'image/png' end, case when page_id % 4 = 0 then 0 else 1 end, null, null)) v(ordinal, kind, url, class, mime, refs, byte_estimate, declared)"""


@query(_ASSETS)
def image_manifest(spark, d):
    rows = assets.manifest(_image_pages(spark, d), _covers(spark, d))
    return rows.select("asset_id", "doc_id", "ordinal", "kind", "url", "class", "mime", "status", F.size("references").alias("n_references"), "byte_estimate", "declared_width", "duplicate_of")


@query(f"""with a as ({_ASSETS}) select (select count(*) from pages) as pages, (select count(*) from pages) as posts, (select count(*) from pages where page_id % 4 = 0) as without_cover, count_if(kind = 'post-cover') as covers, count(*) as listed, count(distinct url) as unique_urls, count(duplicate_of) as duplicates, count_if(status = 'unresolved') as unresolved from a""")
def manifest_summary(spark, d):
    pages, posts = _image_pages(spark, d), _covers(spark, d)
    return assets.manifest_summary(assets.manifest(pages, posts), pages, posts)


@query(f"select 'body' as list, asset_id, url from ({_ASSETS}) where status = 'listed' and kind <> 'post-cover' and duplicate_of is null union all select 'covers', asset_id, url from ({_ASSETS}) where status = 'listed' and kind = 'post-cover'")
def download_lists_round_trip(spark, d):
    """The four files of a manifest written, and both lists read again."""
    folder = scratch(spark, "manifest")
    writers.manifest_set(assets.manifest(_image_pages(spark, d), _covers(spark, d)), folder)
    lists = [readers.download_list(spark, f"{folder}/{k}.tsv").select(F.lit(k).alias("list"), "asset_id", "url") for k in ("body", "covers")]
    return lists[0].unionByName(lists[1])


@query("""select page_id, case when page_id % 2 = 0 then '2024-01-' || printf('%02d', page_id % 28 + 1) else '2023-02-03' end as published, case when page_id % 2 = 0 then 'H' || page_id else 'Og ' || page_id end as headline, case when page_id % 2 = 0 then 'D' end as description,
case when page_id % 3 = 0 then 'v' || page_id end as attr from pages""")
def linked_data(spark, d):
    p = _p().cast("string")
    block = F.concat(F.lit('<script type="application/ld+json">{"headline":"old","description":"D"}</script><SCRIPT type="application/ld+json">{"datePublished":"2024-01-'), F.format_string("%02d", _p() % 28 + 1), F.lit('","headline":"H'), p, F.lit('"}</SCRIPT>'))
    meta = F.concat(F.lit("<meta property='og:title' content='Og "), p, F.lit("'><meta property=\"article:published_time\" content=\"2023-02-03\">"))
    attrs = F.when(_p() % 3 == 0, F.concat(F.lit('{"k": "v'), p, F.lit('"}'))).when(_p() % 3 == 1, F.lit("[1]")).otherwise(F.lit("no"))
    found = web.json_ld(F.when(_p() % 2 == 0, block).otherwise(meta))
    return table(spark, d, "pages").select("page_id", found["published"].alias("published"), found["headline"].alias("headline"), found["description"].alias("description"), web.object_attrs(attrs)["k"].alias("attr"))


@query("select n_nationkey, least(coalesce(case when n_nationkey % 3 = 0 then n_nationkey * 4000 end, least(500 * (1 << (n_nationkey % 8)), 10000)), 60000)::bigint as delay from nation")
def retry_delays(spark, d):
    k = F.col("n_nationkey")
    return table(spark, d, "nation").select("n_nationkey", web.retry_delay_ms(k % 8 + 1, F.when(k % 3 == 0, k * 4)).alias("delay"))


_KINDS = ("png", "gif", "bmp", "jpeg", "webp", "tiff", "heic", "svg+xml", "avif")
def _files(spark, d) -> DataFrame:
    w, h = _p() % 200 + 2, _p() % 90 + 3
    x = lambda n, v: F.lower(F.lpad(F.hex(v), n, "0"))
    cat = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    forms = [
        cat("89504e470d0a1a0a0000000d49484452", x(8, w), x(8, h)), cat("474946383961", x(2, w), "00", x(2, h), "000000"), cat("424d", "00" * 16, x(2, w), "000000", x(2, h), "000000"),
        cat("ffd8ffe000040000ffc0001108", x(4, h), x(4, w), "03"), cat("524946460000000057454250565038580a00000000000000", x(2, w - 1), "0000", x(2, h - 1), "0000"),
        cat("49492a000800000002000001030001000000", x(2, w), "0000000101030001000000", x(2, h), "000000"), cat("00000018667479706865696300000000000000146973706500000000", x(8, w), x(8, h)),
        F.hex(cat('<svg width="', w.cast("string"), '" height="', h.cast("string"), '"></svg>')), cat("00000018667479706176696600000000000000146973706500000000", x(8, w), x(8, h)),
    ]
    form = forms[-1]
    for k in range(7, -1, -1):
        form = F.when(_p() % 9 == k, forms[k]).otherwise(form)
    return table(spark, d, "pages").select(F.concat(F.lit("f/a"), _p().cast("string"), F.lit(".bin")).alias("path"), F.unhex(form).alias("content"))


@query(f"""select 'f/a' || page_id || '.bin' as path, 'image/' || [{', '.join(repr(k) for k in _KINDS)}][page_id % 9 + 1] as mime, (page_id % 200 + 2)::int as width, (page_id % 90 + 3)::int as height from pages""")
def inspected_files(spark, d):
    return assets.inspect(_files(spark, d)).select("path", "mime", "width", "height")


def _entries(spark, d) -> DataFrame:
    url = F.concat(_u(), F.lit("/p_"), (_p() % 50).cast("string"), F.lit("x40.png"))
    return table(spark, d, "pages").select(F.concat(F.lit("a.b"), _p().cast("string")).alias("asset_id"), url.alias("url"), "page_id")


_SQL_ENTRY = f"'a.b' || page_id as asset_id, {_SQL_U} || '/p_' || (page_id % 50) || 'x40.png' as url"


@query(f"""select {_SQL_ENTRY}, case when page_id % 2 = 0 and page_id % 6 <> 0 then 'image/webp' else 'image/png' end as expected_mime, (page_id % 50)::bigint as expected_width, 40::bigint as expected_height, case when page_id % 2 = 0 and page_id % 6 <> 0 then page_id::double end as max_width from pages""")
def download_entries(spark, d):
    entries = _entries(spark, d)
    named = F.when(_p() % 6 == 0, F.lit("https://other.e.org/")).when(_p() % 4 != 0, F.col("url"))
    rows = entries.where("page_id % 2 = 0").select("asset_id", named.alias("url"), F.lit("image/webp").alias("mime"), _p().cast("double").alias("max_width"))
    return assets.metadata_for(entries.drop("page_id"), rows)


@query(f"""select asset_id, url, 'd/' || asset_id || '.png' as path, page_id % 3 = 0 and page_id % 7 = 0 as hash_matches from (select page_id, {_SQL_ENTRY} from pages) where page_id % 5 <> 0 and not (page_id % 3 = 0 and page_id % 4 = 0)""")
def reusable_files(spark, d):
    """Every third entry has a prior report, every fourth of these for another URL; every fifth file is a part only."""
    entries = _entries(spark, d)
    prior = entries.where("page_id % 3 = 0").select("asset_id", F.when(_p() % 4 == 0, F.lit("https://other.e.org/")).otherwise(F.col("url")).alias("url"), F.when(_p() % 7 == 0, F.lit("same")).otherwise(F.lit("old")).alias("sha256"))
    ending = F.when(_p() % 5 == 0, F.lit(".part-1.png")).otherwise(F.lit(".png"))
    files = entries.select(F.concat(F.lit("d/"), "asset_id", ending).alias("path"), F.lit("same").alias("sha256"), F.lit("image/png").alias("mime"))
    return assets.reusable(entries.drop("page_id"), prior, files)


@query("select count(*) as n, count_if(page_id % 4 <> 0) as downloaded, count_if(page_id % 4 = 0) as failed, count_if(page_id % 3 = 0) as with_warnings, coalesce(sum(case when page_id % 4 <> 0 then page_id end), 0)::bigint as bytes from pages")
def download_report(spark, d):
    warned = F.when(_p() % 3 == 0, F.array(F.lit("byte-estimate"))).otherwise(F.array().cast("array<string>"))
    return assets.report_summary(table(spark, d, "pages").select(F.when(_p() % 4 == 0, "failed").otherwise("downloaded").alias("status"), warned.alias("warnings"), F.when(_p() % 4 != 0, _p().cast("long")).alias("bytes")))


@query("select 'a.b' || page_id as asset_id, 'img/a.b' || page_id || '.png' as key, 'https://cdn.e.org/img/a.b' || page_id || '.png' as url from pages")
def upload_keys(spark, d):
    results = _entries(spark, d).select("asset_id", F.concat(F.lit("/x/y/"), "asset_id", F.lit(".png")).alias("path"))
    return writers.upload_map(results, "img/", "https://cdn.e.org/")


@query(f"""select u as url, min(page_id)::bigint as doc_id, 404 as status, false as is_error from (select page_id, 'https://e.org/' || (page_id % 30) as u from pages) where page_id % 30 % 3 = 0 group by u union all select u, min(page_id)::bigint, null, true from (select page_id, 'https://e.org/' || (page_id % 30) as u from pages) where page_id % 30 % 3 = 1 group by u""")
def broken_links(spark, d):
    """Each URL probed once, by a stand-in for the network that goes by the URL's number."""
    rows = table(spark, d, "pages").select(F.concat(F.lit("https://e.org/"), (_p() % 30).cast("string")).alias("url"), _p().cast("long").alias("doc_id"))
    return assets.check_links(rows, lambda u: (404, None, 200)[int(u.rsplit("/", 1)[1]) % 3])


@query(f"""select {_SQL_ENTRY}, case when page_id % 4 = 3 then 'failed' else 'downloaded' end as status, case page_id % 4 when 0 then 1 when 1 then 2 when 2 then 1 else 3 end::int as attempts, case when page_id % 4 <> 3 then 10 end::bigint as bytes from pages""")
def fetched_files(spark, d):
    """Downloads with retries through a stand-in for the network: every fourth id fails once, another always."""
    tried: dict[str, int] = {}

    def get(url: str):
        k = int(url.split("/")[3]) % 4
        tried[url] = tried.get(url, 0) + 1
        if k == 3 or k == 1 and tried[url] == 1:
            return 503, b""
        return 200, (b"12345", b"67890")

    rows = assets.fetch(_entries(spark, d).drop("page_id"), get, wait=lambda s: None)
    return rows.select("asset_id", "url", "status", "attempts", F.octet_length("content").cast("long").alias("bytes"))
