"""Image assets: inventory, first-wins duplicates, verification of downloads, resumption, link probes."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import web


_CANDIDATES = "array<struct<url:string,descriptor:string,width:double,density:double>>"


def references(src: Column, srcset: Column, pictures: Column, linked: Column, attrs: Column) -> Column:
    """All places that name an element's image, in order, as distinct (source, url) pairs."""
    named = lambda source, urls: F.transform(F.coalesce(urls, F.array().cast("array<string>")), lambda u: F.struct(F.lit(source).alias("source"), u.alias("url")))
    urls = lambda c: F.transform(c, lambda x: x["url"])
    parts = [named("img.src", F.array(src)), named("img.srcset", urls(srcset)), named("picture.source.srcset", urls(pictures)), named("linked-image.href", F.array(linked))]
    parts += [named(f"data-attrs.{k}", F.array(attrs[k])) for k in ("srcNoWatermark", "src", "href", "internalRedirect")]
    return F.array_distinct(F.filter(F.concat(*parts), lambda r: F.coalesce(r["url"], F.lit("")) != ""))


def inventory(pages: DataFrame, id_column: str = "page_id", html: str = "html") -> DataFrame:
    """A row per image-bearing element of each page: its canonical URL and source, class, sizes, type and all references to it."""
    rows = pages.select(F.col(id_column).cast("long").alias("doc_id"), F.col(html).alias("html")).mapInPandas(web.elements, web.ELEMENTS)
    none = F.array().cast(_CANDIDATES)
    rows = rows.withColumn("attrs", web.object_attrs(F.col("data_attrs"))).withColumns({f"{c}_": F.coalesce(web.srcset(F.col(c)), none) for c in ("srcset", "picture")})
    rows = rows.withColumn("candidates", F.concat("srcset_", "picture_"))
    rows = rows.where((F.col("kind") != "image-link") | web.looks_like_image(F.col("url")))
    src = F.when(F.col("kind") == "css-background", F.get(web.css_urls(F.col("url")), F.lit(0))).otherwise(F.col("url"))
    rows = rows.where(src.isNotNull() | (F.col("kind") != "css-background"))
    attrs = F.col("attrs")
    number = lambda k: attrs[k].try_cast("double")
    name = F.concat_ws("-", F.col("doc_id"), F.substring(F.regexp_replace("kind", "[^a-z]", ""), 1, 6), F.format_string("%03d", "ordinal"))
    kind = web.classify(F.col("context"), F.coalesce(number("width"), F.col("width")), F.coalesce(number("height"), F.col("height")), F.col("embedded"))
    rows = rows.withColumn("found", web.canonical(attrs["srcNoWatermark"], attrs["src"], src, F.col("candidates"), F.col("linked")))
    url = F.col("found.url")
    return rows.select(
        name.alias("asset_id"), "doc_id", "ordinal", "kind", url.alias("url"), F.col("found.source").alias("url_source"), kind.alias("class"), web.host(url).alias("host"), F.coalesce(attrs["type"], web.url_mime(url)).alias("mime"),
        F.when(url.isNull(), "unresolved").otherwise("listed").alias("status"), F.array_max(F.transform("candidates", lambda c: c["width"])).alias("max_width"), F.coalesce(src, F.lit("")).alias("original"), "srcset", F.col("linked").alias("linked_url"),
        "alt", F.col("width").alias("declared_width"), F.col("height").alias("declared_height"), number("width").alias("metadata_width"), number("height").alias("metadata_height"), number("resizeWidth").alias("resize_width"), number("bytes").alias("byte_estimate"),
        references(src, F.col("srcset_"), F.col("picture_"), F.col("linked"), attrs).alias("references"),
    )


def cover_assets(posts: DataFrame) -> DataFrame:
    """A cover for each post (doc_id, cover, post_url) of an archive, in the columns that covers share with the inventory."""
    url, size = web.direct(F.col("cover")), web.url_dimensions(web.direct(F.col("cover")))
    refs = F.filter(F.array(F.struct(F.lit("archive.cover_image").alias("source"), F.col("cover").alias("url"))), lambda r: F.coalesce(r["url"], F.lit("")) != "")
    return posts.select(
        F.concat_ws("-", F.col("doc_id"), F.lit("cover"), F.lit("001")).alias("asset_id"), "doc_id", F.lit(1).alias("ordinal"), F.lit("post-cover").alias("kind"), url.alias("url"), F.lit("archive.cover_image").alias("url_source"), F.lit("post-cover").alias("class"),
        web.host(url).alias("host"), web.url_mime(url).alias("mime"), F.when(url.isNull(), "unresolved").otherwise("listed").alias("status"), F.coalesce("cover", F.lit("")).alias("original"), F.col("post_url").alias("linked_url"),
        size["width"].cast("double").alias("metadata_width"), size["height"].cast("double").alias("metadata_height"), refs.alias("references"),
    )


def manifest(pages: DataFrame, posts: DataFrame) -> DataFrame:
    """Body images and covers as one table; the first asset with a URL, by document and place, is what later ones duplicate."""
    rows = inventory(pages).unionByName(cover_assets(posts), allowMissingColumns=True)
    return mark_duplicates(rows, "url", ["doc_id", "kind", "ordinal"], "asset_id")


def mark_duplicates(rows: DataFrame, key: str, order: list[str], name: str, out: str = "duplicate_of") -> DataFrame:
    """Adds the name of the first row with the same key; null for that row and for null keys."""
    first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order, F.col(name).alias("name_"))).alias("first_")).select(key, F.col("first_.name_").alias("first_"))
    joined = rows.join(first, key, "left")
    return joined.withColumn(out, F.when(F.col("first_") != F.col(name), F.col("first_"))).drop("first_")


def manifest_summary(assets: DataFrame, pages: DataFrame, posts: DataFrame) -> DataFrame:
    """One row of counts: pages and posts scanned, covers, posts without one, assets, distinct URLs, duplicates and unresolved ones."""
    cover = F.col("kind") == "post-cover"
    counts = assets.agg(F.count_if(cover).alias("covers"), F.count("*").alias("listed"), F.count_distinct("url").alias("unique_urls"), F.count("duplicate_of").alias("duplicates"), F.count_if(F.col("status") == "unresolved").alias("unresolved"))
    scanned = pages.agg(F.count("*").alias("pages")).crossJoin(posts.agg(F.count("*").alias("posts"), F.count_if(F.coalesce("cover", F.lit("")) == "").alias("without_cover")))  # one row each
    return scanned.crossJoin(counts)


def count_by(rows: DataFrame, keys: dict[str, Column]) -> DataFrame:
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.coalesce(c.cast("string"), F.lit("(unresolved)")).alias("value")) for k, c in keys.items())))
    return rows.select(pairs.alias("x")).groupBy("x.kind", "x.value").agg(F.count("*").alias("n"))


def verify(rows: DataFrame) -> DataFrame:
    """Adds what a download says about its promise: tri-state matches, a label for dimensions, and warnings.

    Reads bytes, width, height, mime, content_length, expected_bytes, expected_mime, expected_width, expected_height
    and max_width.
    """
    w, h, ew, eh, most = (F.col(c) for c in ("width", "height", "expected_width", "expected_height", "max_width"))
    label = (
        F.when(w.isNull() | h.isNull(), "dimensions-unavailable")
        .when(ew.isNotNull() & eh.isNotNull(), F.when((w == ew) & (h == eh), "matches-url-dimensions").when((w == eh) & (h == ew), "matches-url-dimensions-rotated").otherwise("url-dimensions-mismatch"))
        .when(most.isNotNull(), F.when(w >= most, "at-least-largest-advertised-width").otherwise("smaller-than-largest-advertised-width"))
        .otherwise("dimensions-detected")
    )
    out = rows.withColumn("length_matches", F.col("content_length") == F.col("bytes")).withColumn("bytes_match", F.col("expected_bytes") == F.col("bytes")).withColumn("mime_matches", web.mime(F.col("expected_mime")) == F.col("mime")).withColumn("dimensions", label)
    said = ((~F.col("length_matches"), "content-length"), (~F.col("bytes_match"), "byte-estimate"), (~F.col("mime_matches"), "mime-type"), (F.col("dimensions") == "url-dimensions-mismatch", "url-dimensions"), (F.col("dimensions") == "smaller-than-largest-advertised-width", "small-width"), (F.col("dimensions") == "dimensions-unavailable", "no-dimensions"))
    return out.withColumn("warnings", F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(x)) for c, x in said))))


def inspect(files: DataFrame) -> DataFrame:
    """path, bytes, sha256, mime, width and height of binary files (path, content, optionally a mime header)."""
    header = F.col("header") if "header" in files.columns else F.lit(None).cast("string")
    kind = web.sniff(F.col("content"), header)
    size = web.image_size("content", "mime")
    return files.withColumn("mime", kind).withColumn("size_", size).select("path", F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"), "mime", "size_.width", "size_.height")


def metadata_for(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """Download entries with their manifest row, if it names the same URL or none; else defaults read off the URL."""
    m = manifest.select("asset_id", F.col("url").alias("m_url"), F.col("mime").alias("m_mime"), "max_width", F.lit(True).alias("m_"))
    joined = entries.join(m, "asset_id", "left").withColumn("ok_", F.coalesce(F.col("m_") & (F.col("m_url").isNull() | (F.col("m_url") == F.col("url"))), F.lit(False)))
    size = web.url_dimensions(F.col("url"))
    return joined.select("asset_id", "url", F.coalesce(F.when(F.col("ok_"), F.col("m_mime")), web.url_mime(F.col("url"))).alias("expected_mime"), size["width"].alias("expected_width"), size["height"].alias("expected_height"), F.when(F.col("ok_"), F.col("max_width")).alias("max_width"))


def reusable(entries: DataFrame, prior: DataFrame, files: DataFrame) -> DataFrame:
    """Entries whose file is still what a prior report recorded for the same URL (by hash), or else merely exists; parts of downloads don't count."""
    named = files.withColumn("asset_id", F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^(.*)\.[^.]+$", 1)).where(~F.col("path").contains(".part-"))
    p = prior.select("asset_id", F.col("url").alias("p_url"), F.col("sha256").alias("p_sha"))
    out = entries.join(p, "asset_id", "left").join(named.select("asset_id", "path", F.col("sha256").alias("f_sha"), F.col("mime").alias("f_mime")), "asset_id")
    same = F.coalesce((F.col("p_url") == F.col("url")) & (F.col("p_sha") == F.col("f_sha")), F.lit(False))
    return out.where((F.col("p_url").isNull() | (F.col("p_url") == F.col("url"))) & F.col("f_mime").isNotNull()).select("asset_id", "url", "path", same.alias("hash_matches"))


def report_summary(results: DataFrame) -> DataFrame:
    return results.agg(F.count("*").alias("n"), F.count_if(F.col("status") == "downloaded").alias("downloaded"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.size("warnings") > 0).alias("with_warnings"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def check_links(links: DataFrame, probe: Callable[[str], int | None]) -> DataFrame:
    """(url, doc_id, status, is_error) of links that fail: each http URL is probed once, at its first place.

    probe gives a status, or None for an error, and is called from the partitions.
    """
    first = links.where(F.col("url").startswith("http")).groupBy("url").agg(F.min("doc_id").alias("doc_id"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            status = [probe(u) for u in batch["url"]]
            out = batch.assign(status=pd.array(status, dtype="Int32"), is_error=[s is None for s in status])
            yield out[[s is None or s >= 400 for s in status]]

    return first.mapInPandas(run, "url string, doc_id long, status int, is_error boolean")


def _body(data: bytes | Iterable[bytes], limit: int) -> bytes | None:
    """A body of limit bytes at most; reading stops at the chunk that goes beyond."""
    held = bytearray()
    for chunk in (data,) if isinstance(data, bytes) else data:
        held += chunk
        if len(held) > limit:
            return None
    return bytes(held)


def fetch(entries: DataFrame, get: Callable[[str], tuple[int, bytes | Iterable[bytes]]], tries: int = 3, limit: int = 100 << 20, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """Downloads through get(url) -> (status, body or its chunks) with retries of 408, 429, 5xx and errors; over limit fails.

    Between tries it waits half a second, doubled each time up to ten.
    """

    def one(url: str) -> tuple[str, int, bytes | None]:
        for attempt in range(1, tries + 1):
            try:
                status, data = get(url)
                if status < 400:
                    body = _body(data, limit)
                    return ("failed" if body is None else "downloaded"), attempt, body
                if status not in (408, 429) and status < 500:
                    return "failed", attempt, None
            except OSError:
                pass
            if attempt < tries:
                wait(min(0.5 * 2 ** (attempt - 1), 10.0))
        return "failed", tries, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(len(batch)):  # a body at a time
                row = batch.iloc[k : k + 1]
                status, attempts, body = one(row["url"].iloc[0])
                yield row.assign(status=status, attempts=attempts, content=[body])

    return entries.select("asset_id", "url").mapInPandas(run, "asset_id string, url string, status string, attempts int, content binary")


def new_links(feed: DataFrame, known: DataFrame) -> DataFrame:
    return feed.select(web.feed_url(F.col("url")).alias("url")).join(known.select(web.feed_url(F.col("url")).alias("url")), "url", "left_anti")
