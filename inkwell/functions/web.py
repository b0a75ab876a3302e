"""URLs, image elements and image bytes as Column expressions; an HTML parser where those can't do."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: what marks a content-delivery URL that wraps its origin.
WRAPPED = "cdn.com/image/fetch/"
_TYPES = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "webp": "image/webp", "gif": "image/gif", "heic": "image/heic", "avif": "image/avif"}


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def domain(url: Column) -> Column:
    return F.coalesce(host(url), url)


def is_self(url: Column, own: str) -> Column:
    return F.coalesce(F.contains(host(url), F.lit(own)), F.lit(False))


def valid_url(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("PROTOCOL")).isNotNull()


def feed_url(url: Column) -> Column:
    bare = F.regexp_replace(F.trim(url), "/$", "")
    return F.when(bare.contains("www."), bare).otherwise(F.regexp_replace(bare, "^(https?://)", "$1www."))


def decoded(text: Column) -> Column:
    """Percent escapes decoded; a plus sign stays, bad escapes give null."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def unwrapped(url: Column) -> Column:
    """The origin inside a content-delivery URL, else null."""
    coded, plain = F.regexp_extract(url, r"(?i)/(https?%3A%2F%2F.+)$", 1), F.regexp_extract(url, r"(?i)/(https?://.+)$", 1)
    return F.when(url.contains(WRAPPED), F.when(coded != "", decoded(coded)).when(plain != "", plain))


def _bound(value: Column, f) -> Column:
    """f(value) with value computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def absolute(url: Column) -> Column:
    """A trimmed http or https URL; an empty path becomes /; others are null."""
    def checked(full: Column) -> Column:
        good = (full != "") & ~full.rlike("^(data|blob):") & F.lower(F.try_parse_url(full, F.lit("PROTOCOL"))).isin("http", "https")
        return F.when(good, F.regexp_replace(full, r"^(https?://[^/?#]+)$", "$1/"))

    return _bound(F.regexp_replace(F.trim(url), "^//", "https://"), checked)


def direct(url: Column) -> Column:
    return _bound(url, lambda u: absolute(F.coalesce(unwrapped(u), u)))


def url_dimensions(url: Column) -> Column:
    path = decoded(F.try_parse_url(url, F.lit("PATH")))
    part = lambda k: F.nullif(F.regexp_extract(path, r"_(\d+)x(\d+)(\.[^./]+)?$", k), F.lit("")).cast("long")
    return F.struct(part(1).alias("width"), part(2).alias("height"))


def url_mime(url: Column) -> Column:
    ending = F.lower(F.element_at(F.split(decoded(F.try_parse_url(url, F.lit("PATH"))), r"\."), -1))
    return F.element_at(F.create_map(*(F.lit(x) for pair in _TYPES.items() for x in pair)), ending)


def looks_like_image(url: Column) -> Column:
    real = F.coalesce(unwrapped(url), url)
    path = F.coalesce(F.try_parse_url(real, F.lit("PATH")), F.regexp_replace(real, "[?#].*$", ""))
    return real.rlike(r"(?i)post-media|cdn\.com/image/fetch|/public/images/") | path.rlike(r"(?i)\.(avif|bmp|gif|jpe?g|png|svg|tiff?|webp)$")


def css_urls(style: Column) -> Column:
    pattern = F.lit(r"(?i)url\(\s*[\"']?([^\"')]+)[\"']?\s*\)")
    return F.filter(F.transform(F.regexp_extract_all(style, pattern, 1), lambda u: F.trim(u)), lambda u: u != "")


def srcset(value: Column) -> Column:
    """Array of (url, descriptor, width, density)."""
    def parse(part: Column) -> Column:
        piece = F.split(F.trim(part), r"\s+", 2)
        mark = F.trim(F.get(piece, F.lit(1)))
        number = lambda unit: F.when(mark.rlike(rf"^[0-9.]+{unit}$"), F.regexp_replace(mark, unit, "").cast("double"))
        return F.struct(F.get(piece, F.lit(0)).alias("url"), mark.alias("descriptor"), number("w").alias("width"), number("x").alias("density"))

    return F.filter(F.transform(F.split(value, r",\s*(?=(?:https?:)?//)"), parse), lambda c: c["url"] != "")


def largest(candidates: Column) -> Column:
    """The widest candidate, or the densest if none has a width; the first of equals."""
    score = lambda c: F.coalesce(c["width"], c["density"], F.lit(0.0))
    wide = F.filter(candidates, lambda c: c["width"].isNotNull())
    pool = F.when(F.size(wide) > 0, wide).otherwise(candidates)
    best = F.array_max(F.transform(pool, score))
    return F.try_element_at(F.filter(pool, lambda c: score(c) == best), F.lit(1))


def canonical(plain: Column, meta_src: Column, src: Column, candidates: Column, linked: Column) -> Column:
    """(url, source): the first of five places that gives an absolute URL."""
    choices = ((plain, "data-attrs.srcNoWatermark"), (meta_src, "data-attrs.src"), (src, "img.src"), (_bound(candidates, largest)["url"], "largest-srcset-candidate"), (_bound(linked, lambda u: F.when(looks_like_image(u), u)), "linked-image.href"))
    pairs = F.array(*(F.struct(c.alias("url"), F.lit(name).alias("source")) for c, name in choices))
    found = F.transform(pairs, lambda p: F.struct(direct(p["url"]).alias("url"), p["source"].alias("source")))
    return F.get(F.filter(found, lambda p: p["url"].isNotNull()), F.lit(0))


#: What names of classes and ids say about an image.
_TRACKING = r"\b(tracking|tracker|beacon|pixel)\b"
_AVATAR = r"\b(avatar|profile[-_ ]?(photo|image)|user[-_ ]?(photo|image)|headshot)\b"
_CHROME = r"\b(publication[-_ ]?logo|newsletter[-_ ]?logo|brand[-_ ]?logo|app[-_ ]?icon)\b"


def classify(context: Column, width: Column, height: Column, embedded: Column) -> Column:
    low = F.lower(context)
    rules = (
        ((width <= 1) | (height <= 1), "tracking"),
        (low.rlike(_TRACKING), "tracking"),
        (low.rlike(_AVATAR), "avatar"),
        (embedded, "embed"),
        (low.rlike(_CHROME), "publication-chrome"),
    )
    out = F.lit("post-content")
    for rule, name in reversed(rules):
        out = F.when(F.coalesce(rule, F.lit(False)), name).otherwise(out)
    return out


def device(kind: Column, agent: Column) -> Column:
    low = F.lower(F.coalesce(agent, F.lit("")))
    given = F.trim(F.coalesce(kind, F.lit("")))
    return F.when(given != "", given).when(low.rlike("iphone|android|mobile"), "Mobile").when(low.rlike("ipad|tablet"), "Tablet").otherwise("Desktop/Other")


def mime(value: Column) -> Column:
    bare = F.lower(F.trim(F.get(F.split(value, ";"), F.lit(0))))
    return F.when(bare == "image/jpg", "image/jpeg").when(bare == "image/heif", "image/heic").otherwise(bare)


def sniff(content: Column, fallback: Column) -> Column:
    """An image's type by its first bytes, else an image type from a header."""
    at = lambda start, n: F.hex(F.substring(content, start, n))
    brand = F.decode(F.substring(content, 9, 4), "US-ASCII")
    box = at(5, 4) == F.lit("66747970")
    text = F.lower(F.decode(F.substring(content, 1, 1024), "ISO-8859-1"))
    given = mime(fallback)
    out = (
        F.when(F.octet_length(content) < 12, None)
        .when(at(1, 8) == "89504E470D0A1A0A", "image/png")
        .when(at(1, 3) == "FFD8FF", "image/jpeg")
        .when(at(1, 6).isin("474946383761", "474946383961"), "image/gif")
        .when((at(1, 4) == "52494646") & (at(9, 4) == "57454250"), "image/webp")
        .when(at(1, 2) == "424D", "image/bmp")
        .when(at(1, 4).isin("49492A00", "4D4D002A"), "image/tiff")
        .when(box & brand.isin("avif", "avis"), "image/avif")
        .when(box & brand.isin("heic", "heix", "hevc", "hevx", "mif1", "msf1"), "image/heic")
        .when(text.rlike(r"(?s)^\s*(<\?xml.*?)?(<!--.*?-->\s*)*<svg[\s>]"), "image/svg+xml")
    )
    return out.otherwise(F.when(given.startswith("image/"), given))


def _size(data: bytes, kind: str | None) -> tuple[int, int] | None:
    if kind == "image/png":
        return struct.unpack(">II", data[16:24])
    if kind == "image/gif":
        return struct.unpack("<HH", data[6:10])
    if kind == "image/bmp":
        w, h = struct.unpack("<ii", data[18:26])
        return w, abs(h)
    if kind == "image/jpeg":
        at = 2
        while at + 9 <= len(data):
            if data[at] != 0xFF:
                at += 1
                continue
            marker = data[at + 1]
            if marker == 0xFF or marker == 1 or 0xD0 <= marker <= 0xD9:
                at += 1 if marker == 0xFF else 2
            elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return w, h
            else:
                at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
        return None
    if kind == "image/webp":
        form = data[12:16]
        if form == b"VP8X":
            return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
        if form == b"VP8L":
            bits = int.from_bytes(data[21:25], "little")
            return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
        if form == b"VP8 ":
            w, h = struct.unpack("<HH", data[26:30])
            return w & 0x3FFF, h & 0x3FFF
        return None
    if kind in ("image/heic", "image/avif"):
        sizes, at = [], data.find(b"ispe")
        while at >= 0:
            if at + 16 <= len(data):
                sizes.append(struct.unpack(">II", data[at + 8 : at + 16]))
            at = data.find(b"ispe", at + 4)
        return max(sizes, key=lambda s: s[0] * s[1], default=None)
    if kind == "image/tiff":
        order = "<" if data[:2] == b"II" else ">"
        at = struct.unpack(order + "I", data[4:8])[0]
        found = {}
        for k in range(struct.unpack(order + "H", data[at : at + 2])[0]):
            tag, form = struct.unpack(order + "HH", data[at + 2 + 12 * k : at + 6 + 12 * k])
            value = data[at + 10 + 12 * k : at + 14 + 12 * k]
            found[tag] = struct.unpack(order + ("H" if form == 3 else "I"), value[: 2 if form == 3 else 4])[0]
        return (found[256], found[257]) if 256 in found and 257 in found else None
    if kind == "image/svg+xml":
        import re

        head = re.search(r"<svg[^>]*>", data.decode("utf8", "replace"), re.S | re.I)
        pick = lambda name: re.search(rf"""\b{name}=["']([\d.]+)""", head[0], re.I) if head else None
        w, h = pick("width"), pick("height")
        if w and h:
            return round(float(w[1])), round(float(h[1]))
        box = re.search(r"""viewBox=["']([-\d.\s,]+)""", head[0], re.I) if head else None
        part = box[1].replace(",", " ").split() if box else []
        return (round(float(part[2])), round(float(part[3]))) if len(part) == 4 else None
    return None


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def image_size(content: pd.Series, kind: pd.Series) -> pd.DataFrame:
    """Width and height from an image's bytes; null where they can't be told."""
    rows = []
    for data, k in zip(content, kind, strict=True):
        try:
            rows.append(_size(data, k) or (None, None))
        except (struct.error, IndexError, ValueError, TypeError):
            rows.append((None, None))
    return pd.DataFrame(rows, columns=["width", "height"]).astype("Int32")


class _Markdown(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out: list[str] = []
        self.href: list[str] = []
        self.mute = 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in ("script", "style", "head"):
            self.mute += 1
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("p", "div", "article", "ul", "ol"):
            self.out.append("\n\n")
        elif tag == "br":
            self.out.append("\n")
        elif tag == "li":
            self.out.append("\n- ")
        elif tag == "a":
            self.href.append(a.get("href") or "")
            self.out.append("[")
        elif tag == "img":
            self.out.append(f"![{a.get('alt') or ''}]({a.get('src') or ''})")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "head"):
            self.mute = max(0, self.mute - 1)
        elif tag == "a" and self.href:
            self.out.append(f"]({self.href.pop()})")

    def handle_data(self, data):
        if not self.mute:
            self.out.append(" ".join(data.split()) if data.strip() else " ")


def to_markdown(html: str | None) -> str:
    parser = _Markdown()
    parser.feed(html or "")
    parser.close()
    lines = "".join(parser.out).split("\n")
    return "\n".join(x.strip() for x in lines).strip()


@F.pandas_udf(T.StringType())
def html_to_markdown(html: pd.Series) -> pd.Series:
    return html.map(to_markdown)


_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Elements(HTMLParser):
    """Image-bearing elements with what their ancestors say."""

    def __init__(self):
        super().__init__()
        self.stack: list[tuple[str, dict]] = []
        self.rows: list[dict] = []
        self.sources: list[str] = []

    def _row(self, kind: str, a: dict, url: str | None) -> dict:
        up = self.stack[-1][1] if self.stack else {}
        names = [kind, *(a.get(k) or "" for k in ("id", "class", "alt")), *(up.get(k) or "" for k in ("id", "class"))]
        marks = [f"{t.get('class') or ''} {t.get('data-component-name') or ''}".lower() for _, t in self.stack]
        linked = next((t.get("href") for name, t in reversed(self.stack) if name == "a" and t.get("href")), None)
        number = lambda v: float(v) if v and v.replace(".", "", 1).isdigit() else None
        return {"kind": kind, "url": url, "srcset": a.get("srcset"), "picture": ", ".join(self.sources) or None, "linked": linked, "data_attrs": a.get("data-attrs"), "alt": a.get("alt"), "context": " ".join(names), "width": number(a.get("width")), "height": number(a.get("height")), "embedded": any(w in m for m in marks for w in ("youtube", "twitter-tweet", "spotify", "podcast", "embed"))}

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "source" and any(t == "picture" for t, _ in self.stack) and a.get("srcset"):
            self.sources.append(a["srcset"])
        elif tag == "img":
            self.rows.append(self._row("img", a, a.get("src")))
        elif tag == "video" and a.get("poster"):
            self.rows.append(self._row("video-poster", a, a["poster"]))
        elif tag == "image" and (a.get("href") or a.get("xlink:href")):
            self.rows.append(self._row("svg-image", a, a.get("href") or a.get("xlink:href")))
        elif tag == "a" and a.get("href"):
            a["_"] = self._row("image-link", a, a["href"]) | {"linked": a["href"]}
            a["_at"] = len(self.rows)
        if a.get("style"):
            self.rows.append(self._row("css-background", a, a["style"]))
        if tag not in _VOID:
            self.stack.append((tag, a))

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.stack):
            while True:
                name, a = self.stack.pop()
                if name == "picture":
                    self.sources = []
                if name == "a" and "_" in a and not any(r["kind"] == "img" for r in self.rows[a["_at"] :]):
                    self.rows.append(a["_"])
                if name == tag:
                    break


_FAMILIES = ("img", "css-background", "image-link", "video-poster", "svg-image")


def elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For mapInPandas over (doc_id, html): a row per element, numbered in its document by family, then place."""
    columns = ["doc_id", "ordinal", "kind", "url", "srcset", "picture", "linked", "data_attrs", "alt", "context", "width", "height", "embedded"]
    for batch in batches:
        rows = []
        for doc_id, html in zip(batch["doc_id"], batch["html"], strict=True):
            parser = _Elements()
            parser.feed(html or "")
            parser.close()
            while parser.stack:
                parser.handle_endtag(parser.stack[-1][0])
            ordered = sorted(parser.rows, key=lambda r: _FAMILIES.index(r["kind"]))
            rows += [{"doc_id": doc_id, "ordinal": k} | r for k, r in enumerate(ordered, 1)]
        yield pd.DataFrame(rows, columns=columns)


ELEMENTS = "doc_id long, ordinal int, kind string, url string, srcset string, picture string, linked string, data_attrs string, alt string, context string, width double, height double, embedded boolean"


def json_ld(html: Column) -> Column:
    """(published, headline, description) from linked-data blocks, the last that has a field; meta tags as fallback."""
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1)
    last = lambda path: F.try_element_at(F.filter(F.transform(blocks, lambda b: F.get_json_object(b, path)), lambda v: v.isNotNull()), F.lit(-1))
    meta = lambda name: F.nullif(F.regexp_extract(html, rf"""(?i)<meta[^>]*property=["']{name}["'][^>]*content=["']([^"']*)""", 1), F.lit(""))
    return F.struct(F.coalesce(last("$.datePublished"), meta("article:published_time")).alias("published"), F.coalesce(last("$.headline"), meta("og:title")).alias("headline"), last("$.description").alias("description"))


def object_attrs(text: Column) -> Column:
    """A JSON object as a string map; anything else is null."""
    return F.when(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.from_json(text, "map<string,string>"))


def retry_delay_ms(attempt: Column, retry_after_s: Column) -> Column:
    """A server's wish, or doubling from half a second to ten; a minute at most."""
    wish = F.when(retry_after_s.isNotNull(), retry_after_s * 1000)
    return F.least(F.coalesce(wish, F.least(F.lit(500) * F.pow(F.lit(2), attempt - 1), F.lit(10_000))), F.lit(60_000)).cast("long")


