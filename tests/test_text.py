from pyspark.sql import functions as F

from inkwell.functions import nlp, text, web


def one(spark, value, *columns):
    return tuple(spark.createDataFrame([(value,)], "v string").select(*columns).first())


def test_markdown(spark):
    md = "# Title\n\nSee [a](b) and ![c](d).\n\n- item one\n\nhttps://x.y/z done?"
    assert one(spark, md, text.strip_markdown(F.col("v"))) == ("Title. See a and .\nitem one. done?".replace("\n", " "),)
    found = one(spark, "[a](b) ![c](d) [![e](f)](g)", text.links(F.col("v")))[0]
    assert [x["url"] for x in found] == ["b", "d", "f"]
    assert one(spark, md, F.size(text.headings(F.col("v"))), text.image_count(F.col("v"))) == (1, 1)


def test_dates(spark):
    assert one(spark, "junejuly-2025.md", text.date_from_filename(F.col("v"))) == ("2025-06-01",)
    assert one(spark, "on-ai-part-2.md", text.date_from_filename(F.col("v"))) == (None,)
    assert one(spark, "may after june", text.last_month(F.col("v"))) == (6,)
    assert one(spark, "2025-01-03", text.coverage_month(F.col("v").cast("date"), F.lit("December 2024"), F.lit(""))) == ("2025-12",)


def test_numbers(spark):
    assert one(spark, "1.005", text.round_half_up(F.col("v").cast("double"), 100)) == (1.0,)
    assert one(spark, "running", text.syllables(F.col("v"))) == (2,)
    said = "the Rhythms yes yded yxes agreed tables bcdf éé naïveté queue eyes"
    each = sum(one(spark, w, text.syllables(F.col("v")))[0] for w in said.split())
    assert one(spark, said, text.text_syllables(F.col("v"))) == (each,)
    for x, want in ((1.005, 1.0), (1.015, 1.01), (2.5, 2.5), (0.125, 0.13), (-1.005, -1.0), (8.345, 8.35), (1.255, 1.25)):
        assert one(spark, str(x), text.to_fixed(F.col("v").cast("double"))) == (want,), x
    assert one(spark, "7", text.padded(F.col("v").cast("int"))) == ("007",)
    assert [list(r) for r in spark.createDataFrame([([],), (["a"],), (["a", "b", "c"],)], "v array<string>").select(F.size(text.bigrams(F.col("v")))).collect()] == [[0], [0], [2]]


def test_urls(spark):
    wrapped = "https://xcdn.com/image/fetch/w_100/https%3A%2F%2Fa.b%2Fc+d_30x40.png"
    assert one(spark, wrapped, web.direct(F.col("v"))) == ("https://a.b/c+d_30x40.png",)
    assert tuple(one(spark, "https://a.b/c_30x40.png", web.url_dimensions(F.col("v")))[0]) == (30, 40)
    assert one(spark, "data:xyz", web.absolute(F.col("v"))) == (None,)
    assert one(spark, "https://a.b/1 100w, https://a.b/2 300w", web.largest(web.srcset(F.col("v")))["url"]) == ("https://a.b/2",)
    assert one(spark, "iPad mobile", web.device(F.lit(""), F.col("v"))) == ("Mobile",)


def test_bytes(spark):
    png = b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR\0\0\x02\x80\0\0\x01\xe0"
    gif = b"GIF89a\x0a\0\x14\0\0\0\0"
    svg = b'<svg width="30" height="40"></svg>'
    rows = spark.createDataFrame([(png,), (gif,), (svg,), (b"short",)], "content binary").select(web.sniff(F.col("content"), F.lit(None).cast("string")).alias("k"), "content")
    got = rows.select("k", web.image_size("content", "k").alias("s")).select("k", "s.width", "s.height").collect()
    assert [tuple(r) for r in got] == [("image/png", 640, 480), ("image/gif", 10, 20), ("image/svg+xml", 30, 40), (None, None, None)]


def test_nlp():
    assert [nlp.porter(w) for w in "caresses ponies relational hopping happiness".split()] == ["caress", "poni", "relat", "hop", "happi"]
    assert round(nlp.jaro_winkler("martha", "marhta"), 4) == 0.9611
