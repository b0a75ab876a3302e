import pytest
from pyspark.sql import functions as F

from inkwell.operators import assets, corpus, engagement
from inkwell.sources import readers, writers
from inkwell.streaming import links


def test_growth_and_similarity(spark):
    docs = spark.createDataFrame([(0, "alpha beta gamma", "s"), (1, "alpha beta gamma", "s"), (2, "delta alpha", "t"), (3, None, "t")], "doc_id long, text string, source string")
    got = [tuple(r) for r in corpus.vocabulary_growth(docs).orderBy("doc_id").collect()]
    assert got == [(0, 3, 3), (1, 0, 3), (2, 1, 4), (3, 0, 4)]
    m = {(r["a"], r["b"]): r["similarity"] for r in corpus.similarity_matrix(docs).collect()}
    assert len(m) == 16 and m[0, 0] == 1.0 and m[0, 1] == m[1, 0] == 1.0 and m[0, 3] == 0.0
    assert [(r["a"], r["b"]) for r in corpus.similar_documents(docs, 0.9).collect()] == [(0, 1)]


def test_engagement(spark):
    posts = spark.createDataFrame([("1", "true", "2024-01-01 00:00:00", ""), ("2", "true", "", ""), ("3", "false", "", "")], "post_id string, is_published string, email_sent_at string, post_date string")
    sent = spark.createDataFrame([("1", "true"), ("1", "false"), ("1", "true")], "post_id string, active_subscription string")
    opens = spark.createDataFrame([("1", "a", "2024-01-01 00:30:00"), ("1", "a", "2024-01-01 00:40:00"), ("1", "", "2024-01-01 01:30:00")], "post_id string, email string, timestamp string")
    got = {r["post_id"]: r for r in engagement.post_engagement(posts, sent, opens).collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"]["delivered"], got["1"]["active"], got["1"]["opens"], got["1"]["unique_opens"], got["1"]["open_rate"], got["1"]["open_lag_minutes"]) == (3, 2, 3, 1, 0.333, 30.0)
    assert (got["2"]["delivered"], got["2"]["open_rate"]) == (0, None)


def test_assets(spark):
    html = '<div class="avatar"><img src="https://a.b/1.png" width="40"></div><a href="https://a.b/big.jpg"><picture><source srcset="https://a.b/2.webp 2x"><img src="//a.b/2.png"></picture></a><a href="https://a.b/x.jpg">x</a><img src="https://a.b/1.png" width="1"><p style="background:url(https://a.b/s.gif)">'
    rows = assets.mark_duplicates(assets.inventory(spark.createDataFrame([(5, html)], "page_id long, html string")), "url", ["doc_id", "ordinal"], "asset_id").orderBy("ordinal").collect()
    assert [(r["kind"], r["url"], r["class"], r["duplicate_of"]) for r in rows] == [
        ("img", "https://a.b/1.png", "avatar", None), ("img", "https://a.b/2.png", "post-content", None), ("img", "https://a.b/1.png", "tracking", "5-img-001"),
        ("css-background", "https://a.b/s.gif", "post-content", None), ("image-link", "https://a.b/x.jpg", "post-content", None),
    ]


def test_probe_and_fetch(spark):
    rows = spark.createDataFrame([("http://a", 2), ("http://a", 1), ("http://b", 1), ("mailto:x", 1)], "url string, doc_id long")
    got = assets.check_links(rows, lambda u: 404 if u.endswith("a") else 200).collect()
    assert [(r["url"], r["doc_id"], r["status"]) for r in got] == [("http://a", 1, 404)]
    entries = spark.createDataFrame([("1", "http://a")], "asset_id string, url string")
    fetched = lambda get, **more: [(r["status"], r["attempts"], r["content"]) for r in assets.fetch(entries, get, wait=lambda s: None, **more).collect()]
    assert fetched(lambda u: (503, b"")) == [("failed", 3, None)] and fetched(lambda u: (404, b"")) == [("failed", 1, None)]
    assert fetched(lambda u: (200, (b"ab", b"cd"))) == [("downloaded", 1, b"abcd")]

    def endless(u):
        def chunks():
            yield b"12345"
            yield b"67890"
            raise AssertionError("read on beyond the limit")

        return 200, chunks()

    assert fetched(endless, limit=8) == [("failed", 1, None)]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "1.opens.csv").write_text('email,note\na@b,"x ""q"", y\nz"\n\nc@d\n')
    rows = sorted(tuple(r) for r in readers.per_post_csv(spark, str(tmp_path / "*.opens.csv"), ["email", "note"]).collect())
    assert rows == [("1", "a@b", 'x "q", y\nz'), ("1", "c@d", "")]
    (tmp_path / "md").mkdir()
    for name, body in (("may-2023.md", "m"), ("june-2022.md", "j"), ("zz.md", "z")):
        (tmp_path / "md" / name).write_text(body)
    posts = readers.markdown_folder(spark, str(tmp_path / "md"))
    assert writers.combined_markdown(posts).first()[0] == "# june-2022\n\nj\n\n---\n\n# may-2023\n\nm\n\n---\n\n# zz\n\nz"
    flat = readers.markdown_folder(spark, str(tmp_path / "md"), recursive=False, leave_out=("zz.md",))
    assert sorted(r["filename"] for r in flat.collect()) == ["june-2022.md", "may-2023.md"]
    (tmp_path / "html").mkdir()
    with pytest.raises(ValueError, match="no HTML"):
        readers.html_folder(spark, str(tmp_path / "html"))
    for name in ("10.b.html", "9.a.HTML", "x.txt"):
        (tmp_path / "html" / name).write_text("<p>")
    assert [(r["post_id"], r["slug"]) for r in readers.html_folder(spark, str(tmp_path / "html")).orderBy("number").collect()] == [("9", "a"), ("10", "b")]
    (tmp_path / "list.tsv").write_text("a1\thttps://a.b/c\n")
    assert [tuple(r) for r in readers.download_list(spark, str(tmp_path / "list.tsv")).collect()] == [("a1", "https://a.b/c")]


def test_csv_columns_go_by_the_header(spark, tmp_path):
    (tmp_path / "1.x.csv").write_text("b,a\nB1,A1\n")
    (tmp_path / "2.x.csv").write_text("more,a,b,more\nm,A2,B2,m\n,A3\n")
    (tmp_path / "3.x.csv").write_text("\ufeffa\nA4\n")
    (tmp_path / "4.x.csv").write_text("")
    read = lambda df: sorted(tuple(r) for r in df.collect())
    assert read(readers.export_csv(spark, str(tmp_path / "1.x.csv"), ["a", "b"])) == [("A1", "B1")]
    assert read(readers.per_post_csv(spark, str(tmp_path / "*.x.csv"), ["a", "b"])) == [("1", "A1", "B1"), ("2", "A2", "B2"), ("2", "A3", ""), ("3", "A4", "")]


@pytest.mark.parametrize(("lines", "message"), [("a\thttps://a.b\n\nb\tftp://x\n", "line 3"), ("a\thttps://a.b\na\thttps://a.c\n", "repeated asset id: a"), ("\n", "no downloads"), ("a https://a.b\n", "line 1")])
def test_bad_download_lists(spark, tmp_path, lines, message):
    (tmp_path / "list.tsv").write_text(lines)
    with pytest.raises(ValueError, match=message):
        readers.download_list(spark, str(tmp_path / "list.tsv"))


def test_optional_and_json(spark, tmp_path):
    assert readers.optional(spark, str(tmp_path / "none"), "a string", lambda p: None).count() == 0
    (tmp_path / "x.json").write_text('[{"a": "1"}, {"a": "2"}]')
    assert readers.optional(spark, str(tmp_path / "x.json"), "a string", lambda p: readers.json_array(spark, p, "a string")).count() == 2
    (tmp_path / "bin").mkdir()
    (tmp_path / "bin" / "f").write_bytes(b"abc")
    assert readers.binaries(spark, str(tmp_path / "bin")).count() == 1 and readers.binaries(spark, str(tmp_path / "bin"), limit=2).count() == 0


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("https://www.a.b/x/\nhttps://a.b/x\nhttps://a.b/y\n")
    stream = links.link_stream(spark, str(tmp_path / "in"), spark.createDataFrame([("https://a.b/y",)], "url string"))
    q = stream.writeStream.format("memory").queryName("fresh").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [r[0] for r in spark.sql("select url from fresh").collect()] == ["https://www.a.b/x"]


def test_catalogue_imports_without_llm():
    import __spark_entry__ as e
    from inkwell.plans import archive, catalog, media

    assert set(catalog.ORACLES) <= set(catalog.QUERIES) <= set(e.queries())
    assert archive.cleaned_texts is catalog.QUERIES["cleaned_texts"] and media.url_shapes is catalog.QUERIES["url_shapes"]
