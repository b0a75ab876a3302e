"""Queries over the driver's tables: each applies an operator to a whole table, with SQL to hold it against.

Substitutions: posts are documents in order of doc_id (their group is source), pages are raw pages, opens are events
(email: user_id, timestamp: ts, client: event_type), sign-ups and dated metrics are orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nlp, text, web
from ..functions.constants import ALL_STOP_WORDS, NEGATIONS, SENTIMENT, STOP_WORDS
from ..functions.text import round_half_up
from ..operators import assets, corpus, engagement
from ..streaming import links

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"))


#: Bytes of a table up to which one shuffle of it costs less than the cores that idle while few tasks read it.
SMALL = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """df dealt over all cores if it is small: a file of one row group is read by one task, whatever the number of cores."""
    spark = df.sparkSession
    small = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= SMALL
    return df.repartition(spark.sparkContext.defaultParallelism) if small else df


# SQL pieces
def _list(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{text.BREAKS}'), lambda x: x <> '')"


def _strip(x: str) -> str:
    for pattern, by in ((r"!\[([^\]]*)\]\(([^)]+)\)", ""), (r"<img[^>]+>", ""), (r"\[([^\]]+)\]\(([^)]+)\)", r"\1"), (r"https?:\/\/\S+", ""), (r"[#*`_~>|]", ""), (r"(?m)^-{3,}$", ""), (r"(?m)^\s*[-*+]\s+", ""), (r"(?m)^\s*\d+\.\s+", ""), (r"\n{2,}", ". "), (r"\s+", " ")):
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'g')"
    return f"trim({x})"


T = "coalesce(text, '')"
TOKENS = f"select doc_id, source, unnest(list_filter(list_transform({_words(_strip(T))}, lambda x: lower(x)), lambda x: length(x) > 2 and x not in {_list(ALL_STOP_WORDS)})) as token from documents"


def _half(x: str, k: int) -> str:
    return f"floor(({x})::double * {k} + 0.5) / {k}::double"


WEIGHTS = f"""t as ({TOKENS}), tf as (select doc_id, token, count(*) as tf from t group by all), df as (select token, count(*) as df from tf group by token),
w as (select doc_id, token, tf * (1 + ln((select count(*) from documents)::double / (1 + df))) as x from tf join df using (token))"""


@query(f"select doc_id, len(w)::bigint as n_tokens, len(list_distinct(w))::bigint as n_distinct from (select doc_id, {_words(T)} as w from documents)")
def tokens_per_doc(spark, d):
    return corpus.tokens_per_doc(docs(spark, d))


@query(f"""select (select count(*) from documents) as n_docs, count(*) as n_words, count(distinct w) as n_distinct, {_half('count(*)::double / (select count(*) from documents)', 1000)} as mean_words,
{_half('sum(length(w))::double / count(*)', 1000)} as mean_length, {_half('count(distinct w)::double / count(*)', 1000)} as type_token from (select unnest({_words(T)}) as w from documents)""")
def corpus_stats(spark, d):
    return corpus.corpus_stats(docs(spark, d))


@query(f"select word, count(*) as n from (select unnest({_words(f'lower({T})')}) as word from documents) where length(word) > 3 and word not in {_list(STOP_WORDS)} group by word order by n desc, word limit 20")
def top_words(spark, d):
    return corpus.top_words(docs(spark, d))


@query(f"""select bigram, count(*) as n from (select w[i] as a, w[i + 1] as b, w[i] || ' ' || w[i + 1] as bigram from (select w, unnest(range(1, len(w))) as i from (select {_words(f'lower({T})')} as w from documents)))
where a not in {_list(STOP_WORDS)} and b not in {_list(STOP_WORDS)} group by bigram order by n desc, bigram limit 15""")
def top_bigrams(spark, d):
    return corpus.top_bigrams(docs(spark, d))


@query(f"with {WEIGHTS}, r as (select doc_id, token, {_half('x', 1000)} as tfidf from w) select doc_id, token, tfidf, rank from (select *, row_number() over (partition by doc_id order by tfidf desc, token) as rank from r) where rank <= 10")
def tfidf_top_terms(spark, d):
    return corpus.top_terms(docs(spark, d))


@query(f"""with {WEIGHTS}, v as (select doc_id, token, x / sqrt(sum(x * x) over (partition by doc_id)) as x from w),
p as (select a.doc_id as a, b.doc_id as b, {_half('sum(a.x * b.x)', 1000)} as similarity from v a join v b on a.token = b.token and a.doc_id < b.doc_id group by all) select * from p where similarity >= 0.5""")
def doc_similarity(spark, d):
    return corpus.similar_documents(docs(spark, d))


@query(f"""with t as ({TOKENS}), f as (select token, min(doc_id) as doc_id from t group by token), n as (select doc_id, count(*) as n from f group by doc_id)
select d.doc_id, coalesce(n, 0) as new_tokens, sum(coalesce(n, 0)) over (order by d.doc_id)::bigint as vocabulary from documents d left join n using (doc_id)""")
def vocab_growth(spark, d):
    return corpus.vocabulary_growth(docs(spark, d))


@query(f"""with t as ({TOKENS}), f as (select source, token, min(doc_id) as doc_id from t group by all), n as (select source, doc_id, count(*) as n from f group by all)
select d.source, d.doc_id, coalesce(n, 0) as new_tokens, sum(coalesce(n, 0)) over (partition by d.source order by d.doc_id)::bigint as vocabulary from documents d left join n using (source, doc_id) where d.source is not null""")
def vocab_growth_by_group(spark, d):
    return corpus.vocabulary_growth(docs(spark, d), "source")


_SYLLABLES = "case when length(lower(x)) <= 3 then 1 else greatest(len(regexp_extract_all(regexp_replace(regexp_replace(lower(x), '(?:[^laeiouy]es|ed|[^laeiouy]e)$', ''), '^y', ''), '[aeiouy]{1,2}')), 1) end"
_SENTENCES = "list_filter(list_transform(regexp_split_to_array(t, '[.!?]+'), lambda x: trim(x)), lambda x: x <> '')"


@query(f"""with p as (select doc_id, {_strip(T)} as t from documents),
q as (select doc_id, list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '') as w, len({_SENTENCES}) as s from p),
r as (select doc_id, len(w) as n, s, coalesce(list_sum(list_transform(w, lambda x: {_SYLLABLES})), 0) as y from q)
select doc_id, n::bigint as n_words, s::bigint as n_sentences, y::bigint as n_syllables, {_half('case when n = 0 or s = 0 then 0.0::double else 0.39::double * (n::double / s) + 11.8::double * (y::double / n) - 15.59::double end', 100)} as readability from r""")
def readability(spark, d):
    return corpus.readability(docs(spark, d))


@query(f"""with p as (select doc_id, {_strip(T)} as t from documents), q as (select doc_id, list_transform({_SENTENCES}, lambda x: len(regexp_split_to_array(x, '\\s+'))) as s from p),
r as (select doc_id, count(n) as n, avg(n) as m, median(n) as md, sum(n * n)::double / count(n) - avg(n) * avg(n) as v from (select doc_id, unnest(case when len(s) = 0 then [null] else s end) as n from q) group by doc_id)
select doc_id, n as n_sentences, case when n = 0 then 0.0 else {_half('m', 100)} end as mean, case when n = 0 then 0.0 else {_half('md', 100)} end as median, case when n < 2 then 0.0 else {_half('sqrt(greatest(0.0, v))', 100)} end as stdev from r""")
def sentence_stats(spark, d):
    return corpus.sentence_stats(docs(spark, d))


@query(f"""with p as (select doc_id, {T} as t, list_filter(list_transform(string_split(regexp_replace({_strip(T)}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') as q,
list_filter(string_split({T}, chr(10)), lambda x: trim(x) <> '') as l from documents)
select doc_id, {_half("case when len(q) = 0 then 0 else len(list_filter(q, lambda x: suffix(x, '?')))::double / len(q) end", 1000)} as question_density,
{_half("case when len(l) = 0 then 0 else len(list_filter(l, lambda x: regexp_matches(x, '^[\\s]*([-*+]|[0-9]+[.])[\\s]')))::double / len(l) end", 1000)} as list_ratio,
coalesce(substr(regexp_replace(list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: x <> '' and not regexp_matches(x, '^(#|-{{3,}}|!\\[|<img)'))[1], '\\[([^\\]]+)\\]\\(([^)]+)\\)', '\\1', 'g'), 1, 200), '') as opening,
len(string_split(t, chr(10) || chr(10)))::bigint as n_paragraphs from p""")
def prose_shape(spark, d):
    return corpus.prose_shape(docs(spark, d))


@query(f"""with w as (select doc_id, {_words(f'lower({T})')} as w from documents), l(t, v) as (values {', '.join(f"('{k}', {v})" for k, v in SENTIMENT.items())}),
x as (select doc_id, unnest(w) as t, unnest(range(1, len(w) + 1)) as k, list_min(list_filter(list_transform({list(NEGATIONS)}, lambda n: list_position(w, n)), lambda p: p > 0)) as turn from w),
s as (select doc_id, sum(v * case when k > coalesce(turn, 2147483647) then -1 else 1 end)::bigint as s from x join l using (t) group by doc_id)
select doc_id, coalesce(s, 0) as score, {_half('case when len(w) = 0 then 0 else coalesce(s, 0)::double / len(w) end', 1000)} as comparative from w left join s using (doc_id)""")
def sentiment(spark, d):
    return corpus.sentiment(docs(spark, d))


@query(f"""select quarter, count(*) as n_docs, sum(len(w))::bigint as n_words from (select (row_number() over (order by doc_id) - 1) // ceil((select count(*) from documents) / 4.0)::bigint as quarter, {_words(T)} as w from documents) group by quarter""")
def content_evolution(spark, d):
    return corpus.content_evolution(docs(spark, d))


@query(f"""select target, word, {_half('s', 1000)} as similarity from (select target, word, jaro_winkler_similarity(target, word) as s from (select distinct unnest({_words(f'lower({T})')}) as word from documents), (select unnest(['thing', 'under', 'nation', 'people']) as target)) where s > 0.8""")
def similar_terms(spark, d):
    return corpus.similar_terms(docs(spark, d), ["thing", "under", "nation", "people"])


@query()
def word_stems(spark, d):
    return corpus.stems(docs(spark, d)).withColumn("words", F.array_join("words", ","))


def _entities(x: str) -> str:
    return f"list_filter(list_transform(regexp_extract_all({x}, '{nlp.ENTITY}', 1), lambda r: lower(trim(r))), lambda r: length(r) >= 2)"


@query(f"""with e as (select doc_id, entity, count(*) as n from (select doc_id, unnest({_entities(T)}) as entity from documents) group by all),
p as (select * from (select *, row_number() over (partition by doc_id order by n desc, entity) as k from e) where k <= 20), t as (select entity from p group by entity order by sum(n) desc, entity limit 15)
select d.doc_id, t.entity, coalesce(p.n, 0) as n from documents d cross join t left join p on p.doc_id = d.doc_id and p.entity = t.entity""")
def entities_over_time(spark, d):
    return corpus.entities_over_time(docs(spark, d))


@query(f"select term, count(*) as n from (select unnest(list_filter(regexp_extract_all(lower({T}), '{nlp.NOUN}', 1), lambda w: length(w) > 3)) as term from documents) group by term order by n desc, term limit 20")
def keywords(spark, d):
    return corpus.keyword_counts(docs(spark, d), nlp.nouns(F.coalesce("text", F.lit(""))), 20)


_TOPIC_TEXT = f"regexp_replace(regexp_replace(trim({T}), '!\\[([^\\[]*)\\](\\(.*\\))', '', 'g'), '\\[([^\\[]+)\\](\\(.*\\))', '\\1', 'g')"


@query(f"select term, count(*) as n from (select unnest({_entities(_TOPIC_TEXT)}) as term from documents) group by term order by n desc, term limit 100")
def topics(spark, d):
    return corpus.keyword_counts(docs(spark, d), nlp.entities(text.structural_clean(F.coalesce("text", F.lit("")), images_first=True)), 100)


@query(f"""with c as (select label, k, avg(x::double) as c from (select label, unnest(embedding) as x, unnest(range(1, len(embedding) + 1)) as k from embeddings) group by all),
v as (select vec_id, label, unnest(embedding)::double as x, unnest(range(1, len(embedding) + 1)) as k from embeddings)
select vec_id, label, {_half('sum(x * c) / sqrt(sum(x * x) * sum(c * c))', 1000)} as similarity from v join c using (label, k) group by vec_id, label""")
def embedding_similarity(spark, d):
    return corpus.dense_similarity(table(spark, d, "embeddings"))


_HREFS = "select page_id, unnest(regexp_extract_all(html, '<a [^>]*href=\"([^\"]+)\"', 1)) as url from pages"


def _hrefs(spark, d) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]+)"'), 1)).alias("url"))


@query(f"select domain, count(*) as n from (select coalesce(nullif(lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)), ''), url) as domain from ({_HREFS})) group by domain order by n desc, domain limit 10")
def top_domains(spark, d):
    return _hrefs(spark, d).select(web.domain(F.col("url")).alias("domain")).groupBy("domain").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "domain").limit(10)


@query("select lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) as host, count(*) as n, count_if(contains(lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)), 'example.com')) as n_self from pages group by 1")
def self_references(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").groupBy(web.host(url).alias("host")).agg(F.count("*").alias("n"), F.count_if(web.is_self(url, "example.com")).alias("n_self"))


@query("select level, count(*) as n from (select unnest(regexp_extract_all(html, '<h([1-6])[ >]', 1))::bigint as level from pages) group by level")
def heading_levels(spark, d):
    return table(spark, d, "pages").select(F.explode(F.regexp_extract_all("html", F.lit("<h([1-6])[ >]"), 1)).alias("x")).groupBy(F.col("x").cast("long").alias("level")).agg(F.count("*").alias("n"))


@query()
def page_markdown(spark, d):
    md = table(spark, d, "pages").select("page_id", web.html_to_markdown("html").alias("markdown"))
    return md.select("page_id", "markdown", F.size(text.links(F.col("markdown"))).alias("n_links"), F.size(text.headings(F.col("markdown"))).alias("n_headings"), text.image_count(F.col("markdown")).alias("n_images"), round_half_up(text.list_ratio(F.col("markdown")), 1000).alias("list_ratio"))


@query(f"""with f as (select url from ({_HREFS})), n as (select case when contains(b, 'www.') then b else regexp_replace(b, '^(https?://)', '\\1www.') end as url from (select regexp_replace(trim(url), '/$', '') as b from f)),
k as (select case when contains(b, 'www.') then b else regexp_replace(b, '^(https?://)', '\\1www.') end as url from (select regexp_replace(trim(url), '/$', '') as b from pages))
select url from n where not exists (select 1 from k where k.url = n.url)""")
def new_links(spark, d):
    return assets.new_links(_hrefs(spark, d), table(spark, d, "pages"))


@query("select page_id, url, nullif(first_value(page_id) over (partition by url order by page_id), page_id) as duplicate_of from pages")
def duplicate_pages(spark, d):
    return assets.mark_duplicates(table(spark, d, "pages").select("page_id", "url"), "url", ["page_id"], "page_id")


@query("select doc_id, sha256(text) as sha256, nullif(first_value(doc_id) over (partition by sha256(text) order by doc_id), doc_id) as duplicate_of from documents where text is not null")
def content_duplicates(spark, d):
    rows = docs(spark, d).where("text is not null").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return assets.mark_duplicates(rows, "sha256", ["doc_id"], "doc_id")


@query("select 'source' as kind, coalesce(source, '(unresolved)') as value, count(*) as n from documents group by 2 union all select 'lang', coalesce(lang, '(unresolved)'), count(*) from documents group by 2")
def manifest_counts(spark, d):
    return assets.count_by(docs(spark, d), {"source": F.col("source"), "lang": F.col("lang")})


_FILES = """(values ('a', 100, 640, 480, 'image/png', 100, 100, 'image/png', 640, 480, null), ('b', 90, 480, 640, 'image/jpeg', 100, null, 'image/jpg; q=1', 640, 480, null), ('c', 10, 10, 10, 'image/png', null, 11, 'image/webp', 20, 20, null),
('d', 10, 800, 600, 'image/png', null, null, null, null, null, 640), ('e', 10, 300, 600, 'image/png', null, null, null, null, null, 640), ('f', 10, null, null, 'image/svg+xml', 10, 10, null, null, null, null), ('g', 10, 3, 4, 'image/png', null, null, null, null, null, null))"""
_FILE_COLUMNS = "asset_id, bytes, width, height, mime, content_length, expected_bytes, expected_mime, expected_width, expected_height, max_width"


@query(f"""with m as (select *, content_length = bytes as length_matches, expected_bytes = bytes as bytes_match, case lower(trim(string_split(expected_mime, ';')[1])) when 'image/jpg' then 'image/jpeg' else lower(trim(string_split(expected_mime, ';')[1])) end = mime as mime_matches,
case when width is null or height is null then 'dimensions-unavailable' when expected_width is not null and expected_height is not null then case when width = expected_width and height = expected_height then 'matches-url-dimensions'
when width = expected_height and height = expected_width then 'matches-url-dimensions-rotated' else 'url-dimensions-mismatch' end when max_width is not null then case when width >= max_width then 'at-least-largest-advertised-width' else 'smaller-than-largest-advertised-width' end
else 'dimensions-detected' end as dimensions from {_FILES} v({_FILE_COLUMNS}))
select asset_id, length_matches, bytes_match, mime_matches, dimensions, concat_ws(',', case when not length_matches then 'content-length' end, case when not bytes_match then 'byte-estimate' end, case when not mime_matches then 'mime-type' end,
case dimensions when 'url-dimensions-mismatch' then 'url-dimensions' when 'smaller-than-largest-advertised-width' then 'small-width' when 'dimensions-unavailable' then 'no-dimensions' end) as warnings from m""")
def download_verification(spark, d):
    rows = assets.verify(spark.sql(f"select * from {_FILES} v({_FILE_COLUMNS})"))
    return rows.select("asset_id", "length_matches", "bytes_match", "mime_matches", "dimensions", F.array_join("warnings", ",").alias("warnings"))


def _opens(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("user_id").cast("string").alias("email"), F.col("ts").cast("string").alias("timestamp"), "event_type", "value")


@query("select strftime(ts, '%Y-%m-%d') as day, count(*) as opens, count(distinct user_id) as unique_opens, min(strftime(ts, '%Y-%m-%d %H:%M:%S')) as first_open from events group by 1")
def engagement_daily(spark, d):
    out = engagement.open_stats(_opens(spark, d), ["day"])
    return out.withColumn("first_open", F.substring("first_open", 1, 19))


@query("""select day, kind, value, count(*) as n from (select strftime(ts, '%Y-%m-%d') as day, unnest(['client', 'device']) as kind, unnest([event_type, case when contains(lower(event_type), 'view') then 'Mobile' else 'Desktop/Other' end]) as value from events) group by all""")
def open_histograms(spark, d):
    agent = F.when(F.lower("event_type").contains("view"), "Mobile Safari").otherwise("X11")
    return engagement.histograms(_opens(spark, d), ["day"], {"client": F.col("event_type"), "device": web.device(F.lit(" "), agent)})


@query(f"""with s as (select c_nationkey::varchar as post_id, count(*) as delivered from customer group by 1), o as (select (user_id % 25)::varchar as post_id, count(*) as opens, count(distinct user_id) as unique_opens from events group by 1)
select n_nationkey::varchar as post_id, coalesce(delivered, 0) as delivered, coalesce(opens, 0) as opens, coalesce(unique_opens, 0) as unique_opens, case when delivered > 0 then {_half('coalesce(unique_opens, 0)::double / delivered', 1000)} end as open_rate
from nation left join s on s.post_id = n_nationkey::varchar left join o on o.post_id = n_nationkey::varchar""")
def engagement_by_post(spark, d):
    posts = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("post_id"), F.lit("true").alias("is_published"), F.lit("2024-01-01 00:00:00").alias("email_sent_at"), F.lit("").alias("post_date"))
    sent = table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("post_id"), F.when(F.col("c_acctbal") > 0, "true").otherwise("false").alias("active_subscription"))
    opens = table(spark, d, "events").select((F.col("user_id") % 25).cast("string").alias("post_id"), F.col("user_id").cast("string").alias("email"), F.col("ts").cast("string").alias("timestamp"))
    return engagement.post_engagement(posts, sent, opens).select("post_id", "delivered", "opens", "unique_opens", "open_rate")


@query("""with m as (select strftime(o_orderdate, '%Y-%m') as month, count(*) as n, count_if(o_orderstatus = 'O') as a from orders group by 1)
select month, n as "new", a as new_active, sum(n) over (order by month)::bigint as total, sum(a) over (order by month)::bigint as total_active from m""")
def subscriber_growth(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderdate").cast("string").alias("created_at"), F.when(F.col("o_orderstatus") == "O", "true").otherwise("false").alias("active_subscription"))
    return engagement.subscriber_growth(rows)




@query(f"""with m as (select year(o_orderdate) as year, month(o_orderdate) as month, floor(avg(floor(o_totalprice)) * 100 + 0.5) / 100::double as price, floor(avg(o_orderkey % 7) * 100 + 0.5) / 100::double as lines from orders group by all)
select y.year, g.month, price, lines from (select distinct year from m) y cross join (select unnest(range(1, 13)) as month) g left join m on m.year = y.year and m.month = g.month""")
def monthly_series(spark, d):
    return engagement.monthly_series(table(spark, d, "orders"), F.col("o_orderdate"), {"price": F.floor("o_totalprice"), "lines": F.col("o_orderkey") % 7})


@query("""select *, year = max(year) over () as latest from (select year(o_orderdate) as year, sum(floor(o_totalprice))::double as price_sum, count(*) as price_count, floor(avg(floor(o_totalprice)) * 100 + 0.5) / 100::double as price_avg from orders group by 1)""")
def yearly_series(spark, d):
    return engagement.yearly_series(table(spark, d, "orders"), F.col("o_orderdate"), {"price": F.floor("o_totalprice")})


@query("""select o_orderkey, floor((epoch(o_orderdate) - epoch(last_day((o_orderdate - interval 1 month)::date)::timestamp)) / 86400.0 + 0.5)::bigint as days_late from orders""")
def days_late(spark, d):
    return table(spark, d, "orders").select("o_orderkey", text.days_late(F.col("o_orderdate"), F.add_months(F.col("o_orderdate").cast("date"), -1)).alias("days_late"))


@query("""select strftime(time_bucket(interval 1 hour, ts), '%Y-%m-%d %H:%M:%S') as start, event_type, count(*) as n, floor(sum(floor(value)) + 0.5) as total from events group by all""")
def windowed_events(spark, d):
    rows = links.windowed_counts(table(spark, d, "events").withColumn("value", F.floor("value")))
    return rows.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.col("total").cast("double").alias("total"))
