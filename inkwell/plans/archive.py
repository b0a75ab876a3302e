"""Queries of cleaning, dates, posts and files; tables as in catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nlp, text
from ..functions.constants import ALL_STOP_WORDS, MONTHS
from ..operators import corpus, engagement
from ..sources import readers, writers
from ..sources.scratch import scratch
from .catalog import T, _half, _list, _strip, _words, docs, query, table


def _chain(x: str, *steps: tuple[str, str]) -> str:
    for pattern, by in steps:
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'g')"
    return x


_IMAGE, _HTML, _LINK = (text.IMAGE, ""), (text.HTML_IMAGE, ""), (text.LINK, r"\1")
_WIDE_LINK, _WIDE_IMAGE = (r"\[([^\[]+)\](\(.*\))", r"\1"), (r"!\[([^\[]*)\](\(.*\))", "")
_LINKS_FIRST = _chain(f"trim({T})", _WIDE_LINK, _WIDE_IMAGE)


@query(f"""select doc_id, sha256({_chain(T, _IMAGE, _HTML, _LINK, ("[#*`_]", ""), (chr(92) + "n" + chr(92) + "n+", ". "))}) as light, sha256({_LINKS_FIRST}) as structural,
sha256({_chain(f"trim({T})", _WIDE_IMAGE, _WIDE_LINK)}) as topic, sha256({_chain(T, _LINK, ("[#*`_]", ""), (chr(91) + "^" + chr(92) + "w" + chr(92) + "s]", " "))}) as keyword from documents""")
def cleaned_texts(spark, d):
    t = F.coalesce("text", F.lit(""))
    named = {"light": text.light_clean(t), "structural": text.structural_clean(t), "topic": text.structural_clean(t, images_first=True), "keyword": text.keyword_clean(t)}
    return docs(spark, d).select("doc_id", *(F.sha2(c, 256).alias(k) for k, c in named.items()))


_MONTHS_SQL = f"[{', '.join(repr(m) for m in MONTHS)}]"
_month_name = lambda k: F.element_at(F.array(*map(F.lit, MONTHS)), F.pmod(k, F.lit(12)).cast("int") + 1)


@query(f"""with n as (select o_orderkey as k, month(o_orderdate) as m, year(o_orderdate)::varchar as y from orders),
f as (select *, case k % 7 when 0 then {_MONTHS_SQL}[m] || {_MONTHS_SQL}[m % 12 + 1] || '-' || y || '.md' when 1 then upper({_MONTHS_SQL}[m]) || '-' || y || '-on-things.md' when 2 then 'on-things-' || y || '.md' else {_MONTHS_SQL}[m] || '-' || y || '.md' end as filename from n)
select k as o_orderkey, filename, case when k % 7 <> 2 then y || '-' || printf('%02d', m) || '-01' end as date, case when k % 7 <> 2 then y end as folder_year, case when k % 7 not in (0, 2) then m end::int as folder_month from f""")
def filename_dates(spark, d):
    k, m, y = F.col("o_orderkey"), F.month("o_orderdate"), F.year("o_orderdate").cast("string")
    one, two = _month_name(m - 1), _month_name(m)
    name = F.when(k % 7 == 0, F.concat(one, two, F.lit("-"), y, F.lit(".md"))).when(k % 7 == 1, F.concat(F.upper(one), F.lit("-"), y, F.lit("-on-things.md"))).when(k % 7 == 2, F.concat(F.lit("on-things-"), y, F.lit(".md"))).otherwise(F.concat(one, F.lit("-"), y, F.lit(".md")))
    rows = table(spark, d, "orders").select("o_orderkey", name.alias("filename"))
    folder = text.exact_month_year(F.col("filename"))
    return rows.select("o_orderkey", "filename", text.date_from_filename(F.col("filename")).alias("date"), folder["year"].alias("folder_year"), folder["month"].cast("int").alias("folder_month"))


@query("""with n as (select o_orderkey as k, month(o_orderdate) as m, year(o_orderdate) as y from orders), c as (select *, case when k % 3 = 0 then (m + 1) % 12 + 1 when k % 2 = 0 then (m + 10) % 12 + 1 else m end as c from n)
select k as o_orderkey, y::varchar || '-' || printf('%02d', c) as coverage_month, y::varchar || '-' || printf('%02d', c) || '-01' as coverage_date from c""")
def coverage_months(spark, d):
    k, m = F.col("o_orderkey"), F.month("o_orderdate")
    title = F.when(k % 3 == 0, F.concat(F.lit("From "), F.initcap(_month_name(m - 1)), F.lit(" to "), _month_name(m + 1))).when(k % 3 == 1, F.lit("")).otherwise(F.lit("None"))
    slug = F.when(k % 2 == 0, F.concat(F.lit("the-"), _month_name(m - 2), F.lit("-issue"))).otherwise(F.lit("x"))
    base = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select("o_orderkey", text.coverage_month(base, title, slug).alias("coverage_month"), text.coverage_date(base, title, slug).cast("string").alias("coverage_date"))


@query(f"""select o_orderkey, {_half('o_totalprice / 7', 100)} as half_up, format('{{:.2f}}', o_totalprice / 7)::double as fixed, floor((o_orderkey % 977)::double / 977 * 1000 + 0.5) / 10.0::double as rate_percent, printf('%05d', o_orderkey % 977) as padded from orders""")
def roundings(spark, d):
    x = F.col("o_totalprice").cast("double") / 7
    rate = (F.col("o_orderkey") % 977).cast("double") / 977.0
    return table(spark, d, "orders").select("o_orderkey", text.round_half_up(x, 100).alias("half_up"), text.to_fixed(x).alias("fixed"), engagement.rate_percent(rate).alias("rate_percent"), text.padded(F.col("o_orderkey") % 977, 5).alias("padded"))


@query("""with m as (select (o_orderkey % 1200)::varchar || '.md' as filename, arg_max(o_orderstatus, o_orderkey) as status, arg_max(o_totalprice, o_orderkey) as price from orders group by 1)
select doc_id, doc_id::varchar || '.md' as filename, status, price from documents left join m on m.filename = doc_id::varchar || '.md'""")
def posts_with_metadata(spark, d):
    posts = docs(spark, d).select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("filename"))
    metadata = table(spark, d, "orders").select(F.concat((F.col("o_orderkey") % 1200).cast("string"), F.lit(".md")).alias("filename"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("place"))
    return corpus.posts_with_metadata(posts, metadata, "place")


_POSTS = f"select doc_id, {T} as t, case when doc_id % 10 = 0 then 'special-' || doc_id || '.md' else {_MONTHS_SQL}[doc_id % 12 + 1] || '-' || (2000 + doc_id % 25) || '.md' end as filename, doc_id % 12 + 1 as m, 2000 + doc_id % 25 as y from documents"
_COUNTS = {"n_words": f"len({_words(_chain('trim(t)', _WIDE_LINK, _WIDE_IMAGE))})", "n_paragraphs": "len(string_split(t, chr(10) || chr(10)))", "n_links": f"len(regexp_extract_all(t, '{text.LINK}'))", "n_images": f"len(regexp_extract_all(t, '{text.IMAGE}')) + len(regexp_extract_all(t, '{text.HTML_IMAGE}'))", "n_headings": r"len(regexp_extract_all(t, '(?m)^(#{1,6})\s+(.+)$'))"}
_STRUCTURE = f"select filename, case when doc_id % 10 <> 0 then y || '-' || printf('%02d', m) || '-01' end as date, case when doc_id % 10 = 0 then 'special-' || doc_id end as special, {', '.join(f'({v})::bigint as {k}' for k, v in _COUNTS.items())} from ({_POSTS})"


def _named_posts(spark, d):
    name = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("special-"), F.col("doc_id").cast("string"), F.lit(".md"))).otherwise(F.concat(_month_name(F.col("doc_id")), F.lit("-"), (2000 + F.col("doc_id") % 25).cast("string"), F.lit(".md")))
    return docs(spark, d).select(name.alias("filename"), "text")


@query(_STRUCTURE)
def structure_report(spark, d):
    return corpus.structure_report(_named_posts(spark, d))


@query(f"""select count(*) as n_posts, count_if(special is null) as n_regular, sum(n_words) filter (special is null)::bigint as n_words, {_half('avg(n_words) filter (special is null)', 100)} as mean_words, sum(n_images)::bigint as n_images, {_half('avg(n_images)', 100)} as mean_images from ({_STRUCTURE})""")
def structure_totals(spark, d):
    return corpus.structure_totals(corpus.structure_report(_named_posts(spark, d)))


@query("""select page_id, 'https://e.org/' || page_id || ' https://e.org/' || page_id || '/p.png y' as links, 2 as n_images, '1 2' as levels, 'Page ' || page_id || '|Part' as titles, 0.125 as list_ratio from pages""")
def markdown_structure(spark, d):
    url = F.concat(F.lit("https://e.org/"), F.col("page_id").cast("string"))
    md = F.concat(F.lit("# Page "), F.col("page_id").cast("string"), F.lit("\n\nSee [home]("), url, F.lit(") and ![pic]("), url, F.lit("/p.png)\n\n##  Part \n- [x](y)\n<img src='a.png'>\n\nend\n####### no\n[]( )"))
    rows = table(spark, d, "pages").select("page_id", md.alias("md"))
    found, heads = text.links(F.col("md")), text.headings(F.col("md"))
    return rows.select("page_id", F.array_join(F.transform(found, lambda x: x["url"]), " ").alias("links"), text.image_count(F.col("md")).alias("n_images"), F.array_join(F.transform(heads, lambda x: x["level"].cast("string")), " ").alias("levels"), F.array_join(F.transform(heads, lambda x: x["text"]), "|").alias("titles"), text.round_half_up(text.list_ratio(F.col("md")), 1000).alias("list_ratio"))


@query(f"""with p as (select strftime(o_orderdate, '%Y-%m') as month, o_orderkey % 50 as d, o_orderkey % 40 as o, o_orderkey % 30 as u, case when o_orderkey % 5 > 0 then (o_orderkey % 97) / 4.0::double end as lag from orders)
select month, sum(d)::bigint as delivered, sum(o)::bigint as opens, sum(u)::bigint as unique_opens, case when sum(d) > 0 then {_half('sum(u)::double / sum(d)', 1000)} end as open_rate, {_half('avg(lag)', 100)} as avg_lag_minutes from p group by month""")
def engagement_by_month(spark, d):
    k = F.col("o_orderkey")
    posts = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), (k % 50).alias("delivered"), (k % 40).alias("opens"), (k % 30).alias("unique_opens"), F.when(k % 5 > 0, (k % 97) / 4.0).alias("open_lag_minutes"))
    return engagement.monthly_engagement(posts)


_ITEMS = f"select item_id as doc_id, unnest(list_filter(list_transform({_words(_strip(T))}, lambda x: lower(x)), lambda x: length(x) > 2 and x not in {_list(ALL_STOP_WORDS)})) as token from benchmark"


@query(f"""with t as ({_ITEMS}), tf as (select doc_id, token, count(*) as tf from t group by all), df as (select token, count(*) as df from tf group by token),
w as (select doc_id, token, tf * (1 + ln((select count(*) from benchmark)::double / (1 + df))) as x from tf join df using (token)), v as (select doc_id, token, x / sqrt(sum(x * x) over (partition by doc_id)) as x from w),
s as (select a.doc_id as a, b.doc_id as b, sum(a.x * b.x) as s from v a join v b on a.token = b.token group by all)
select i.item_id as a, j.item_id as b, case when i.item_id = j.item_id then 1.0 else {_half('coalesce(s, 0)', 1000)} end as similarity from benchmark i cross join benchmark j left join s on s.a = i.item_id and s.b = j.item_id""")
def similarity_of_all_pairs(spark, d):
    return corpus.similarity_matrix(table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), "text"))


#: Words and stems that the algorithm's author gives as examples.
_STEMS = dict(x.split(">") for x in """caresses>caress ponies>poni ties>ti caress>caress cats>cat feed>feed agreed>agre plastered>plaster bled>bled motoring>motor sing>sing conflated>conflat troubled>troubl sized>size
    hopping>hop tanned>tan falling>fall hissing>hiss fizzed>fizz failing>fail filing>file happy>happi sky>sky relational>relat conditional>condit rational>ration valenci>valenc hesitanci>hesit digitizer>digit
    conformabli>conform radicalli>radic differentli>differ vileli>vile analogousli>analog vietnamization>vietnam predication>predic operator>oper feudalism>feudal decisiveness>decis hopefulness>hope callousness>callous
    formaliti>formal sensitiviti>sensit sensibiliti>sensibl triplicate>triplic formative>form formalize>formal electriciti>electr electrical>electr hopeful>hope goodness>good revival>reviv allowance>allow inference>infer
    airliner>airlin gyroscopic>gyroscop adjustable>adjust defensible>defens irritant>irrit replacement>replac adjustment>adjust dependent>depend adoption>adopt homologou>homolog communism>commun activate>activ
    angulariti>angular homologous>homolog effective>effect bowdlerize>bowdler probate>probat rate>rate cease>ceas controll>control roll>roll""".split())


@query(f"select n_nationkey, word, stem from nation cross join (values {', '.join(str(p) for p in _STEMS.items())}) v(word, stem)")
def published_stems(spark, d):
    words = F.explode(F.array(*map(F.lit, _STEMS))).alias("word")
    return table(spark, d, "nation").select("n_nationkey", words).withColumn("stem", nlp.stem("word"))


@query("""select c_custkey::varchar as c_custkey, c_name || ' "x", ' || chr(10) || c_mktsegment as note, '' as missing from customer""")
def csv_round_trip(spark, d):
    """Quoted CSV written, and read by its header with columns in another order and one that it lacks."""
    path = scratch(spark, "csv")
    writers.quoted_csv(table(spark, d, "customer").select(F.concat("c_name", F.lit(' "x", \n'), "c_mktsegment").alias("note"), "c_custkey", F.array("c_custkey").alias("more")), path)
    return readers.export_csv(spark, f"{path}/*.csv", ["c_custkey", "missing", "note"])


@query("select trim(url) as url from pages where trim(url) <> '' union all select trim(url) from pages where trim(url) <> ''")
def link_list_round_trip(spark, d):
    path, urls = scratch(spark, "links"), table(spark, d, "pages").select("url")
    for _ in range(2):
        writers.append_links(urls, path)
    return readers.lines(spark, path)


@query("select n_nationkey, n_name, n_regionkey from nation")
def json_round_trip(spark, d):
    path = scratch(spark, "json")
    writers.json_rows(table(spark, d, "nation"), path, ["n_name"])
    return readers.json_lines(spark, path, "n_nationkey long, n_name string, n_regionkey long")


@query("select 'https://e.org/' || page_id as url from pages")
def feed_links(spark, d):
    path = scratch(spark, "feed")
    items = table(spark, d, "pages").select(F.concat(F.lit("<item><title>t</title><link> https://e.org/"), F.col("page_id").cast("string"), F.lit("</link></item>")).alias("value"))
    whole = items.agg(F.array_join(F.collect_list("value"), "\n").alias("value"))  # a feed is one document
    whole.select(F.concat(F.lit("<rss><channel>\n"), "value", F.lit("\n</channel></rss>")).alias("value")).write.text(path)
    return readers.feed(spark, path)


@query("select year(o_orderdate)::varchar as year, printf('%02d', month(o_orderdate)) as month, count(*) as n from orders group by all")
def dated_folders(spark, d):
    path = scratch(spark, "dated")
    writers.dated_folders(table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")), path)
    back = spark.read.schema("o_orderkey long, date string, year string, month string").parquet(path)
    return back.groupBy("year", "month").agg(F.count("*").alias("n"))


@query(f"select sha256(string_agg('# item-' || item_id || chr(10) || chr(10) || {T}, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by item_id)) as sha256 from benchmark")
def combined_markdown(spark, d):
    posts = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), F.concat(F.lit("item-"), F.col("item_id").cast("string"), F.lit(".md")).alias("filename"), F.coalesce("text", F.lit("")).alias("text"))
    return writers.combined_markdown(posts).select(F.sha2("text", 256).alias("sha256"))
