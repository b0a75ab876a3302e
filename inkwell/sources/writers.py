"""Sinks: JSON, quoted CSV, download lists, combined Markdown, dated folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_rows(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """JSON lines, sorted if an order is given, with nulls last."""
    (df.orderBy(*(F.asc_nulls_last(c) for c in order)) if order else df).write.mode("overwrite").json(path)


def manifest_set(assets: DataFrame, folder: str) -> None:
    """The four files of a manifest: JSON, CSV and the two download lists, all of one computation of it."""
    json_rows(assets, f"{folder}/manifest.json", ["doc_id", "kind", "ordinal"])
    rows = assets.sparkSession.read.schema(assets.schema).json(f"{folder}/manifest.json")
    quoted_csv(rows, f"{folder}/manifest.csv")
    download_lists(rows, f"{folder}/body.tsv", f"{folder}/covers.tsv")


def quoted_csv(df: DataFrame, path: str) -> None:
    """All cells quoted, quotes doubled, nested columns as JSON."""
    nested = [c for c, kind in df.dtypes if kind.startswith(("array", "struct", "map"))]
    df.withColumns({c: F.to_json(c) for c in nested}).write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"', emptyValue="")


def download_lists(assets: DataFrame, body: str, covers: str) -> None:
    """Two headerless tab-separated lists: body assets without duplicates, covers with them."""
    listed = assets.where((F.col("status") == "listed") & F.col("url").isNotNull())
    cover = F.col("kind") == "post-cover"
    for rows, path in ((listed.where(~cover & F.col("duplicate_of").isNull()), body), (listed.where(cover), covers)):
        rows.select("asset_id", "url").write.mode("overwrite").csv(path, sep="\t", quote="")


def combined_markdown(posts: DataFrame) -> DataFrame:
    """One row: all posts under their names, in order of doc_id; a single text by definition."""
    part = F.struct("doc_id", F.concat(F.lit("# "), F.regexp_replace("filename", r"\.md$", ""), F.lit("\n\n"), "text").alias("t"))
    return posts.agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["t"]), "\n\n---\n\n").alias("text"))


def dated_folders(posts: DataFrame, path: str) -> None:
    """Posts under year= and month= folders."""
    posts.where("date is not null").withColumn("year", F.substring("date", 1, 4)).withColumn("month", F.substring("date", 6, 2)).write.mode("overwrite").partitionBy("year", "month").parquet(path)


def append_links(new: DataFrame, path: str) -> None:
    new.select("url").write.mode("append").text(path)


def upload_map(results: DataFrame, prefix: str, base_url: str) -> DataFrame:
    """(asset_id, key, url) that stored files get."""
    key = F.concat(F.lit(prefix.rstrip("/") + "/"), F.element_at(F.split("path", "/"), -1))
    return results.select("asset_id", key.alias("key"), F.concat(F.lit(base_url.rstrip("/") + "/"), key).alias("url"))
