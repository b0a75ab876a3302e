"""Sources: text lists, Markdown and HTML folders, exports, manifests, feeds, binary files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text

DOWNLOADS = "asset_id string, url string"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(url) of a text list: trimmed, empty lines dropped, the last line kept even without a line end."""
    return spark.read.text(path).select(F.trim("value").alias("url")).where("url <> ''")


def _files(spark: SparkSession, path: str, pattern: str, recursive: bool) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", pattern)
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("filename"), F.col("value").alias("text"))


def markdown_folder(spark: SparkSession, path: str, recursive: bool = True, leave_out: tuple[str, ...] = ("all_newsletters.md", "combined.md")) -> DataFrame:
    """(filename, text, date, doc_id): dated files first and by date, then the others by name."""
    files = _files(spark, path, "*.md", recursive)
    files = files if recursive else files.where(~F.col("filename").isin(*leave_out))
    return number_posts(files.withColumn("date", text.date_from_filename(F.col("filename"))))


def number_posts(files: DataFrame, undated_first: bool = False) -> DataFrame:
    """doc_id by date, then name; an archive of posts is small, so one task may order its names."""
    from pyspark.sql import Window

    date = F.asc_nulls_first("date") if undated_first else F.asc_nulls_last("date")
    ids = files.select("filename", "date").withColumn("doc_id", F.row_number().over(Window.orderBy(date, "filename")).cast("long") - 1)
    return files.drop("date").join(ids, "filename")


def html_folder(spark: SparkSession, path: str) -> DataFrame:
    """(filename, html, post_id, slug, number) of exported posts named id.slug.html; number orders ids by value, not by digits."""
    files = _files(spark, path, "*.[hH][tT][mM][lL]", False).withColumnRenamed("text", "html")
    if files.isEmpty():
        raise ValueError(f"no HTML files in {path}")
    part = F.split("filename", r"\.", 2)
    return files.select("filename", "html", F.get(part, F.lit(0)).alias("post_id"), F.regexp_replace(F.get(part, F.lit(1)), r"(?i)\.?html$", "").alias("slug"), F.get(part, F.lit(0)).try_cast("long").alias("number"))


def _by_header(spark: SparkSession, paths: list[str], columns: list[str], *more: Column) -> DataFrame:
    """Columns of CSV files by the names in each file's own header, in any order and with others among them; missing ones are empty."""
    options = {"multiLine": True, "quote": '"', "escape": '"'}
    heads = {}
    for path in paths:
        head = spark.read.csv(path, header=False, **options).limit(1).collect()
        names = [(c or "").removeprefix("\ufeff") for c in head[0]] if head else []
        heads.setdefault(tuple(names), []).append(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    out = spark.createDataFrame([], schema).select(*columns, *(F.lit("").alias(k) for k in ("post_id",) if more))
    for names, own in heads.items():
        place = {name: f"_{k}" for k, name in enumerate(names)}
        # positions as names, so that repeated header names do no harm
        kinds = T.StructType([T.StructField(f"_{k}", T.StringType()) for k in range(len(names))])
        if names:
            rows = spark.read.schema(kinds).csv(own, header=True, enforceSchema=True, mode="PERMISSIVE", **options)
            cells = (F.coalesce(F.col(place[c]), F.lit("")).alias(c) if c in place else F.lit("").alias(c) for c in columns)
            out = out.unionByName(rows.select(*cells, *more))
    return out


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    """The files of a folder or pattern."""
    return sorted(r[0] for r in spark.read.format("binaryFile").load(pattern).select(F.col("_metadata.file_path")).collect())  # names only


def export_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV export with all columns as text, found by header: quotes doubled, line ends within quotes, missing cells empty."""
    return _by_header(spark, _matching(spark, path), columns).select(*columns)


def per_post_csv(spark: SparkSession, pattern: str, columns: list[str]) -> DataFrame:
    """Many CSV files named post_id.kind.csv as one table with post_id; each file's own header tells its columns.

    Files with the same header are read together; the driver reads each one's first record.
    """
    name = F.regexp_extract("_metadata.file_name", r"^(\d+)\.", 1).alias("post_id")
    return _by_header(spark, _matching(spark, pattern), columns, name).select("post_id", *columns)


def optional(spark: SparkSession, path: str, schema: str, read) -> DataFrame:
    """read(path), or an empty table of the schema where the path does not exist."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop):
        return read(path)
    return spark.createDataFrame([], schema)


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def feed(spark: SparkSession, path: str) -> DataFrame:
    """(url) of a feed's items, read from a file."""
    return spark.read.schema("link string").format("xml").option("rowTag", "item").load(path).select(F.trim("link").alias("url"))


def download_list(spark: SparkSession, path: str) -> DataFrame:
    """(asset_id, url) of a headerless tab-separated list.

    A bad line (named by its number), a repeated id and an empty list raise ValueError before anything is returned.
    """
    rows = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("line"), F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_path").alias("file"))
    part = F.split("line", "\t", 2)
    rows = rows.select("line", "at", "file", F.get(part, F.lit(0)).alias("asset_id"), F.get(part, F.lit(1)).alias("url"))
    filled = rows.where("line <> ''")
    good = F.col("asset_id").rlike(r"^[A-Za-z0-9._-]+$") & F.col("url").rlike(r"(?i)^https?://[^\s/?#]+\S*$")
    bad = filled.where(~F.coalesce(good, F.lit(False))).orderBy("at").first()
    if bad:
        number = rows.where((F.col("file") == bad["file"]) & (F.col("at") <= bad["at"])).count()
        raise ValueError(f"bad download line {number}: {bad['line']}")
    twice = filled.groupBy("asset_id").count().where("count > 1").first()
    if twice:
        raise ValueError(f"repeated asset id: {twice['asset_id']}")
    if filled.isEmpty():
        raise ValueError(f"no downloads in {path}")
    return filled.select("asset_id", "url")


def binaries(spark: SparkSession, path: str, limit: int = 100 << 20) -> DataFrame:
    """(path, content) of files up to limit bytes."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.col("length") <= limit).select("path", "content")


def checked(value: int, low: int, high: int, name: str) -> int:
    """An option within its range."""
    if not low <= value <= high:
        raise ValueError(f"{name} must lie between {low} and {high}")
    return value
