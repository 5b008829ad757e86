"""Release listings: files with dates and sizes out of directory pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions import text
from skyfold.schema import require_columns


def page_links(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One row per link of each page, joined to the address of the page; ``folder`` says whether it leads to one."""
    require_columns(pages, (html, url))
    kept = [c for c in pages.columns if c not in (html, "file")]
    targets = F.regexp_extract_all(F.col(html), F.lit('<a href="([^"]*)">'), F.lit(1))
    return _addressed(pages.select(*kept, F.explode(targets).alias("file")), url)


def listing_entries(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``file``, ``date``, ``size`` and ``folder`` of each entry of each directory page.

    An entry is a line with a link and, behind it, a date and a size; sort links in the
    head of a page have no date.  All pages are one scan, so the pages of sub-folders
    need no recursion.
    """
    require_columns(pages, (html, url))
    kept = [c for c in pages.columns if c not in (html, "file", "date", "size")]
    lines = pages.select(*kept, F.explode(F.split(F.col(html), "\n")).alias("_line"))
    words = F.split(F.trim(F.regexp_replace(F.substring_index("_line", "</a>", -1), "<[^>]*>", " ")), r"\s+")
    entries = lines.select(
        *kept,
        F.regexp_extract("_line", 'href="([^"]*)"', 1).alias("file"),
        F.concat_ws(" ", F.get(words, F.lit(0)), F.get(words, F.lit(1))).alias("date"),
        F.get(words, F.lit(2)).alias("size"),
    )
    dated = F.col("date").rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}")
    return _addressed(entries.filter((F.col("file") != "") & dated & F.col("size").isNotNull()), url)


def _addressed(rows: DataFrame, url: str) -> DataFrame:
    base = F.concat(F.regexp_replace(F.col(url), "/+$", ""), F.lit("/"))
    link = F.regexp_replace(F.col("file"), "^/+", "")
    return rows.withColumn("file", F.concat(base, link)).withColumn("folder", text.is_folder(F.col("file")))


def size_by_field(entries: DataFrame, file: str = "file", size: str = "size") -> DataFrame:
    """Files and mebibytes of Parquet per field, the field being the last folder."""
    require_columns(entries, (file, size))
    parquet = entries.filter(F.col(file).contains("parquet"))
    return (
        parquet.groupBy(text.folder(F.col(file)).alias("field"))
        .agg(F.count("*").alias("files"), F.sum(text.parse_size(F.col(size))).alias("_bytes"))
        .select("field", "files", (F.col("_bytes") / 1048576.0).alias("total_size"))
    )
