"""Line dedup by site-relative frequency.

Within a host, a line's ratio is the number of the host's pages that contain it over the number of the host's pages.
Lines above the ratio are boilerplate, and every occurrence on that host is dropped; a line of a single page is not,
however few pages the host has, as nothing repeats it.

Only DataFrame functions.  Lines travel as two 64-bit hashes, counted per host with partial aggregation before the
shuffle; line texts never leave their row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

RATIO = 0.1
MIN_PAGES = 2
BROADCAST_LINES = 200_000  # 16 bytes each


def _hash(line: Column) -> tuple[Column, Column]:
    return F.xxhash64(line), F.xxhash64(F.lit(8), line)


def boilerplate_lines(docs: DataFrame, *, text_col: str = "text", host_col: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, h1, h2, pages, host_pages) of every boilerplate line, white space around it aside.

    Lines of white space only are never boilerplate.  A null host is a host of its own.
    """
    pages = docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    # a line counts once a page, however often the page repeats it
    trimmed = F.transform(F.split("text", "\n"), lambda line: F.trim(line))
    lines = pages.select("host", F.explode(F.array_distinct(trimmed)).alias("line")).where("line <> ''")
    h1, h2 = _hash(F.col("line"))
    counted = lines.groupBy("host", h1.alias("h1"), h2.alias("h2")).agg(F.count(F.lit(1)).alias("pages"))
    counted = counted.where(F.col("pages") >= min_pages)
    return (
        counted.join(totals.withColumnRenamed("host", "t_host"), F.col("host").eqNullSafe(F.col("t_host")))
        .where(F.col("pages") > F.col("host_pages") * F.lit(float(ratio)))
        .select("host", "h1", "h2", "pages", "host_pages")
    )


def _cut(docs: DataFrame, text_col: str, host_col: str, ratio: float, min_pages: int) -> tuple[DataFrame, list[Column], Column, Column]:
    """(joined rows, the columns of docs with the cut text, number of lines, number of dropped lines)."""
    found = checkpointed(boilerplate_lines(docs, text_col=text_col, host_col=host_col, ratio=ratio, min_pages=min_pages))
    sets = found.groupBy(F.col("host").alias("__host")).agg(
        F.sort_array(F.collect_list("h1")).alias("__d1"), F.sort_array(F.collect_list("h2")).alias("__d2")
    )
    same_host = F.col(host_col).eqNullSafe(F.col("__host"))
    if found.count() <= BROADCAST_LINES:
        joined = docs.join(F.broadcast(sets), same_host, "left")
    else:
        salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sets = sets.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = docs.withColumn("__of", F.pmod(F.xxhash64(F.col(text_col)), F.lit(salts)))
        joined = salted.join(sets, same_host & (F.col("__of") == F.col("__salt")), "left")
    lines = F.split(F.col(text_col), "\n")

    def kept(line: Column) -> Column:
        h1, h2 = _hash(F.trim(line))
        return ~(F.array_contains("__d1", h1) & F.array_contains("__d2", h2))

    left = F.when(F.col("__d1").isNotNull() & F.col(text_col).isNotNull(), F.filter(lines, kept))
    joined = joined.withColumn("__left", left)
    columns = [F.coalesce(F.array_join("__left", "\n"), F.col(c)).alias(c) if c == text_col else F.col(c) for c in docs.columns]
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines))
    return joined, columns, n_lines, F.when(F.col("__left").isNull(), 0).otherwise(n_lines - F.size("__left"))


def dedup_lines(docs: DataFrame, *, text_col: str = "text", host_col: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with its lines of boilerplate dropped, plus n_lines and n_dropped; the other columns as they were.

    Rows stay, with an empty text if every line went; null texts stay null with 0 lines; empty texts have one empty
    line.  Rows that repeat are pages each.  An empty table gives an empty result.  Columns n_lines and n_dropped that
    ``docs`` has give way to the counts.  The boilerplate of a host is one row with two arrays of hashes: a host has
    fewer than (lines of a page) / ratio such lines, whatever its size.  Those rows are broadcast if there are at most
    BROADCAST_LINES hashes; beyond, the documents meet them by host and salt, so that no host is one task.
    """
    joined, columns, n_lines, n_dropped = _cut(docs, text_col, host_col, ratio, min_pages)
    own = [c for c, name in zip(columns, docs.columns, strict=True) if name not in ("n_lines", "n_dropped")]
    return joined.select(*own, n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def without_boilerplate(docs: DataFrame, *, text_col: str = "text", host_col: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with its lines of boilerplate dropped and no other change; see ``dedup_lines``."""
    joined, columns, _, _ = _cut(docs, text_col, host_col, ratio, min_pages)
    return joined.select(*columns)
