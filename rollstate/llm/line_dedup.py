"""Site-relative line de-duplication, in DataFrame functions only (operator 4).

A line that a large share of a site's pages carry is boilerplate; the longer the line, the smaller
the share, since long lines do not repeat by chance.  Pages are counted by distinct text, so that
many copies of one page do not make its own lines look like boilerplate; for small shares, near
copies do not count either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollstate.operators.dims import join_small
from rollstate.session import scratch_dir

#: A line goes if more than this share of its site's distinct pages have it ...
RATIO = 0.1
#: ... and at least so many distinct pages do.
MIN_PAGES = 5
#: By length: the share halves with every so many characters, ...
HALVING = 5
#: ... and a line of so many characters needs only so many pages.
LONG, LONG_PAGES = 20, 3
#: A page counts for the share by length if at least this part of its characters besides the line is in lines that no other page has.
OWN = 0.5


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(df: DataFrame, host: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per site, the hashes of its boilerplate lines: ``_host``, ``_lines`` (array of binary).

    The array is bounded: a site whose pages have L distinct lines on average has at most L / ratio
    of them.  Counting is pre-aggregated, so neither a hot site nor a hot line meets in one task.
    """
    pages = df.select(F.col(host).alias("_host"), F.coalesce(F.col(text), F.lit("")).alias("_text")).filter("_host IS NOT NULL")
    pages = pages.select("_host", "_text", F.unhex(F.md5("_text")).alias("_page"))
    totals = pages.select("_host", "_page").distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    split = F.array_distinct(F.transform(F.split("_text", "\n"), lambda line: _trimmed(line)))
    lines = pages.select("_host", "_page", F.explode(F.filter(split, lambda line: line != "")).alias("_line"))
    found = (
        lines.select("_host", _key(F.col("_line")).alias("_line"), "_page")
        .distinct()
        .groupBy("_host", "_line")
        .agg(F.count(F.lit(1)).alias("_with"))
        .filter(F.col("_with") >= min_pages)
    )
    common = join_small(found, totals, "_host").filter(F.col("_with") > ratio * F.col("_pages"))
    return common.groupBy("_host").agg(F.collect_set("_line").alias("_lines"))


def boilerplate_of_pages(df: DataFrame, host: str, text: str) -> DataFrame:
    """Per site and page (md5 of its text), the hashes of the page's lines that are boilerplate by length.

    A line goes if it is boilerplate by ``RATIO`` and ``MIN_PAGES``, or if the pages with content of
    their own that have it are enough for its length.  Lists are bounded by the page, whatever the
    number of the site's boilerplate lines.  Counts are written once; a hot line is pre-aggregated.
    """
    spark = df.sparkSession
    split = F.filter(F.array_distinct(F.transform(F.split(F.col(text), "\n"), lambda line: _trimmed(line))), lambda line: line != "")
    pages = df.filter(F.col(host).isNotNull()).select(F.col(host).alias("_host"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("_page"), split.alias("_split"))
    all_chars = F.aggregate("_split", F.lit(0).cast("long"), lambda n, line: n + F.char_length(line))
    sizes = pages.select("_host", "_page", F.coalesce(all_chars, F.lit(0)).alias("_all")).distinct()
    totals = sizes.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    lines = pages.select("_host", "_page", F.explode("_split").alias("_text")).select("_host", _key(F.col("_text")).alias("_line"), "_page", F.char_length("_text").alias("_chars"))
    counted = lines.distinct().groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_with"), F.max("_page").alias("_page"), F.max("_chars").alias("_chars"))
    folder = scratch_dir(spark, "lines")
    counted.write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")

    share = RATIO * F.pow(F.lit(2.0), -F.col("_chars") / HALVING) * F.col("_pages")
    floor = F.when(F.col("_chars") >= LONG, LONG_PAGES).otherwise(MIN_PAGES)
    plain = (F.col("_with") >= MIN_PAGES) & (F.col("_with") > RATIO * F.col("_pages"))
    asked = join_small(counts.filter(F.col("_with") >= LONG_PAGES).drop("_page"), totals, "_host")
    asked = asked.filter(plain | ((F.col("_with") >= floor) & (F.col("_with") > share)))
    found = join_small(lines.drop("_chars"), asked, ["_host", "_line"]).distinct()
    alone = counts.filter("_with = 1").groupBy("_host", "_page").agg(F.sum("_chars").alias("_alone"))
    own = alone.join(sizes, ["_host", "_page"])
    found.join(own, ["_host", "_page"], "left").write.parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")
    is_own = F.col("_alone") >= OWN * (F.col("_all") - F.col("_chars"))
    owned = found.groupBy("_host", "_line", "_with", "_chars", "_pages").agg(F.count_if(is_own).alias("_owned"))
    marks = owned.filter(plain | ((F.col("_owned") >= floor) & (F.col("_owned") > share))).select("_host", "_line")
    return join_small(found.select("_host", "_page", "_line"), marks, ["_host", "_line"]).groupBy("_host", "_page").agg(F.collect_set("_line").alias("_lines"))


def drop_lines(
    df: DataFrame, host: str = "source", text: str = "text", ratio: float | None = None, min_pages: int | None = None
) -> DataFrame:
    """Removes boilerplate lines from every text; adds ``n_dropped``, the number of lines removed.

    With ``ratio`` or ``min_pages`` (the other as RATIO or MIN_PAGES), one share holds for lines of
    any length; without, the share goes down with the length, and lines of near copies, which are
    the greater part of their pages, stay for the operators that compare whole texts.

    Lines are compared without the blanks around them; empty lines stay.  Rows without a site are
    left as they are.  A null text stays null (0 dropped); a text whose lines all go becomes empty.
    Repeated rows count as one page and are cleaned alike.  All other columns are kept; a column
    named ``n_dropped`` is replaced.
    """
    if ratio is None and min_pages is None:
        marks = boilerplate_of_pages(df, host, text)
        on = (F.col(host) == F.col("_host")) & (F.unhex(F.md5(F.col(text))) == F.col("_page"))
    else:
        marks = boilerplate(df, host, text, RATIO if ratio is None else ratio, MIN_PAGES if min_pages is None else min_pages)
        on = F.col(host) == F.col("_host")
    joined = join_small(df, marks, on, "left")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda line: (_trimmed(line) == "") | ~F.array_contains(F.col("_lines"), _key(_trimmed(line))))
    joined = joined.withColumn("_kept", F.when(F.col("_lines").isNotNull(), kept))
    dropped = F.when(F.col("_kept").isNull(), 0).otherwise(F.size(lines) - F.size("_kept"))
    columns = [c for c in df.columns if c.lower() != "n_dropped"]
    cleaned = F.when(F.col("_kept").isNull(), F.col(text)).otherwise(F.array_join("_kept", "\n")).alias(text)
    return joined.select(*[cleaned if c == text else F.col(f"`{c}`") for c in columns], dropped.cast("long").alias("n_dropped"))
