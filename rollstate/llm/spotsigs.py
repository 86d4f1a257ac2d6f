"""SpotSigs document fingerprints, in DataFrame functions only (operator 2).

A signature is a common word (the anchor) with the content words that follow it.  The set of a
text's signatures is its fingerprint: navigation and lists hold few common words and leave few
signatures, running prose many.  Sets are banded by their length, because two sets can only be
alike if their lengths are; a pair whose lengths rule likeness out is not compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_width

#: Common words of English, German, French and Spanish that anchor signatures.
ANCHORS = (
    "a an and are as at be by for from has he in is it its of on or that the this to was were will with "
    "au aux avec dans de des du elle en est et il la le les ne pas par pour que qui sa se son sur un une "
    "als auch auf das dem den der des die ein eine einen für im ist mit nicht sich sie und von war was zu "
    "al como con del el es esta las lo los más no para por su sus y"
).split()
#: Content words in a chain.
CHAIN = 2
#: Likeness that defines the length bands.
BAND = 0.8
#: Pairs whose lengths leave less likeness than this are not compared and get 0.
PRUNE_BELOW = 0.1

_ANCHOR, _WORD = "\u0001", "\u0002"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _segments(words: Column, anchors: list[str]) -> Column:
    """One entry for each content word, with the anchors after it; the first entry holds those before any."""
    marked = F.transform(words, lambda w: F.concat(F.when(w.isin(anchors), _ANCHOR).otherwise(_WORD), w))
    return F.split(F.array_join(marked, ""), _WORD)


def _chains(segments: Column, chain: int) -> Column:
    """Hashes of each anchor with the ``chain`` content words after it."""

    def of(segment: Column, i: Column) -> Column:
        following = [F.substring_index(F.get(segments, i + k), _ANCHOR, 1) for k in range(1, chain + 1)]
        anchors = F.slice(F.split(segment, _ANCHOR), 2, 1 << 30)
        full = F.contains(segment, F.lit(_ANCHOR)) & (i + chain < F.size(segments))
        return F.when(full, F.transform(anchors, lambda a: F.hash(a, *following)))

    return F.flatten(F.filter(F.transform(segments, of), lambda x: x.isNotNull()))


def _runs(words: Column, text: Column, length: int) -> Column:
    """For texts without any full chain: hashes of every ``length`` words in a row, of the text itself if it has no word."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - length + 1, F.lit(1)))
    runs = F.transform(starts, lambda i: F.hash(F.array_join(F.slice(words, i, length), " ")))
    return F.when(F.size(words) > 0, runs).when(F.length(text) > 0, F.array(F.hash(text))).otherwise(F.array().cast("array<int>"))


def signatures(df: DataFrame, text: str, out: str, anchors: list[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Adds ``out``, the sorted set of signature hashes (array of int) of a text column.

    A null text counts as empty and has an empty set.  Equal texts have equal sets.  A column named
    ``out`` is replaced; internal columns start with ``_spot_``.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("_spot_words", _words(value))
    df = df.withColumn("_spot_segments", _segments(F.col("_spot_words"), anchors))
    df = df.withColumn("_spot_chains", _chains(F.col("_spot_segments"), chain))
    found = F.when(F.size("_spot_chains") > 0, F.col("_spot_chains")).otherwise(_runs(F.col("_spot_words"), value, chain + 1))
    return df.withColumn(out, F.array_sort(F.array_distinct(found))).drop("_spot_words", "_spot_segments", "_spot_chains")


def fingerprint(sigs: Column) -> Column:
    """The set as text: 32-bit hashes in hex, in order."""
    return F.array_join(F.transform(sigs, lambda s: F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))), " ")


def length_band(sigs: Column, threshold: float = BAND) -> Column:
    """Sets of likeness at least ``threshold`` are in the same or neighbouring bands; -1 for an empty set."""
    n = F.size(sigs)
    return F.when(n > 0, F.floor(F.log(n.cast("double")) / math.log(1 / threshold)).cast("int")).otherwise(F.lit(-1))


def likeness(a: Column, b: Column, prune_below: float = PRUNE_BELOW) -> Column:
    """Jaccard likeness of two signature sets, 0 to 1; 1 for two empty sets, 0 where the lengths or bands rule out ``prune_below``."""
    na, nb = F.size(a), F.size(b)
    bands = math.ceil(math.log(1 / prune_below) / math.log(1 / BAND)) + 1
    apart = (F.abs(length_band(a) - length_band(b)) > bands) | (F.least(na, nb) < prune_below * F.greatest(na, nb))
    shared = F.size(F.array_intersect(a, b))
    return F.when((na == 0) & (nb == 0), 1.0).when(apart | (na == 0) | (nb == 0), 0.0).otherwise(shared / (na + nb - shared))


def neighbours(df: DataFrame, key: str, payload: list[str]) -> tuple[DataFrame, Window]:
    """Rows dealt into key ranges, each range with the first rows of the next one as an end mark.

    Within ``Window`` (by range, in key order) ``lead`` gives the next row over the whole table, for
    the last row the first.  Rows that are end marks have ``_range_end`` = 1; drop them afterwards.
    The borders are keys of the table, found by one mergeable quantile sketch, so a lost task is
    dealt again alike.  Null keys come first; equal keys are ordered by the payload.
    """
    spark = df.sparkSession
    k = 4 * shuffle_width(spark)
    asked = F.percentile_approx(key, [i / k for i in range(k)], max(10_000, 10 * k))
    low, quantiles, nulls = df.agg(F.min(key), asked, F.count(F.when(F.col(key).isNull(), 1))).first()
    borders = sorted({low, *(quantiles or [])} - {None}) or [0]
    n = len(borders)
    literal = F.lit(borders)
    steps = F.lit([1 << s for s in range(n.bit_length() - 1, -1, -1)])
    at = F.aggregate(
        steps, F.lit(0), lambda lo, s: F.when(F.coalesce(F.get(literal, lo + s) <= F.col(key), F.lit(False)), lo + s).otherwise(lo)
    )
    rows = df.select(key, *payload)
    opens = F.col(key).isin(borders)
    if nulls:  # the rows with null keys open the first range
        opens = (opens & (F.col(key) != borders[0])) | F.col(key).isNull()
    both = rows.withColumn("_range_end", F.lit(0)).unionAll(rows.filter(opens).withColumn("_range_end", F.lit(1)))
    dealt = both.withColumn("_range", (at + F.lit(n) - F.col("_range_end")) % n).repartition("_range")
    return dealt, Window.partitionBy("_range").orderBy("_range_end", F.col(key).asc_nulls_first(), *payload)


def edited_likeness(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints every text and its edited text, and compares both and the next document's.

    The edited text has its last quarter (in code points, rounded down) replaced by as much of the
    beginning of the next document by ``key``.  Returns key, n_chars, edited (the text), both
    signature sets, and near_edited and near_next.  A null text counts as empty; repeated rows are
    each other's next; a single row is its own; an empty table gives an empty one.
    """
    # The key keeps its name: an alias below the union trips the optimizer's constraint inference.
    texts = df.select(key, F.coalesce(F.col(text), F.lit("")).alias("body"))
    dealt, order = neighbours(texts, key, ["body"])
    own = signatures(dealt, "body", "sigs")
    led = own.select(
        "*", F.lead("body").over(order).alias("next_body"), F.lead("sigs").over(order).alias("next_sigs")
    ).filter("_range_end = 0")
    n = F.char_length("body")
    cut = F.floor(n / 4).cast("int")
    led = led.withColumn("edited", F.concat(F.substring("body", F.lit(1), n - cut), F.substring("next_body", F.lit(1), cut)))
    both = signatures(led, "edited", "edited_sigs")
    return both.select(
        key,
        F.char_length("body").cast("long").alias("n_chars"),
        "edited",
        "sigs",
        "edited_sigs",
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )
