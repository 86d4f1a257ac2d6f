"""Secrets in texts by patterns and a battery of randomness tests (operator 11), on built-in functions only.

Pattern kinds are fixed.  Beside them every run of 20 or more characters of the base64 family is a
candidate.  The narrowest encoding that fits it (hexadecimal, base 32, lower case and digits, base 62,
base 64, URL-safe base 64) gives its alphabet, and three tests ask whether its symbols look drawn
evenly and independently from that alphabet:

* chi-squared uniformity over five groups of symbols (4 degrees of freedom, exact tail);
* runs above and below the middle of the alphabet (Wald and Wolfowitz, normal tail);
* serial correlation of neighbouring symbols (normal tail).

Fisher's method makes one p-value of the three (6 degrees of freedom, exact tail).  Words, paths and
numbers get tiny p-values.  Candidates of one encoding and length class (powers of two) are a family;
in each the Benjamini-Hochberg procedure finds the candidates that are not random, so that among those
discarded at most the share ``FDR`` is expected to be random.  The rest are found as kind ``random``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollstate.session import scratch_dir

# The pattern kinds in their order, their least lengths, and the group measured.
_NAME = r"((?i:password|passwd|secret|token|api_?key))"
PATTERNS = {
    "assign": (_NAME + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    "access": (r"AKIA[A-Z0-9]+", 20, 0),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{24,}", 24, 0),  # shorter runs would fail the length in any case
}
RANDOM = "random"
KINDS = [*PATTERNS, RANDOM]

MIN_RANDOM = 20
_RUN = "[A-Za-z0-9+/_=-]"
_CANDIDATE = f"(?<!{_RUN}){_RUN}{{{MIN_RANDOM},}}"

# Alphabets in the order of their digit values.
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
# Groups of symbols that ordinary words use unevenly (vowels, frequent consonants).
_COMMON = "aeiou", "hlnrstd"

FDR = 0.01
#: p-values are rounded up to this fraction of a decade, which bounds a family's distinct values.
STEPS = 50
_SMALLEST = 300.0


def groups(encoding: str) -> list[str]:
    """Five groups of an alphabet's symbols; every symbol is in one."""
    symbols = ALPHABETS[encoding]
    if encoding in ("hex", "HEX"):
        return [symbols[i : i + 3] for i in (0, 3, 6, 9)] + [symbols[12:]]
    vowels, frequent = ([c for c in symbols if c.lower() in g] for g in _COMMON)
    rest = [c for c in symbols if c.isalpha() and c not in vowels and c not in frequent]
    other = [c for c in symbols if not c.isalpha()]
    if encoding in ("base32", "base36"):
        return ["".join(g) for g in (vowels, frequent, rest[: len(rest) // 2], rest[len(rest) // 2 :], other)]
    upper = [c for c in symbols if c.isupper()]
    lower = [[c for c in g if c.islower()] for g in (vowels, frequent, rest)]
    return ["".join(g) for g in (upper, *lower, other)]


def infer(token: Column) -> Column:
    """Narrowest encoding that fits a candidate without its padding; null if none does."""
    return (
        F.when(token.rlike(r"^[0-9a-f]+$"), "hex")
        .when(token.rlike(r"^[0-9A-F]+$"), "HEX")
        .when(token.rlike(r"^(?=.*[2-7])[A-Z2-7]+$"), "base32")
        .when(token.rlike(r"^(?=.*[0-9])[a-z0-9]+$"), "base36")
        .when(token.rlike(r"^[A-Za-z0-9]+$"), "base62")
        .when(token.rlike(r"^[A-Za-z0-9+/]+$"), "base64")
        .when(token.rlike(r"^[A-Za-z0-9_-]+$"), "base64url")
    )


def _by_encoding(encoding: Column, value) -> Column:
    out = F.lit(None)
    for name in ALPHABETS:
        out = F.when(encoding == name, value(name)).otherwise(out)
    return out


def _normal_tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution by a fixed polynomial (error below 1e-7 of the density)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.least(F.lit(1.0), 2 * poly * F.exp(-x * x / 2) / math.sqrt(2 * math.pi))


def battery(df: DataFrame, token: str) -> DataFrame:
    """Adds ``encoding`` and ``p`` (null where no encoding fits) of the candidates in a column."""
    body = F.regexp_replace(F.col(token), "=+$", "")
    df = df.withColumn("_body", body).withColumn("encoding", infer(F.col("_body")))
    # Symbol values, once for each candidate, looked up by the code of the character.
    digits = {e: F.array(*[F.lit(float(a.find(chr(code)))) for code in range(128)]) for e, a in ALPHABETS.items()}
    symbols = F.filter(F.split("_body", ""), lambda c: c != "")
    values = _by_encoding(F.col("encoding"), lambda e: F.transform(symbols, lambda c: F.get(digits[e], F.ascii(c))))
    df = df.withColumn("_x", values).withColumn("_size", _by_encoding(F.col("encoding"), lambda e: F.lit(float(len(ALPHABETS[e])))))
    df = df.withColumn("_n", F.size("_x").cast("double")).withColumn("_mid", (F.col("_size") - 1) / 2)

    # Of every alphabet: the group of each symbol, and the groups' shares under an even draw.
    group_of = {e: [next(k for k, g in enumerate(groups(e)) if c in g) for c in a] for e, a in ALPHABETS.items()}
    df = df.withColumn("_group", _by_encoding(F.col("encoding"), lambda e: F.array(*map(F.lit, group_of[e]))))
    share = _by_encoding(F.col("encoding"), lambda e: F.array(*[F.lit(len(g) / len(ALPHABETS[e])) for g in groups(e)]))
    zero = F.lit(0.0)
    names = ("above", "runs", "prod", "g0", "g1", "g2", "g3", "g4")
    start = F.struct(F.lit(-1.0).alias("prev"), *[zero.alias(n) for n in names])

    def step(s: Column, v: Column) -> Column:
        x, before = v - F.col("_mid"), s["prev"] - F.col("_mid")
        first, group = s["prev"] < 0, F.get("_group", v.cast("int"))
        return F.struct(
            v.alias("prev"),
            (s["above"] + (x > 0).cast("double")).alias("above"),
            (s["runs"] + (first | ((x > 0) != (before > 0))).cast("double")).alias("runs"),
            (s["prod"] + F.when(first, 0.0).otherwise(before * x)).alias("prod"),
            *[(s[f"g{k}"] + (group == k).cast("double")).alias(f"g{k}") for k in range(5)],
        )

    df = df.withColumn("_s", F.aggregate("_x", start, step)).withColumn("_share", share)
    chi = F.lit(0.0)
    for k in range(5):
        expected = F.col("_n") * F.get("_share", F.lit(k))
        chi = chi + (F.col(f"_s.g{k}") - expected) * (F.col(f"_s.g{k}") - expected) / expected
    half = chi / 2
    p_even = F.exp(-half) * (1 + half)
    n, above = F.col("_n"), F.col("_s.above")
    below = n - above
    mean = 1 + 2 * above * below / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    # All on one side: no runs to test, and as unlikely as that under an even draw.
    p_runs = F.when(var > 0, _normal_tail((F.col("_s.runs") - mean) / F.sqrt(var))).otherwise(F.pow(F.lit(2.0), 1 - n))
    # The middle is known under an even draw, and so is the variance of a symbol: (size^2 - 1) / 12.
    spread = (F.col("_size") * F.col("_size") - 1) / 12
    p_serial = _normal_tail(F.col("_s.prod") / (spread * F.sqrt(n - 1)))
    tiny = F.lit(10.0 ** -_SMALLEST)
    y = -(F.log(F.greatest(p_even, tiny)) + F.log(F.greatest(p_runs, tiny)) + F.log(F.greatest(p_serial, tiny)))
    p = F.greatest(F.exp(-y) * (1 + y + y * y / 2), tiny)
    # The body of a candidate may be shorter than the candidate: padding alone is no secret.
    fits = F.col("encoding").isNotNull() & (F.col("_n") >= MIN_RANDOM - 2)
    return df.withColumn("p", F.when(fits, p)).drop("_body", "_x", "_size", "_n", "_mid", "_group", "_share", "_s")


def _steps(p: Column) -> Column:
    """A p-value rounded up to a step of the scale, as a whole number of steps below 1."""
    return F.floor(-F.log10(p) * STEPS + 1e-9)


def not_random(candidates: DataFrame, fdr: float) -> DataFrame:
    """Per family the least number of steps at which a candidate counts as not random.

    A family is ``encoding`` and ``length_class``; there are at most 7 * 32 of them, and a family
    has at most 300 * 50 distinct p-values, whatever the number of candidates.
    """
    family = ["encoding", "length_class"]
    counts = candidates.groupBy(*family, "steps").agg(F.count(F.lit(1)).alias("_c"))
    down = Window.partitionBy(*family).orderBy(F.desc("steps"))
    ranked = counts.select(
        *family, "steps", F.sum("_c").over(down).alias("_k"), F.sum("_c").over(Window.partitionBy(*family)).alias("_m")
    )
    passed = F.pow(F.lit(10.0), -F.col("steps") / STEPS) <= F.lit(fdr) * F.col("_k") / F.col("_m")
    return ranked.filter(passed).groupBy(*family).agg(F.min("steps").alias("_from"))


def _hits(kind: str, text: Column, matches: Column, pattern: str) -> Column:
    """Matches of one kind as (kind, i, gap before it, match); gaps come from the pieces between them."""
    pieces = F.split(text, pattern, -1)
    zipped = F.transform(
        F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("match")),
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.char_length(z["piece"]).alias("gap"), z["match"].alias("match")
        ),
    )
    return F.when(F.size(matches) > 0, zipped)


def scan(df: DataFrame, text: str = "text", fdr: float = FDR) -> DataFrame:
    """Adds ``found`` to every row: its secrets as an array of structs (start, kind, end, encoding, p),
    by start and then kind as listed; positions are code points, ends exclusive.

    Matches of a kind are leftmost and do not overlap; those shorter than the kind's least length are
    dropped after matching.  Kinds are independent: one place may be found by several.  A null, empty
    or harmless text gives an empty array; an empty table an empty result.  Repeated rows are scanned
    alike.  An input column named ``found`` (in any case) is replaced, others are kept but the text.

    Texts are read once.  The matches, without texts around them, go to the shared folder; their
    families' limits are a bounded table.  A row's matches meet in one task: as many as one text holds.
    """
    spark = df.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    keep = [c for c in df.columns if c != text and c.lower() != "found"]
    patterns = {**{k: p for k, (p, _, _) in PATTERNS.items()}, RANDOM: _CANDIDATE}
    rows = df.select(
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_kept"),
        body.alias("_text"),
        *[F.regexp_extract_all(body, F.lit(p), F.lit(0)).alias(f"_m{i}") for i, p in enumerate(patterns.values())],
    )
    arrays = [
        F.coalesce(_hits(k, F.col("_text"), F.col(f"_m{i}"), p), F.array().cast("array<struct<kind:string,i:int,gap:int,match:string>>"))
        for i, (k, p) in enumerate(patterns.items())
    ]
    each = rows.select("_row", "_kept", F.explode_outer(F.concat(*arrays)).alias("_h"))
    each = each.select("_row", F.when(F.coalesce(F.col("_h.i"), F.lit(0)) == 0, F.col("_kept")).alias("_kept"), "_h.*")
    each = battery(each.withColumn("_token", F.when(F.col("kind") == RANDOM, F.col("match"))), "_token")
    length = F.char_length("match")
    ok = F.lit(False)
    for k, (p, least, group) in PATTERNS.items():
        ok = F.when(F.col("kind") == k, F.char_length(F.regexp_extract("match", p, group)) >= least).otherwise(ok)
    each = each.select(
        "_row", "_kept", "kind", "i", "gap", length.alias("length"), ok.alias("_ok"), "encoding", "p",
        F.floor(F.log2(length)).cast("int").alias("length_class"), _steps(F.col("p")).alias("steps"),
    )
    folder = scratch_dir(spark, "secrets")
    each.write.parquet(folder)
    hits = spark.read.schema(each.schema).parquet(folder)
    limits = not_random(hits.filter("p IS NOT NULL"), fdr)
    hits = hits.join(F.broadcast(limits), ["encoding", "length_class"], "left")
    random = F.col("p").isNotNull() & (F.col("_from").isNull() | (F.col("steps") < F.col("_from")))
    before = Window.partitionBy("_row", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("length")).over(before)
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.struct((end - F.col("length")).alias("start"), order.alias("order"), "kind", end.alias("end"), "encoding", "p")
    spans = hits.select("_row", "_kept", F.when(F.when(F.col("kind") == RANDOM, random).otherwise(F.col("_ok")), span).alias("_span"))
    grouped = spans.groupBy("_row").agg(F.first("_kept", ignorenulls=True).alias("_kept"), F.array_sort(F.collect_list("_span")).alias("_spans"))
    found = F.transform("_spans", lambda s: F.struct(*[s[c].alias(c) for c in ("start", "kind", "end", "encoding", "p")]))
    return grouped.select(*[F.col(f"_kept.`{c}`").alias(c) for c in keep], found.alias("found"))


def listing(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
