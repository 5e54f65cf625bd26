"""URL filter by a character language-model ratio, with host and path rules that come first.

Two variable-order Markov models (two characters of context, Witten-Bell interpolated down to none) are counted over accepted
and over rejected URLs; a URL's score is the mean, over its characters, of the difference of their log-probabilities. The
threshold is calibrated on labelled URLs kept out of training. Everything is DataFrame expressions: training is one
aggregation to at most 2 x 32,768 cells whatever the input, and the dense table of differences reaches the scoring
projection as a scalar subquery, so scoring needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = LOWER + "0/.-"  # classes 0-29; 30 is any other character, 31 the start
OTHER, START, RADIX = 30, 31, 32
CELLS = RADIX**3
#: Parts of host names that mark rejected URLs for training.
SEEDS = ("ads", "adult", "bet", "bets", "casino", "farm", "pills", "poker", "porn", "spam", "track", "viagra", "win", "xxx")
BIN = 1000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; a rule is (allow or block, host/path)."""
    rule = verdict = None
    for verb, text in sorted(rules, key=lambda r: -len(r[1])):
        h, p = text.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, verb) if verdict is None else verdict.when(fits, verb)
    none = F.lit(None).cast("string")
    return (rule if rule is not None else none), (verdict if verdict is not None else none)


def cells(text: Column) -> Column:
    """Cell of every character with the two before it: ((c-2) * 32 + c-1) * 32 + c."""
    plain = F.translate(F.translate(text, UPPER, LOWER), "123456789", "000000000")
    chars = F.filter(F.split(plain, ""), lambda c: c != "")
    codes = F.transform(chars, lambda c: F.coalesce(F.nullif(F.instr(F.lit(SYMBOLS), c), F.lit(0)) - 1, F.lit(OTHER)))
    padded = F.concat(F.array(F.lit(START), F.lit(START)), codes)
    pairs = F.zip_with(padded, F.slice(padded, 2, F.size(padded)), lambda a, b: a * RADIX + b)
    joined = F.zip_with(pairs, F.slice(padded, 3, F.size(padded)), lambda ab, c: ab * RADIX + c)
    return F.filter(joined, lambda c: c.isNotNull())


def model_table(labelled: DataFrame) -> DataFrame:
    """One row: ``cells``, the array of log-probability differences by cell. ``labelled``: text, rejected (boolean)."""
    spark = labelled.sparkSession
    counts = (
        labelled.where("text is not null and rejected is not null")
        .select(F.col("rejected").cast("int").alias("y"), F.explode(cells(F.col("text"))).alias("c"))
        .groupBy("y", "c")
        .agg(F.count("*").alias("n"))
        .select((F.col("y") * CELLS + F.col("c")).cast("long").alias("id"), "n")
    )
    grid = spark.range(0, 2 * CELLS, 1, 4).join(counts, "id", "left").select("id", F.coalesce("n", F.lit(0)).cast("double").alias("n"))
    g = grid.selectExpr("id", "n", f"id div {CELLS} y", f"(id % {CELLS}) div {RADIX} ba", f"(id div {RADIX}) % {RADIX} a", f"id % {RADIX} c")
    seen = lambda col: F.when(F.col(col) > 0, 1.0).otherwise(0.0)
    over = lambda *keys: Window.partitionBy(*keys)
    g = g.withColumn("nac", F.sum("n").over(over("y", "a", "c"))).withColumn("nba", F.sum("n").over(over("y", "ba"))).withColumn("tba", F.sum(seen("n")).over(over("y", "ba")))
    # of an (a, c) the rows with b = 0 stand for it, so that each pair counts once
    first = (F.col("ba") < RADIX).cast("double")
    g = g.withColumn("na", F.sum(F.col("nac") * first).over(over("y", "a"))).withColumn("ta", F.sum(seen("nac") * first).over(over("y", "a")))
    g = g.withColumn("nc", F.sum(F.col("nac") * first).over(over("y", "c"))).withColumn("n0", F.sum("n").over(over("y")))
    p0 = (F.col("nc") + 1.0) / (F.col("n0") + RADIX)
    p1 = F.when(F.col("na") > 0, (F.col("nac") + F.col("ta") * p0) / (F.col("na") + F.col("ta"))).otherwise(p0)
    p2 = F.when(F.col("nba") > 0, (F.col("n") + F.col("tba") * p1) / (F.col("nba") + F.col("tba"))).otherwise(p1)
    signed = F.log(p2) * F.when(F.col("y") == 0, 1.0).otherwise(-1.0)
    by_cell = g.select((F.col("id") % CELLS).alias("k"), signed.alias("v"), "n0").groupBy("k").agg(F.sum("v").alias("v"), F.min("n0").alias("least"))
    by_cell = by_cell.select(F.struct("k", F.when(F.col("least") > 0, F.col("v")).otherwise(0.0).alias("v")).alias("kv"))
    return by_cell.agg(F.transform(F.array_sort(F.collect_list("kv")), lambda x: x["v"]).alias("cells"))


def score(text: Column, table: Column) -> Column:
    """Mean log-probability difference of the characters (accepted minus rejected); null without any. ``table`` must be a
    plain column: a scalar subquery can't stand inside a lambda."""
    found = cells(text)
    total = F.aggregate(found, F.lit(0.0), lambda s, c: s + F.get(table, c))
    return F.when(F.size(found) > 0, total / F.size(found))


def calibrated(scored: DataFrame) -> DataFrame:
    """One row: ``threshold``, the score below which URLs are rejected, that separates ``scored`` (score, rejected) best
    by the sum of both classes' recalls; null if a class is missing. Scores are counted in bins of 1/1000."""
    bins = (
        scored.where("score is not null and rejected is not null")
        .groupBy(F.floor(F.col("score") * BIN).alias("b"))
        .agg(F.sum(F.col("rejected").cast("double")).alias("r"), F.sum(1.0 - F.col("rejected").cast("double")).alias("a"))
    )
    w = Window.orderBy("b")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = lambda c: F.try_divide(F.coalesce(F.sum(c).over(before), F.lit(0.0)), F.sum(c).over(everything))
    below, above = share("r"), 1.0 - share("a")
    cut = (F.col("b") + F.coalesce(F.lag("b").over(w) + 1, F.col("b"))) / (2.0 * BIN)
    rated = bins.select("b", cut.alias("cut"), (below + above).alias("j"))
    return rated.where("j is not null").agg(F.max_by("cut", F.struct("j", -F.col("b"))).alias("threshold"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = (), seeds: Sequence[str] = SEEDS, labels: DataFrame | None = None) -> DataFrame:
    """Judge every row's ``url``: host, path, rule (null: none fits), score and verdict (allow or block) are added.

    Training URLs come from ``labels`` (url, rejected boolean) if given; otherwise the pages themselves, rejected where a
    part of the host between dots and hyphens is in ``seeds``. Three in sixteen labelled URLs (by md5) calibrate, the
    others train. Null urls and urls without ``://`` have empty host and path and no score. Without a score, or if the labels lack
    a class, the method allows. Repeated rows are judged alike; columns named like the added ones are replaced, others kept.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    if labels is None:
        named = F.arrays_overlap(F.split(host, "[.-]"), F.array(*[F.lit(s) for s in seeds])) if seeds else F.lit(False)
        labels = pages.select("url", named.alias("rejected"))
    labels = labels.where("url is not null").select(F.concat(host, path).alias("text"), "rejected", F.substring(F.md5(F.col("url").cast("binary")), 1, 1).isin("0", "1", "2").alias("kept_out"))
    model = model_table(labels.where("not kept_out"))
    held = labels.where("kept_out").withColumn("_table", model.scalar())
    cut = calibrated(held.select(score(F.col("text"), F.col("_table")).alias("score"), "rejected"))
    out = pages.drop("host", "path", "rule", "score", "verdict").withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = next(n for n in (f"_table{k}" for k in range(len(out.columns) + 1)) if n not in {c.lower() for c in out.columns})
    out = out.withColumns({"rule": rule, own: model.scalar()})
    out = out.withColumn("score", score(F.concat("host", "path"), F.col(own))).drop(own)
    judged = F.when(F.col("score") < cut.scalar(), "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce(verdict, judged))
