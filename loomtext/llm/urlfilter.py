"""Operator 1: URL filter by a character language-model ratio, in DataFrame functions only.

Explicit host/path rules judge what they cover. The URLs they accept and reject are the labels of two smoothed
variable-order Markov models over characters (orders 0 to ORDER, Witten-Bell backing off to shorter contexts). Every
other URL is judged by the length-normalised difference of its log-likelihoods under the two; the threshold is
calibrated on labelled URLs that were held out of the counts, so that at most ACCEPT_LOSS of the accepted are blocked.

A model in back-off form is additive: the log-ratio of a URL is a sum, over the n-grams it contains, of one number
for each n-gram. So scoring is one explode, two joins and one sum. Every n-gram that occurs LEAST times among the labelled
URLs is kept; since an n-gram is never more frequent than its parts, what is kept is closed under shortening. The model
grows with the input: n-grams that hold a fixed share of all n-gram positions, at most (ORDER+1)/SHARE of them, are joined by
a broadcast, and the rarer ones, of which none is hot, by a shuffle.

Defined cases: a null URL, or one without "://", has an empty host and path and no rule; a null URL scores as an
empty string; with no accepted or no rejected labels the method allows; repeated rows are judged alike; an empty table
gives an empty result. Other columns of the input may have any names; they are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise, table

ORDER = 4
#: Occurrences among the labelled URLs from which on an n-gram is kept.
LEAST = 2
#: N-grams of at least this share of all positions are joined by a broadcast, the others by a shuffle; the rows are the same.
SHARE = 2e-5
#: One labelled URL in this many is held out of the counts and calibrates the threshold.
HELD_OUT = 5
ACCEPT_LOSS = 0.01
_SYMBOLS = 96.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str]
RULES: tuple[Rule, ...] = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _symbols(url: Column) -> Column:
    """The URL's characters between a start and an end mark; others than printable ASCII are one symbol."""
    low = F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER)
    plain = F.regexp_replace(low, r"[^\x21-\x7d]", "~")
    return F.split(F.concat(F.lit("\x02"), plain, F.lit("\x03")), "")


def _grams(symbols: Column) -> Column:
    """All n-grams of 1 to ORDER+1 characters, in an array of (gram)."""
    at = F.sequence(F.lit(1), F.size(symbols))
    of = lambda n: F.transform(F.filter(at, lambda i: i >= n), lambda i: F.array_join(F.slice(symbols, i - (n - 1), F.lit(n)), ""))
    return F.flatten(F.array(*[of(n) for n in range(1, ORDER + 2)]))


def _counted(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, n, yes, no): counts of the kept n-grams among accepted and rejected URLs; (gram): n-grams frequent among all URLs."""
    side = F.when(F.col("verdict").isNotNull() & ~F.col("held_out"), F.col("accepted"))
    grams = parsed.select(side.alias("accepted"), _symbols(F.col("url")).alias("symbols")).select("accepted", F.explode(_grams(F.col("symbols"))).alias("gram"))
    number = lambda of: F.sum(F.when(of, 1).otherwise(0).cast("long"))
    counts = grams.groupBy("gram").agg(number(F.col("accepted")).alias("yes"), number(~F.col("accepted")).alias("no"), F.count("*").alias("all"))
    counts = materialise(counts.withColumn("n", F.length("gram")), "grams")
    positions = counts.where("n = 1").agg(F.sum("all")).first()[0] or 0
    return counts.where(F.col("yes") + F.col("no") >= LEAST).drop("all"), counts.where(F.col("all") >= SHARE * positions).select("gram")


def _model(counts: DataFrame) -> tuple[DataFrame, float]:
    """(gram, value) whose sum over a URL's n-grams, plus the constant for each position, is its log-likelihood ratio."""
    kept = materialise(counts, "kept")
    contexts = kept.groupBy(F.expr("left(gram, n - 1)").alias("context")).agg(
        *[F.sum(side).cast("double").alias(f"{side}_n") for side in ("yes", "no")],
        *[F.sum((F.col(side) > 0).cast("double")).alias(f"{side}_t") for side in ("yes", "no")],
    )
    back = {side: F.when(F.col(f"{side}_n") > 0, F.log(F.col(f"{side}_t") / (F.col(f"{side}_n") + F.col(f"{side}_t")))).otherwise(0.0) for side in ("yes", "no")}
    contexts = materialise(contexts.withColumns({f"{side}_back": back[side] for side in back}), "contexts")
    shorter = None
    levels = []
    for n in range(1, ORDER + 2):
        level = kept.where(F.col("n") == n).withColumns({"context": F.expr("left(gram, n - 1)"), "suffix": F.expr("substring(gram, 2)")}).join(contexts, "context")
        if shorter is None:
            level = level.withColumns({f"{side}_less": F.lit(1.0 / _SYMBOLS) for side in ("yes", "no")})
        else:
            level = level.join(shorter.select(F.col("gram").alias("suffix"), *[F.col(f"{side}_p").alias(f"{side}_less") for side in ("yes", "no")]), "suffix")
        share = {
            f"{side}_p": F.when(F.col(f"{side}_n") > 0, (F.col(side) + F.col(f"{side}_t") * F.col(f"{side}_less")) / (F.col(f"{side}_n") + F.col(f"{side}_t"))).otherwise(F.col(f"{side}_less"))
            for side in ("yes", "no")
        }
        level = level.withColumns(share)
        gain = {side: F.log(F.col(f"{side}_p")) - F.log(F.col(f"{side}_less")) - F.col(f"{side}_back") for side in ("yes", "no")}
        shorter = level.select("gram", "yes_p", "no_p", (gain["yes"] - gain["no"]).alias("gain"))
        levels.append(shorter.select("gram", "gain"))
    gains = levels[0]
    for level in levels[1:]:
        gains = gains.unionByName(level)
    as_context = contexts.select(F.col("context").alias("gram"), (F.col("yes_back") - F.col("no_back")).alias("open"))
    values = gains.join(as_context, "gram", "left").select("gram", (F.col("gain") + F.coalesce("open", F.lit(0.0))).alias("value"))
    root = contexts.where("context = ''").select(F.col("yes_back") - F.col("no_back")).first()
    return materialise(values, "ratio-model"), float(root[0]) if root else 0.0


def _threshold(scored: DataFrame) -> float:
    """The score under which ACCEPT_LOSS of the held-out accepted URLs lie, from a histogram of bounded size."""
    bins = scored.where("held_out AND accepted").groupBy(F.floor(F.greatest(F.least(F.col("score"), F.lit(20.0)), F.lit(-20.0)) * 1000).alias("bin")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    below = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("bin"))
    cut = bins.select("bin", total.alias("total"), below.alias("below")).where(F.col("below") <= F.col("total") * ACCEPT_LOSS).agg(F.max("bin")).first()[0]
    if cut is None:
        first = bins.agg(F.min("bin")).first()[0]
        return 0.0 if first is None else min(0.0, first / 1000.0)
    return (cut + 1) / 1000.0


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row for each row of pages: page_id, host, path, rule, verdict, score and threshold."""
    where = F.col(url)
    parsed = pages.select(F.monotonically_increasing_id().alias("_row"), F.col(page_id).alias("page_id"), where.alias("url"), url_host(where).alias("host"), url_path(where).alias("path"))
    parsed = parsed.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    parsed = parsed.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    parsed = parsed.select("_row", "page_id", "url", "host", "path", "_rule.rule", "_rule.verdict")
    parsed = parsed.withColumns({"accepted": F.col("verdict") == "allow", "held_out": F.conv(F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 8), 16, 10).cast("long") % HELD_OUT == 0})
    parsed = materialise(parsed, "urls")
    labelled = parsed.where("verdict IS NOT NULL AND NOT held_out")
    if {r[0] for r in labelled.select("accepted").distinct().collect()} != {True, False}:
        return parsed.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"), F.lit(None).cast("double").alias("threshold"))
    counts, frequent = _counted(parsed)
    frequent = materialise(frequent, "frequent")
    model, constant = _model(counts)
    value = F.round("value", 9).cast("decimal(28,9)")
    grams = parsed.select("_row", _symbols(F.col("url")).alias("symbols")).select("_row", F.explode(_grams(F.col("symbols"))).alias("gram"))
    sums = grams.join(F.broadcast(model.join(frequent, "gram", "left_semi")), "gram").groupBy("_row").agg(F.sum(value).alias("sum"))
    rare = model.join(frequent, "gram", "left_anti")
    if not rare.isEmpty():
        hits = grams.join(F.broadcast(frequent), "gram", "left_anti").join(rare.hint("shuffle_hash"), "gram")
        sums = sums.unionByName(hits.groupBy("_row").agg(F.sum(value).alias("sum")))
    sums = sums.groupBy("_row").agg(F.sum("sum").cast("double").alias("sum"))
    positions = F.length(F.coalesce("url", F.lit(""))) + 2
    score = F.coalesce("sum", F.lit(0.0)) / positions + F.lit(constant)
    scored = materialise(parsed.join(sums, "_row", "left").withColumn("score", score), "scored-urls")
    cut = _threshold(scored)
    judged = F.coalesce("verdict", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", judged.alias("verdict"), "score", F.lit(cut).alias("threshold"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return filter_urls(table(spark, sf_dir, "pages")).withColumn("score", F.round("score", 6))
