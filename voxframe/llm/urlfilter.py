"""URL filter: rules, and for the rest the ratio of two character language models; DataFrame functions only.

Urls that a rule decides are the labelled ones: they train a variable-order Markov model for each verdict. A
character's probability after its context of `order` characters is interpolated down to order 0, each order's count
smoothed by the next lower one's estimate; contexts that a verdict never had fall through to shorter ones. A url's
score is the mean over its characters of the log of the models' ratio. A logistic curve, fitted on a histogram
of the scores of labelled urls that were kept out of the models, puts the threshold.

Counts are kept by n-gram, so they follow the training data's distinct n-grams; scores join each url's n-grams
to the distinct n-grams' log ratios. Of that table the most frequent ones, at most FREQUENT, are broadcast, and give
their share where the url lies; only places with rarer n-grams are shuffled, and no n-gram of those has many.

A null url, or one without "://", has an empty host and path, meets no rule, and is judged by the models on its
own characters; a null or empty one has no characters, so no score, and like all urls where nothing could be learned
`allow`. Pages are judged by url, so repeated rows get equal verdicts. An empty table gives no rows.

Extra columns are left out, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import discard
from ._common import materialise
from .linededup import LOWER, UPPER

# The rules as (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
ORDER = 4
EDGE = "\x02"
BINS = 512
REACH = 8.0
#: N-grams that are broadcast with their ratios, some tens of bytes each.
FREQUENT = 200_000


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, "(?s)^.*?://", ""))
    return F.coalesce(F.translate(F.regexp_extract(rest, "(?s)^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, "(?s)^.*?://", ""))
    return F.coalesce(F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def by_rules(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def n_grams(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """id, ..., gram: each character of url with the `order` before it, the first ones after edge marks."""
    padded = urls.withColumn("_padded", F.concat(F.lit(EDGE * order), "url"))
    at = F.sequence(F.lit(1), F.length("url"))
    return padded.where(F.length("url") > 0).withColumn("gram", F.explode(F.transform(at, lambda i: F.substring(F.col("_padded"), i, F.lit(order + 1))))).drop("_padded", "url")


def log_ratios(grams: DataFrame, counts: DataFrame, order: int = ORDER, strength: float = 1.0) -> DataFrame:
    """gram, ratio for each gram: log of its last character's probability as accepted against as rejected.

    counts: gram, accepted, rejected of the training urls.
    """
    out = grams.withColumn("pa", F.lit(1 / 256)).withColumn("pr", F.lit(1 / 256))
    for k in range(order + 1):
        tail = lambda c, k=k: F.substring(c, order + 1 - k, k + 1)
        own = counts.groupBy(tail(F.col("gram")).alias("g")).agg(F.sum("accepted").alias("ga"), F.sum("rejected").alias("gr"))
        context = own.groupBy(F.substring("g", 1, k).alias("c")).agg(F.sum("ga").alias("ca"), F.sum("gr").alias("cr"))
        out = out.withColumn("_g", tail(F.col("gram"))).withColumn("_c", F.substring("_g", 1, k))
        out = out.join(own, F.col("_g") == F.col("g"), "left").join(context, F.col("_c") == F.col("c"), "left")
        put = lambda n, total, lower: (F.coalesce(n, F.lit(0)) + strength * lower) / (F.coalesce(total, F.lit(0)) + strength)
        out = out.select("gram", put(F.col("ga"), F.col("ca"), F.col("pa")).alias("pa"), put(F.col("gr"), F.col("cr"), F.col("pr")).alias("pr"))
    return out.select("gram", F.log(F.col("pa") / F.col("pr")).alias("ratio"))


def calibrated(bins: list[tuple[int, str, int]]) -> tuple[float, float]:
    """Slope and shift of a logistic curve over a histogram (bin, verdict, count) of scores."""
    slope, shift = 1.0, 0.0
    n = sum(c for *_, c in bins)
    if len({v for _, v, _ in bins}) < 2:
        return slope, shift
    for _ in range(50):
        g0 = g1 = 0.0
        h00, h01, h11 = 1e-3 * n, 0.0, 1e-6 * n
        g0 -= 1e-3 * n * (slope - 1)
        for b, verdict, c in bins:
            x = (b + 0.5) / BINS * 2 * REACH - REACH
            p = 1 / (1 + math.exp(-max(-40, min(40, slope * x + shift))))
            d, w = c * ((verdict == "allow") - p), c * p * (1 - p)
            g0, g1, h00, h01, h11 = g0 + d * x, g1 + d, h00 + w * x * x, h01 + w * x, h11 + w
        det = h00 * h11 - h01 * h01
        step0, step1 = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        slope, shift = slope + step0, shift + step1
        if abs(step0) + abs(step1) < 1e-9:
            break
    return slope, shift


def url_scores(urls: DataFrame, ratios: DataFrame, order: int = ORDER, most: int = FREQUENT) -> DataFrame:
    """url, told, score: the mean ratio over the url's characters.

    ratios: gram, times (it is met), ratio.
    """
    frequent = F.broadcast(ratios.orderBy(F.desc("times"), "gram").limit(most).select(F.col("gram").alias("_often"), F.col("ratio").alias("_ratio")))
    places = n_grams(urls.select("url", "told", F.col("url").alias("_key")), order).join(frequent, F.col("gram") == F.col("_often"), "left")
    add = lambda df, ratio: df.groupBy("_key", "told").agg(F.coalesce(F.sum(ratio), F.lit(0.0)).alias("s"), F.count(ratio).alias("n"))
    known = add(places, "_ratio")
    if ratios.count() <= most:
        return known.select(F.col("_key").alias("url"), "told", (F.col("s") / F.col("n")).alias("score"))
    rest = places.where("_often is null").select("_key", "told", "gram").join(ratios.select("gram", "ratio"), "gram")
    both = known.unionByName(add(rest, "ratio")).groupBy("_key", "told").agg((F.sum("s") / F.sum("n")).alias("score"))
    return both.withColumnRenamed("_key", "url")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", column: str = "url", order: int = ORDER, most: int = FREQUENT) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's score (null where a rule decides) for every row."""
    url = F.col(column)
    parsed = pages.select(F.col(key).alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumn("by_rule", by_rules(F.col("host"), F.col("path"), rules))
    parsed = parsed.select("page_id", "host", "path", F.col("by_rule.rule").alias("rule"), F.col("by_rule.verdict").alias("told"), F.coalesce("url", F.lit("")).alias("url"))
    parsed = materialise(parsed, "urls")
    # a url counts once however many pages have it; a fifth of the labelled ones is for the curve
    each = parsed.where("url <> ''").groupBy("url").agg(F.first("told").alias("told"))
    fold = F.when(F.col("told").isNotNull(), F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(5)))
    # every url becomes as many rows as it has characters, so all tasks should have their part
    parts = max(1, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    urls = materialise(each.withColumn("fold", fold).repartition(parts), "distinct")
    scored = F.col("told").isNull() | (F.col("fold") == 0)
    grams = n_grams(urls.select("url", "told", "fold", scored.alias("scored")), order)
    use = lambda verdict: F.count_if((F.col("fold") != 0) & (F.col("told") == verdict))
    counts = grams.groupBy("gram").agg(use("allow").alias("accepted"), use("block").alias("rejected"), F.count_if("scored").alias("times"))
    counts = materialise(counts, "counts")
    wanted = counts.where("times > 0").select("gram", "times")
    ratios = log_ratios(wanted.select("gram"), counts.where("accepted + rejected > 0").drop("times"), order)
    ratios = materialise(ratios.join(wanted, "gram"), "ratios")
    scores = materialise(url_scores(urls.where(scored), ratios, order, most), "scores")
    discard(urls, counts, ratios)
    at = F.least(F.greatest(F.floor((F.col("score") + REACH) / (2 * REACH) * BINS), F.lit(0)), F.lit(BINS - 1))
    bins = [(r.b, r.told, r["count"]) for r in scores.where("told is not null").groupBy(at.cast("int").alias("b"), "told").count().collect()]
    slope, shift = calibrated(bins) if bins else (1.0, 0.0)
    mine = scores.where("told is null").select(F.col("url").alias("_url"), (1 / (1 + F.exp(-(F.col("score") * slope + shift)))).alias("score"))
    # of a url that a rule decided, or that is empty, no score is wanted: it needs no partner
    asked = F.col("told").isNull() & (F.col("url") != "")
    joined = parsed.where(asked).join(mine, F.col("url") == F.col("_url"), "left").drop("_url")
    decided = parsed.where(~asked).withColumn("score", F.lit(None).cast("double"))
    verdict = F.coalesce(F.col("told"), F.when(F.col("score") < 0.5, "block").otherwise("allow"))
    return joined.unionByName(decided).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
