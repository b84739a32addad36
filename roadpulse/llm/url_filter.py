"""URL filter: rules for hosts and paths, and a ratio of character models for the other URLs.

Two variable-order Markov models (Witten-Bell smoothed, contexts of 0 to 4 characters) learn from the
distinct URLs that rules accept and from those that rules reject. A URL's score is the difference of its
log-likelihoods for each character; it is accepted from a threshold on, which is calibrated on a fifth
of the ruled URLs that the models have not seen.

All tables are keyed by grams and go through shuffles: a gram joins the gram without its first
character, so a key has no more rows than there are characters. Grams that all URLs share are joined
with their scores by a plain join, which adaptive execution splits.

A null or empty URL has score 0. Repeated rows get the same result; repeated URLs count once in the
models. If either class has no URL, all scores are 0 and the threshold is 0. Extra columns stay,
and columns with the names of the result give way; names that begin with two underscores are reserved.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.tables import settle

CONTEXT = 4
BEGIN, END = "\x02", "\x03"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: Fixed values.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """A struct of rule and verdict of the longest rule that fits, or null."""
    cases = [F.when((((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)),
                    F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")))
             for r in sorted(rules, key=lambda r: -len(r.host + r.path))]
    return F.coalesce(*cases)


def gram_scores(grams: DataFrame, context: int = CONTEXT) -> DataFrame:
    """From grams of context + 1 characters with counts a and b: the log-likelihood ratio of each one's last character."""
    tables = {context: grams}
    for k in range(context - 1, -1, -1):
        tables[k] = tables[k + 1].groupBy(F.expr("substr(gram, 2)").alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # below all contexts each character in use is equally likely; one row, so the join is a product with a scalar
    letters = tables[0].agg(F.count(F.lit(1)).alias("letters"))
    lower = tables[0].crossJoin(F.broadcast(letters)).select(F.lit("").alias("rest"), "gram", (1 / F.col("letters")).alias("pa"), (1 / F.col("letters")).alias("pb"))
    for k in range(context + 1):
        here = tables[k].withColumn("before", F.expr("substr(gram, 1, length(gram) - 1)"))
        stats = here.groupBy("before").agg(*[f(c).alias(f"{n}{c}") for c in "ab" for n, f in
                                             (("n", F.sum), ("t", lambda c: F.sum((F.col(c) > 0).cast("long"))))])
        base = lower.select(F.col("gram").alias("low"), "pa", "pb")
        low = F.col("gram") if k == 0 else F.expr("substr(gram, 2)")
        joined = here.join(stats, "before").withColumn("low", low).join(base, "low")
        p = [F.when(F.col(f"n{c}") > 0, (F.col(c) + F.col(f"t{c}") * F.col(f"p{c}")) / (F.col(f"n{c}") + F.col(f"t{c}")))
             .otherwise(F.col(f"p{c}")).alias(f"p{c}") for c in "ab"]
        lower = joined.select("gram", *p)
    return lower.select("gram", (F.ln("pa") - F.ln("pb")).alias("ratio"))


def _grams(urls: DataFrame, context: int) -> DataFrame:
    padded = F.concat(F.lit(BEGIN * context), F.col("__url"), F.lit(END))
    return (urls.withColumn("padded", padded)
            .withColumn("at", F.explode(F.sequence(F.lit(1), F.length("__url") + 1)))
            .withColumn("gram", F.substring("padded", F.col("at"), F.lit(context + 1)))
            .drop("padded", "at"))


def url_key(url: Column) -> Column:
    """128 bits that stand for a URL where its grams are shuffled."""
    return F.struct(F.xxhash64(url).alias("x"), F.xxhash64(F.reverse(url), F.lit(1)).alias("y"))


def score(urls: DataFrame, context: int = CONTEXT) -> DataFrame:
    """Distinct __url with __label (accepted, rejected or null) and __held: their __key, label, fold and score."""
    grams = _grams(urls, context)
    learnt = F.col("__label").isNotNull() & ~F.col("__held")
    counts = grams.groupBy("gram").agg(*[F.sum((learnt & (F.col("__label") == v)).cast("long")).alias(c) for c, v in (("a", "allow"), ("b", "block"))])
    ratios = gram_scores(counts.checkpoint(), context)
    keyed = _grams(urls.select("__url", url_key(F.col("__url")).alias("__key")), context).select("__key.x", "__key.y", "gram")
    sums = keyed.join(ratios, "gram").groupBy("x", "y").agg(F.avg("ratio").alias("score"))
    own = urls.select(url_key(F.col("__url")).alias("__key"), "__label", "__held").select("__key.x", "__key.y", "__label", "__held")
    return own.join(sums, ["x", "y"])


def threshold(scored: DataFrame) -> float:
    """Between the mean scores of the two classes' held-out URLs, by their spreads; one row is collected."""
    held = scored.filter("__held and __label is not null")
    of = lambda v: F.when(F.col("__label") == v, F.col("score"))
    row = held.agg(F.avg(of("allow")).alias("ma"), F.avg(of("block")).alias("mb"), F.stddev_pop(of("allow")).alias("sa"), F.stddev_pop(of("block")).alias("sb")).first()
    if row.ma is None or row.mb is None:
        return 0.0
    spread = row.sa + row.sb
    return (row.ma * row.sb + row.mb * row.sa) / spread if spread else (row.ma + row.mb) / 2


def judge(pages: DataFrame, url: str = "url", rules=RULES, context: int = CONTEXT) -> DataFrame:
    """All rows and columns, with host, path, rule, verdict and score."""
    settle(pages.sparkSession)
    taken = {"host", "path", "rule", "verdict", "score"}
    pages = pages.select(*[pages[c] for c in pages.columns if c.lower() not in taken])
    ruled = (pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
             .withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules)))
    urls = (ruled.filter(F.length(url) > 0).select(F.col(url).alias("__url"), F.col("__rule.verdict").alias("__label"))
            .distinct().withColumn("__held", F.crc32(F.col("__url")) % 5 == 0))
    scored = score(urls, context).checkpoint()  # read for the threshold and for the result
    least = threshold(scored)
    key = url_key(F.col(url))
    scored = scored.select(F.col("x").alias("__x"), F.col("y").alias("__y"), F.col("score").alias("__score"))
    joined = ruled.join(scored, (key["x"] == F.col("__x")) & (key["y"] == F.col("__y")), "left").withColumn("score", F.coalesce("__score", F.lit(0.0)))
    own = F.when(F.col("score") >= least, "allow").otherwise("block")
    return joined.select(*[pages[c] for c in pages.columns], "host", "path", F.col("__rule.rule").alias("rule"),
                         F.coalesce("__rule.verdict", own).alias("verdict"), "score")


def op9_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")).drop("url")
