"""URL filter by mined association rules.

A url is a set of tokens: its host's labels, path segments and query keys,
with digits folded.  Spark's FP-growth mines token combinations from labelled
urls; a combination becomes a rule when enough labelled urls have it (support),
enough of those are bad (confidence), and the share of bad ones is surely above
that of all labelled urls (the lower bound of its Wilson interval).  Rules are matched by an inverted
index: each stands under its rarest token, urls look up the rules of their
tokens, and a rule fires when the url has all its tokens.  A url is blocked if
any rule fires.

Given rules (host and path prefix, allow or block) come first: the longest
that fits decides, and only urls without one are left to the mined rules.

A url is bad for training if the document of its id is labelled low quality or
toxic.

Defined cases: a null url, or one without ``://``, has empty host and path, no
rule, no tokens and is allowed; a null page_id is kept; repeated rows are judged
alike; among given rules of one length the first by host and path decides; a
very long url is parsed whole; columns beyond page_id and url are not read;
without labels or frequent combinations no rule is mined and all is allowed; an
empty table gives no row.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazrank.llm.common import hot_join, staged, table

#: (host, path prefix, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.5
#: Standard deviations of the lower bound; many combinations are tried.
SURE = 3.0
#: Rules up to this number are broadcast; more meet the tokens in a shuffle.
BROADCAST_RULES = 20_000
BAD = "!bad"


_AFTER = "substring(url, instr(url, '://') + 3)"


def host_of() -> Column:
    """Of column ``url``: after the first ``://`` up to ``/``, ``?`` or ``#``."""
    cut = F.regexp_extract(F.expr(_AFTER), r"(?s)^([^/?#]*)", 1)
    host = F.translate(cut, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.instr("url", "://") > 0, host).otherwise("")


def path_of() -> Column:
    """Of column ``url``: from the host's end up to ``?`` or ``#``."""
    return F.when(F.instr("url", "://") > 0, F.regexp_extract(F.expr(_AFTER), r"(?s)^[^/?#]*([^?#]*)", 1)).otherwise("")


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, host, path, tokens``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    d = pages.select("page_id", url.alias("url"))
    d = d.select("page_id", "url", host_of().alias("host"), path_of().alias("path"))
    fold = lambda c: F.regexp_replace(F.lower(c), "[0-9]+", "#")
    tagged = lambda tag, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), fold(x)))
    keys = F.split(F.regexp_extract("url", r"(?s)\?([^#]*)", 1), "&")
    tokens = F.array_distinct(F.concat(tagged("h:", F.split("host", r"\.")), tagged("p:", F.split("path", "/")),
                                       tagged("q:", F.transform(keys, lambda x: F.substring_index(x, "=", 1)))))
    return d.select("page_id", "host", "path", tokens.alias("tokens"))


def given_rule(rules=RULES) -> Column:
    """The longest given rule that fits, as (rule, verdict), or null."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for host, path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r), reverse=True):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def mine(urls: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules: ``tokens, anchor`` (the rarest of them), ``confidence, support``.
    A rule that contains another rule's tokens is left out, since the shorter
    one fires wherever it does."""
    bad = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    known = urls.join(bad, urls["page_id"] == bad["doc_id"]).filter(F.size("tokens") > 0)
    # copies of a url's tokens are counted, not repeated
    items = staged(known.select(F.when(F.col("bad") == 1, F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items"), "tokens"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.filter(F.array_contains("consequent", BAD)).select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    base = items.agg(F.avg(F.array_contains("items", BAD).cast("int")).alias("share"), F.count("*").alias("n")).first()
    p, n = F.col("confidence"), F.col("support") * base["n"] / F.col("confidence")
    bound = (p + SURE ** 2 / (2 * n) - SURE * F.sqrt(p * (1 - p) / n + SURE ** 2 / (4 * n * n))) / (1 + SURE ** 2 / n)
    rules = rules.filter((F.size("tokens") > 0) & (bound > (base["share"] or 0.0)))
    token_n = items.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    rules = staged(rules)
    rare = rules.select("tokens", F.explode("tokens").alias("token")).join(token_n, "token").groupBy("tokens").agg(F.min(F.struct("n", "token")).alias("rare"))
    rules = rules.join(rare.select("tokens", F.col("rare.token").alias("anchor")), "tokens")
    short = rules.select("anchor", F.col("tokens").alias("part"))
    longer = rules.select("tokens", F.explode("tokens").alias("anchor")).join(short, "anchor").filter(
        (F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0)).select("tokens").distinct()
    return staged(rules.join(longer, "tokens", "left_anti"))


def fired(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Those of distinct token sets (``tokens``) on which some rule fires."""
    index = rules.select(F.col("anchor").alias("token"), F.col("tokens").alias("need"))
    if rules.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    hits = sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    return hits.filter(F.size(F.array_except("need", "tokens")) == 0).select("tokens").distinct()


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined``: the verdict of the given
    rule, else of the mined ones (``mined`` says whether one fires)."""
    urls = staged(parsed(pages).withColumn("token_key", F.sha2(F.to_json("tokens"), 256)))
    # one row per token set, with its number of urls; one set may have a third
    # of them
    sets = staged(urls.groupBy("token_key").agg(F.first("tokens").alias("tokens"), F.count("*").alias("n")))
    hit = fired(sets.select("tokens"), mine(urls, labels, min_support, min_confidence)).withColumn("mined", F.lit(True))
    found = sets.join(hit, "tokens", "left").select("token_key", "n", F.coalesce("mined", F.lit(False)).alias("mined"))
    d = hot_join(urls, staged(found), "token_key", "n")
    d = d.withColumn("given", given_rule(rules)).withColumn("by_method", F.when(F.col("mined"), "block").otherwise("allow"))
    return d.select("page_id", "host", "path", F.col("given.rule").alias("rule"), F.coalesce("given.verdict", "by_method").alias("verdict"), "mined")


def op5_url_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query: the verdict on every page."""
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).drop("mined")
