"""URL filtering by listed rules and by mined association rules.

A listed rule (host, path, verdict) fits its host and all subdomains when the url's path starts with the rule's;
the longest wins. Every other url is judged by rules that FP-growth mines from labelled urls: sets of url tokens
that go with a bad label, pruned by support and confidence. Both kinds are matched through an inverted index: a
listed rule is posted under its host, a mined one under its rarest token.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.store import stored

BAD = "label=bad"
#: The listed rules (host, path, verdict).
LISTED = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for a url without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.char_length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: scheme, host suffixes, path words and shapes, query keys."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.greatest(F.size(labels), F.lit(1))), ".")))
    words = F.filter(F.split(F.lower(path), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    path_tokens = F.transform(words, lambda w: F.concat(F.lit("path="), F.regexp_replace(w, r"\d+", "0")))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda q: F.concat(F.lit("query="), F.substring_index(q, "=", 1)))
    tokens = F.concat(F.array(F.concat(F.lit("scheme="), F.substring_index(url, "://", 1))), F.when(host == "", F.array()).otherwise(suffixes), path_tokens, keys)
    return F.coalesce(F.array_distinct(tokens), F.array().cast("array<string>"))


def mined_rules(labelled: DataFrame, min_support: float, min_confidence: float, min_lift: float) -> DataFrame:
    """Rules of columns tokens, confidence, support, lift from rows of ``tokens`` and ``bad``.

    The number of rules is bounded by the support: a pruned rule holds for at least that share of the rows.
    A rule is left out only if one on a subset of its tokens has the same confidence or more: it adds nothing to the verdict.
    """
    items = labelled.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.filter((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD))
    rules = rules.filter(F.col("lift") >= min_lift).select(F.array_sort("antecedent").alias("tokens"), "confidence", "support", "lift")
    rules = stored(rules, "url-mined")
    smaller = rules.select("tokens", "confidence", F.explode(F.expr("transform(sequence(1, size(tokens)), n -> filter(tokens, (t, i) -> i <> n - 1))")).alias("subset"))
    kept = rules.select(F.col("tokens").alias("subset"), F.col("confidence").alias("reached"))
    idle = smaller.join(kept, "subset").filter("reached >= confidence").select("tokens").distinct()
    return rules.join(idle, "tokens", "leftanti")


def _matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url_key and best confidence of the urls that hold all tokens of a mined rule."""
    counts = urls.select(F.explode("tokens").alias("token")).groupBy("token").count()
    posted = (
        rules.withColumn("rule_id", F.xxhash64("tokens"))
        .select("rule_id", "tokens", "confidence", F.explode("tokens").alias("token"))
        .join(counts, "token", "left")
        .groupBy("rule_id")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "token")).alias("rarest"), F.first("tokens").alias("rule_tokens"), F.max("confidence").alias("confidence"))
        .select(F.col("rarest.token").alias("token"), "rule_tokens", "confidence")
    )
    held = F.size(F.array_except("rule_tokens", "tokens")) == 0
    return (
        urls.select("url_key", "tokens", F.explode("tokens").alias("token"))
        .join(posted, "token")
        .filter(held)
        .groupBy("url_key")
        .agg(F.max("confidence").alias("bad_confidence"))
    )


def listed_rule(host: Column, path: Column, rules=LISTED) -> tuple[Column, Column]:
    """Name and verdict of the longest listed rule that fits, else null. The list is a parameter of fixed size."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, said in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def judged(
    pages: DataFrame,
    labels: DataFrame,
    rules=LISTED,
    min_support: float = 0.002,
    min_confidence: float = 0.75,
    min_lift: float = 1.2,
) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``pages`` (page_id, url).

    ``labels`` has url and bad (boolean); of a url with several labels the worst counts, null labels and urls are
    ignored. A url without listed rule is blocked if a mined rule fits, else allowed; so are urls that are null
    or have no host, for which both parts are empty. Without any label nothing is mined. Rows that repeat are
    judged alike and each returned. No pages give no rows.
    """
    host, path = host_and_path(F.col("url"))
    name, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select("page_id", "url").withColumns({"host": host, "path": path}).withColumns({"rule": name, "listed": verdict})
    tokens = url_tokens(F.col("url"), *host_and_path(F.col("url")))
    known = labels.filter("url is not null and bad is not null").groupBy("url").agg(F.max("bad").alias("bad"))
    labelled = stored(known.select(tokens.alias("tokens"), "bad"), "url-labels")
    out = rows
    if labelled.isEmpty():
        out = out.withColumn("bad_confidence", F.lit(None).cast("double"))
    else:
        mined = stored(mined_rules(labelled, min_support, min_confidence, min_lift), "url-rules")
        open_sets = rows.filter("listed is null").select(url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")).distinct()
        hits = _matched(open_sets.withColumn("url_key", F.xxhash64("tokens")), mined)
        key = F.xxhash64(url_tokens(F.col("url"), F.col("host"), F.col("path")))
        unlisted = rows.filter("listed is null").withColumn("url_key", key).join(hits, "url_key", "left").drop("url_key")
        out = rows.filter("listed is not null").withColumn("bad_confidence", F.lit(None).cast("double")).unionByName(unlisted)
    said = F.coalesce("listed", F.when(F.col("bad_confidence").isNotNull(), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", said.alias("verdict"), "bad_confidence")
