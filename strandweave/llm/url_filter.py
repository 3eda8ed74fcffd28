"""URL filters: seed rules, and association rules mined from what they label.

A seed rule names a host and a path prefix; it holds for the host and all its subdomains, and the longest
fitting rule decides. The urls it decides are the labels: FP-growth mines the token combinations of their
hosts, paths and query names together with the verdict, and rules "tokens -> verdict" of enough support and
confidence are kept, without those that a shorter rule at least as confident makes superfluous. Every other
url is matched by an inverted index: a rule is filed under its rarest token, so a url meets only the rules
filed under tokens it has, and the remaining tokens are checked in place. The most confident, then best
supported rule decides; without any, the verdict is ``default``.

All native: Spark ML's FP-growth and DataFrame operations. Every labelled url is a transaction, and identifiers
are generalised to ``#``. A token that stands with one verdict only makes a rule by itself, and any longer rule
with it is superfluous; mining sees the other tokens of enough support. FP-growth has no limit to the length of
its sets, so where a url has more than ``WIDE`` such tokens the sets are counted level by level to ``longest``
instead, which gives the same rules. At most (tokens a url) / support tokens can be frequent, whatever the number
of urls; beyond ``MOST_RULES`` the rules are joined by shuffle instead of broadcast.

A null url, or one without ``://``, has an empty host and path: no seed rule fits it and it has no tokens, so
it gets ``default``. A null id is kept, repeated rows stay, an empty table gives an empty result; columns
besides the id and the url are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from strandweave.llm.common import let, lower_ascii
from strandweave.plans.cut import cut

#: (verdict, host, path prefix)
SEEDS = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
VERDICT = "verdict:"
MOST_RULES = 20_000
#: Tokens of a url up to which FP-growth mines all combinations.
WIDE = 12


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def seeded(rows: DataFrame, seeds=SEEDS) -> DataFrame:
    """Adds ``rule`` and ``seed`` (its verdict), null where no rule fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, host, path in sorted(seeds, key=lambda s: len(s[1] + s[2])):  # the longest is tested first
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rows.withColumns({"rule": rule, "seed": verdict})


def tokens(url: Column) -> Column:
    """Distinct tokens: host suffixes, path parts and query names; runs of digits as ``#``."""
    labels = F.filter(F.split(F.col("host"), r"\."), lambda x: x != "")
    suffixes = let(labels, lambda a: F.transform(F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1))), lambda n: F.concat(F.lit("host:"), F.array_join(F.slice(a, -F.least(n, F.size(a)), F.least(n, F.size(a))), "."))))
    parts = F.transform(F.filter(F.split(F.col("path"), "/"), lambda x: x != ""), lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "#")))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)))
    return F.when(F.col("host") == "", F.expr("array()").cast("array<string>")).otherwise(F.array_distinct(F.concat(suffixes, parts, names)))


def _fp_growth(items: DataFrame, support: float, confidence: float, longest: int) -> DataFrame:
    baskets = items.select(F.concat("tokens", F.array(F.concat(F.lit(VERDICT), F.col("seed")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    return model.associationRules.where(F.element_at("consequent", 1).startswith(VERDICT) & (F.size("antecedent") <= longest)).select(
        F.array_sort("antecedent").alias("antecedent"),
        F.substring(F.element_at("consequent", 1), len(VERDICT) + 1, 99).alias("verdict"),
        "confidence",
        "support",
    ).where(~F.exists("antecedent", lambda t: t.startswith(VERDICT)))


def _level_wise(items: DataFrame, support: float, confidence: float, longest: int) -> DataFrame:
    """The rules of :func:`_fp_growth` by growing frequent sets a token at a time."""
    n = items.count()
    sets = cut(items.where(F.size("tokens") > 0).groupBy(F.array_sort("tokens").alias("tokens"), "seed").agg(F.count("*").alias("weight")), "sets")
    grown, rules = sets.select("tokens", "seed", "weight", F.posexplode("tokens").alias("at", "token")).withColumn("antecedent", F.array("token")).drop("token"), None
    for level in range(longest):
        held = cut(grown, "grown")
        counts = cut(held.groupBy("antecedent", "seed").agg(F.sum("weight").alias("both")), "counts")
        whole = counts.groupBy("antecedent").agg(F.sum("both").alias("all"), F.max("both").alias("most"))
        sure = counts.join(whole, "antecedent").where((F.col("both") >= math.ceil(support * n)) & (F.col("both") / F.col("all") >= confidence))
        found = sure.select("antecedent", F.col("seed").alias("verdict"), (F.col("both") / F.col("all")).alias("confidence"), (F.col("both") / F.lit(n)).alias("support"))
        rules = found if rules is None else rules.unionByName(found)
        open_ = held.join(whole.where(F.col("most") >= math.ceil(support * n)).select("antecedent"), "antecedent", "left_semi")
        following = open_.select("antecedent", "tokens", "seed", "weight", F.explode(F.expr("CASE WHEN at + 1 < size(tokens) THEN sequence(at + 1, size(tokens) - 1) ELSE array() END")).alias("at"))
        grown = following.select("tokens", "seed", "weight", "at", F.concat("antecedent", F.array(F.get("tokens", F.col("at")))).alias("antecedent"))
    return rules


def mine(labelled: DataFrame, support: float, confidence: float, longest: int, wide: int = WIDE) -> DataFrame:
    """(antecedent, verdict, confidence, support): rules from (tokens, seed), superfluous ones removed."""
    n = labelled.count()
    each = labelled.select(F.explode(F.array_distinct("tokens")).alias("token"), "seed").groupBy("token", "seed").agg(F.count("*").alias("both"))
    counts = each.groupBy("token").agg(F.sum("both").alias("all"), F.max("both").alias("most"), F.max_by("seed", "both").alias("verdict"))
    frequent = cut(counts.where(F.col("most") >= max(1, math.ceil(support * n))), "frequent")
    rules = frequent.where(F.col("all") == F.col("most")).select(F.array("token").alias("antecedent"), "verdict", F.lit(1.0).alias("confidence"), (F.col("most") / F.lit(n)).alias("support"))
    # as many as the urls' tokens over the support, at most
    mixed = [r["token"] for r in frequent.where("all > most").orderBy("token").collect()]
    if mixed:
        items = cut(labelled.select(F.array_intersect("tokens", F.array(*[F.lit(t) for t in mixed])).alias("tokens"), "seed"), "items")
        by = _fp_growth if items.agg(F.max(F.size("tokens"))).first()[0] <= wide else _level_wise
        rules = rules.unionByName(by(items, support, confidence, longest))
    rules = cut(rules, "rules")
    # a rule is superfluous if one of its tokens fewer says the same at least as surely; filed by first token
    shorter = rules.select(F.col("antecedent").alias("less"), F.col("verdict").alias("said"), F.col("confidence").alias("sure"), F.explode("antecedent").alias("token"))
    each = rules.withColumn("token", F.explode("antecedent"))
    worse = each.join(shorter, "token").where((F.col("verdict") == F.col("said")) & (F.size("less") < F.size("antecedent")) & (F.size(F.array_except("less", "antecedent")) == 0) & (F.col("sure") >= F.col("confidence")))
    return cut(rules.join(worse.select("antecedent", "verdict").distinct(), ["antecedent", "verdict"], "left_anti"), "rules")


def filter_urls(pages: DataFrame, seeds=SEEDS, support: float = 0.01, confidence: float = 0.9, longest: int = 4, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, plus mined (the tokens of the association rule that decided)."""
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    judged = seeded(rows, seeds).withColumn("tokens", tokens(url))
    rules = mine(judged.where("seed IS NOT NULL").select("tokens", "seed"), support, confidence, longest)
    held = rules.select(F.explode("antecedent").alias("token")).groupBy("token").agg(F.count("*").alias("uses"))
    # the token fewest rules share files the rule
    filed = rules.withColumn("number", F.monotonically_increasing_id()).withColumn("token", F.explode("antecedent")).join(held, "token")
    index = filed.groupBy("antecedent", "verdict", "confidence", "support").agg(F.min_by("token", F.struct("uses", "token")).alias("key"))
    index = cut(index, "index")
    if index.count() <= MOST_RULES:
        index = F.broadcast(index)
    score = F.struct(F.col("confidence"), F.col("support"), F.size("antecedent").alias("size"), F.col("verdict").alias("said"), F.col("antecedent"))
    # equal token sets of undecided urls are matched once, however many urls have them
    open_sets = judged.where("seed IS NULL AND size(tokens) > 0").select(F.array_sort("tokens").alias("tokens")).distinct()
    met = open_sets.withColumn("key", F.explode("tokens")).join(index, "key").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = met.groupBy(F.xxhash64("tokens").alias("mark"), F.hash(F.reverse("tokens")).alias("mark2")).agg(F.max(score).alias("best"))
    sorted_tokens = F.array_sort("tokens")
    undecided = judged.where("seed IS NULL").select("page_id", "host", "path", F.xxhash64(sorted_tokens).alias("mark"), F.hash(F.reverse(sorted_tokens)).alias("mark2")).join(best, ["mark", "mark2"], "left")
    none = F.lit(None).cast("string")
    return undecided.select("page_id", "host", "path", none.alias("rule"), F.coalesce("best.said", F.lit(default)).alias("verdict"), F.array_join("best.antecedent", " ").alias("mined")).unionByName(
        judged.where("seed IS NOT NULL").select("page_id", "host", "path", "rule", F.col("seed").alias("verdict"), none.alias("mined"))
    )
