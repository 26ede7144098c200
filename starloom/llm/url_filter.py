"""URLs judged by rules: given ones by host and path, else ones mined from labels.

Rules are mined by FP-growth over the tokens of labelled URLs. A rule says that URLs with certain
tokens are bad; it is kept if enough labelled URLs have the tokens (support), enough of those are
bad (confidence), and no rule of fewer of its tokens is as sure. Rules are matched by an inverted
index: each is filed under its least frequent token, URLs look up their tokens, and only rules that
are found so are compared in full.

FP-growth's work doubles with each token of a basket, so tokens are left out of baskets where that
changes no rule that is kept: those in too few bad URLs; all but one of tokens that are in the same
URLs, each of which may stand for the other in any rule; and those that are in bad URLs only or in
all URLs, as any rule of more tokens is no surer than the one without the others or without them.
"""

from __future__ import annotations

from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import beside, stored

#: The token that marks a bad URL; no URL's token has a blank.
BAD = "label bad"

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of (verdict, host, path) that fits the host or a parent and begins the path."""
    rule = verdict = F.lit(None).cast("string")
    for word, name, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(begin)
        rule = F.when(fits, F.lit(name + begin)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def tokens_of(host: Column, path: Column, url: Column) -> Column:
    """Different tokens of a URL: host labels, path parts and query keys, each with its kind."""
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    names = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p:"), F.regexp_replace(F.lower(x), "[0-9]+", "0")))
    keys = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.split_part(x, F.lit("="), F.lit(1))))
    every = F.array_distinct(F.concat(labels, names, keys))
    return F.filter(F.transform(every, lambda x: F.regexp_replace(x, r"\s", "_")), lambda x: F.length(x) > 2)


def mine_rules(labelled: DataFrame, min_support: float = 0.01, min_confidence: float = 0.5) -> DataFrame:
    """(rule_id, needed, confidence, support, filed) from (tokens, bad), once for each token a rule is filed under.

    A rule's tokens are together in ``min_support`` of the rows as bad ones, whatever the number of
    rows. ``needed`` has a list of tokens for each token of the rule, one of which a URL must have.
    """
    labelled = labelled.where("tokens IS NOT NULL AND bad IS NOT NULL").select("bad", F.array_distinct("tokens").alias("tokens"))
    labelled = stored(labelled.withColumn("row", F.monotonically_increasing_id()))
    rows = labelled.count()
    least = max(1, ceil(min_support * rows))
    seen = labelled.select("row", "bad", F.explode("tokens").alias("token"))
    # Tokens of equal rows have equal digests of them, of 128 bits.
    digests = [F.bit_xor(F.xxhash64("row", F.lit(k))).alias(f"rows{k}") for k in range(2)]
    counted = seen.groupBy("token").agg(F.count(F.lit(1)).alias("count"), F.count_if("bad").alias("n_bad"), *digests)
    groups = counted.where(F.col("n_bad") >= least).groupBy("count", "n_bad", "rows0", "rows1")
    groups = stored(groups.agg(F.min("token").alias("token"), F.collect_list("token").alias("members")))
    alone = (F.col("n_bad") == F.col("count")) | (F.col("count") == rows)
    confidence = F.col("n_bad") / F.col("count")
    single = groups.where(alone & (confidence >= min_confidence))
    single = single.select(F.array("token").alias("tokens"), confidence.alias("confidence"), (F.col("n_bad") / rows).alias("support"))
    kept = seen.join(beside(stored(groups.where(~alone).select("token"))), "token")
    baskets = kept.groupBy("row", "bad").agg(F.collect_set("token").alias("tokens"))
    baskets = baskets.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items"))
    absent = labelled.join(kept.select("row").distinct(), "row", "left_anti")
    baskets = baskets.unionAll(absent.select(F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>")).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(stored(baskets))
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
    rules = rules.select(F.sort_array("antecedent").alias("tokens"), "confidence", "support").unionAll(single)
    rules = stored(rules.withColumn("rule_id", F.xxhash64("tokens")))
    # A rule goes if one of its parts is as sure; parts are found by their filed token, like URLs.
    filed = _filed(rules, groups)
    parts = filed.select(F.col("rule_id").alias("part_id"), F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence"), "filed")
    wider = rules.select("rule_id", "tokens", "confidence", F.explode("tokens").alias("filed")).join(parts, "filed")
    covered = wider.where(
        (F.size("part") < F.size("tokens")) & (F.col("part_confidence") >= F.col("confidence")) & (F.size(F.array_except("part", "tokens")) == 0)
    )
    sure = stored(filed.join(covered.select("rule_id").distinct(), "rule_id", "left_anti"))
    members = sure.select("rule_id", F.explode("tokens").alias("token")).join(groups.select("token", "members"), "token")
    needed = members.groupBy("rule_id").agg(F.collect_list("members").alias("needed"))
    under = groups.select(F.col("token").alias("filed"), F.col("members").alias("under"))
    sure = sure.join(needed, "rule_id").join(under, "filed")
    return stored(sure.select("rule_id", "needed", "confidence", "support", F.explode("under").alias("filed")))


def _filed(rules: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds the least frequent token of each rule."""
    tokens = rules.select("rule_id", F.explode("tokens").alias("token")).join(groups.select("token", "count"), "token")
    rarest = tokens.groupBy("rule_id").agg(F.min(F.struct("count", "token")).alias("rarest"))
    return stored(rules.join(rarest.select("rule_id", F.col("rarest.token").alias("filed")), "rule_id"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    label_id_column: str = "doc_id",
    label_column: str = "quality",
    bad_label: int = 0,
    min_support: float = 0.01,
    min_confidence: float = 0.5,
) -> DataFrame:
    """(id, host, path, rule, verdict, mined_confidence) of each row.

    The longest given rule that fits decides; without one, ``verdict`` is ``block`` if a mined rule
    fits and else ``allow``. ``mined_confidence`` is the surest mined rule's that fits, or null. Labels
    are those of the rows whose id they name; a row with several labels is bad if any says so, null
    labels say nothing. A null URL or one without ``://`` has an empty host and path and no tokens.
    Repeated rows and null ids are kept. Other columns are not read. Without labels nothing is mined.
    """
    source = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = source.select("id", "url", host.alias("host"), path.alias("path"))
    urls = stored(parsed.select("url", "host", "path").distinct().select("url", tokens_of(F.col("host"), F.col("path"), F.col("url")).alias("tokens")))
    marks = labels.where(F.col(label_column).isNotNull() & F.col(label_id_column).isNotNull())
    marks = marks.groupBy(F.col(label_id_column).alias("id")).agg(F.max(F.col(label_column) == bad_label).alias("bad"))
    labelled = source.join(marks, "id").join(urls, "url").select("tokens", "bad")
    mined = mine_rules(labelled, min_support, min_confidence)
    looked_up = urls.select("url", "tokens", F.explode("tokens").alias("filed")).join(
        beside(mined.select("needed", "confidence", "filed")), "filed"
    )
    fitting = looked_up.where(F.forall("needed", lambda one_of: F.arrays_overlap(one_of, F.col("tokens"))))
    sure = beside(stored(fitting.groupBy("url").agg(F.max("confidence").alias("mined_confidence"))))
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    judged = parsed.join(sure, "url", "left").select("id", "host", "path", rule.alias("rule"), verdict.alias("given"), "mined_confidence")
    own = F.when(F.col("mined_confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("given", own).alias("verdict"), "mined_confidence"
    )
