"""URL filters: a given list of rules, and association rules mined from labelled URLs."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tideline.llm.shared import attach, checkpointed, stored

#: (verdict, host, path)
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Share of the labelled URLs, and number of them, in which a combination must occur.
MIN_SUPPORT, MIN_COUNT = 0.001, 10
MIN_CONFIDENCE = 0.6
#: Rules are broadcast up to this number (a few hundred bytes each), else joined by shuffle.
BROADCAST_RULES = 10_000
_BAD = "label=block"
#: Tokens of deep segments, the third and further ones of a path.
_DEEP = "p="


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, r"\A(?s:.*?)://([^/?#]*)", 1), F.lit("")), upper, lower)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"\A(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    """Sorted tokens: host labels by their place from the right (the fifth takes all further ones),
    the first two path segments by their place, all further ones as a set without places, and the
    ending of the path. Digits become ``#``. All but the further segments are at most eight."""
    labels = F.reverse(F.split(host, "\\."))
    parts = F.array_remove(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), "")
    named = [F.concat(F.lit(f"h{i}="), F.get(labels, F.lit(i))) for i in range(4)]
    far = F.array_join(F.reverse(F.slice(labels, 5, F.size(labels))), ".")
    named.append(F.when(F.size(labels) > 4, F.concat(F.lit("h4="), far)))
    named += [F.concat(F.lit(f"p{i}="), F.get(parts, F.lit(i))) for i in range(2)]
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})\z", 1)
    named.append(F.when(ending != "", F.concat(F.lit("end="), F.lower(ending))))
    deep = F.transform(F.slice(parts, 3, F.size(parts)), lambda part: F.concat(F.lit(_DEEP), part))
    return F.array_sort(F.array_distinct(F.concat(F.array_compact(F.array(*named)), deep)))


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule of the list that fits, and its verdict; nulls if none does.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    name = verdict = F.lit(None).cast("string")
    for said, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        name = F.when(fits, domain + start).otherwise(name)
        verdict = F.when(fits, said).otherwise(verdict)
    return name, verdict


def mine_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Rules (tokens, confidence, support, index_token) from rows (tokens, bad) by FP-growth.

    Combinations of tokens whose URLs are bad with ``min_confidence``. Both supports hold. A rule
    is indexed by the rarest of its tokens. Those with deep segments, of which a URL may have any
    number, come from ``deep_rules``, which leaves out what a part of a rule does as well. Rules of
    both kinds are of any length.
    """
    items = checkpointed(
        labelled.select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(_BAD)))).otherwise(F.col("tokens")).alias("items"))
    )
    n = max(1, items.count())
    least = min(1.0, max(min_support, min_count / n))
    deep = F.exists("items", lambda t: t.startswith(_DEEP))
    mined = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(
        items.select(F.filter("items", lambda t: ~t.startswith(_DEEP)).alias("items"))
    )
    rules = mined.associationRules.where(F.array_contains("consequent", _BAD)).select(
        F.array_sort("antecedent").alias("tokens"), "confidence", "support"
    )
    with_deep = items.where(deep)
    if not with_deep.isEmpty():
        rules = rules.unionByName(deep_rules(with_deep, n, least, min_confidence))
    rules = checkpointed(rules)
    single = items.select(F.explode("items").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    rarest = (
        rules.select("tokens", F.explode("tokens").alias("token")).join(single, "token")
        .groupBy("tokens").agg(F.min(F.struct("freq", "token")).alias("r"))
        .select("tokens", F.col("r.token").alias("index_token"))
    )
    return checkpointed(rules.join(rarest, "tokens"))


def deep_rules(items: DataFrame, n: int, min_support: float, min_confidence: float) -> DataFrame:
    """Rules (tokens, confidence, support) of any length with a deep segment.

    ``items`` are those of the ``n`` labelled URLs that have a deep segment; no other holds such a
    combination, so counts are whole. A long path has too many combinations to list them all. One in
    as many good URLs as a part of it is in no more bad ones, and its extensions are not either beside
    those of the part: the part matches wherever it does, with at least its confidence and support. So
    only combinations that each of their tokens takes from good URLs are kept and extended, token by
    token, which changes no URL's verdict, confidence or support.
    """
    least = max(1, math.ceil(min_support * n - 1e-9))
    labelled = items.select(
        F.array_remove("items", _BAD).alias("items"), F.array_contains("items", _BAD).cast("long").alias("bad")
    )
    counts = [F.sum("bad").alias("bad"), F.sum("good").alias("good")]
    labelled = labelled.withColumn("good", 1 - F.col("bad"))
    single = checkpointed(
        labelled.select(F.explode("items").alias("token"), "bad", "good").groupBy("token").agg(*counts).where(F.col("bad") >= least)
    )
    is_deep = lambda t: t.startswith(_DEEP)
    # Deep tokens come first, so that a combination's first ones make a combination too.
    rank = F.struct((~is_deep(F.col("token"))).alias("shallow"), "token")
    frequent = (
        labelled.groupBy(F.col("items").alias("whole")).agg(*counts)
        .select("whole", "bad", "good", F.explode("whole").alias("token")).join(single.select("token"), "token")
        .groupBy("whole", "bad", "good").agg(F.sort_array(F.collect_list(rank))["token"].alias("items"))
    )
    # Stored, as the ids follow the order in which rows came.
    sets = checkpointed(frequent.groupBy("items").agg(*counts).withColumn("id", F.monotonically_increasing_id()))
    kept = checkpointed(single.where(is_deep(F.col("token"))).select(F.array("token").alias("tokens"), "bad", "good"))
    found = kept
    # Which sets hold which combinations, with the place of the last token in the set.
    places = sets.select("id", F.posexplode("items").alias("at", "token"))
    holds = places.where(is_deep(F.col("token"))).select("id", F.array().cast("array<string>").alias("start"), "token", "at")
    while not kept.isEmpty():
        tokens = F.concat("start", F.array("token"))
        # Nothing is to be taken from combinations of bad URLs alone.
        open_ = holds.join(kept.where("good > 0").select(F.col("tokens").alias("_k")), tokens == F.col("_k"), "left_semi")
        more = places if found is kept else open_
        more = more.select(*[F.col(c).alias(f"_{c}") for c in more.columns])
        same = (F.col("id") == F.col("_id")) & (F.col("_at") > F.col("at"))
        if found is not kept:
            same = same & (F.col("start") == F.col("_start"))
        wider = stored(open_.join(more, same).select(
            "id", tokens.alias("start"), F.col("_token").alias("token"), F.col("_at").alias("at")
        ), "holds")
        counted = (
            wider.join(sets.select("id", "bad", "good"), "id").groupBy(tokens.alias("tokens")).agg(*counts).where(F.col("bad") >= least)
        )
        without = F.explode(F.transform(
            F.sequence(F.lit(1), F.size("tokens")),
            lambda i: F.concat(F.slice("tokens", F.lit(1), i - 1), F.slice("tokens", i + 1, F.size("tokens"))),
        ))
        parts = counted.select("*", without.alias("_part")).where(is_deep(F.col("_part")[0]))
        kept_parts = kept.select(F.col("tokens").alias("_part"), F.col("good").alias("_good"))
        kept = stored(
            parts.join(kept_parts, "_part", "left").groupBy("tokens", "bad", "good")
            .agg(F.min(F.coalesce("_good", F.lit(-1))).alias("_least")).where(F.col("good") < F.col("_least")).drop("_least"),
            "kept",
        )
        found = found.unionByName(kept)
        holds = wider.join(kept.select(F.col("tokens").alias("_k")), tokens == F.col("_k"), "left_semi")
    confidence = F.col("bad") / (F.col("bad") + F.col("good"))
    return found.where(confidence >= min_confidence).select(
        F.array_sort("tokens").alias("tokens"), confidence.alias("confidence"), (F.col("bad") / n).alias("support")
    )


def match_rules(urls: DataFrame, rules: DataFrame, tokens: str, spread: list[str]) -> DataFrame:
    """``urls`` with ``mined_rule`` (text) and ``confidence`` of the best rule that matches.

    Distinct token sets look their tokens up in the index and check the rules found there whole.
    The most confident rule wins, then the best supported, then the first by its tokens.
    """
    sets = checkpointed(urls.groupBy(F.col(tokens)).agg(F.count(F.lit(1)).alias("_size")))
    index = F.broadcast(rules) if rules.count() <= BROADCAST_RULES else rules
    index = index.withColumnRenamed("tokens", "_needs")
    order = F.struct(
        (-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.col("_needs").alias("needs")
    )
    best = (
        sets.select(F.col(tokens).alias("_tokens"), F.explode(tokens).alias("index_token"))
        .join(index, "index_token")
        .where(F.size(F.array_except("_needs", "_tokens")) == 0)
        .groupBy("_tokens").agg(F.min(order).alias("o"))
        .select(F.col("_tokens").alias(tokens), F.array_join("o.needs", " ").alias("mined_rule"), (-F.col("o.c")).alias("confidence"))
    )
    groups = checkpointed(sets.join(best, tokens, "left"))
    return attach(urls, groups, tokens, "_size", spread).drop("_size")


def judge_urls(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Every row's id, host, path, listed rule, verdict, and the mined rule with its confidence.

    The label of a page is that of the document with its id: quality 0 is bad (several are averaged,
    half is good). A URL that no listed rule fits is blocked if a mined rule matches, else allowed.
    A null URL has an empty host and path and no tokens but those of an empty host.
    """
    host, path = url_host(F.col(url)), url_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("tokens", url_tokens(F.col("host"), F.col("path")))
    marks = labels.where("quality IS NOT NULL").groupBy(F.col("doc_id").alias("page_id")).agg(
        (F.avg("quality") < 0.5).alias("bad")
    )
    mined = mine_rules(rows.join(marks, "page_id").select("tokens", "bad"))
    name, said = listed_rule(F.col("host"), F.col("path"))
    found = match_rules(rows, mined, "tokens", ["page_id", "host", "path"])
    method = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return found.select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(said, method).alias("verdict"),
        "mined_rule", "confidence",
    )
