"""URL verdicts from listed rules and mined association rules, with built-in functions only."""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import fresh, keys_for_join, written

# The listed rules as (host, path, verdict).
LISTED = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


# The item that marks a basket as unwanted; tokens have other beginnings.
LABEL = "label=unwanted"


@dataclass(frozen=True)
class Mining:
    """A token combination of any size blocks when at least ``min_pages`` labelled pages have it and are unwanted, more
    than ``confidence`` of those that have it are, and that is no chance: the lower end of the share's Wilson
    interval (``deviations`` wide) is at least ``lift`` times the share of all labelled pages."""

    min_pages: int = 10
    confidence: float = 0.5
    lift: float = 1.25
    deviations: float = 1.96


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    part = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(part, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: scheme, labels of the host, path segments with digits as ``#``, query keys."""
    scheme = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    asked = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    named = lambda kind, parts: F.transform(F.array_remove(parts, ""), lambda x: F.concat(F.lit(kind), x))
    keys = F.transform(F.split(asked, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.array_distinct(
        F.concat(
            named("scheme=", F.array(F.coalesce(scheme, F.lit("")))),
            named("host=", F.split(host, r"\.")),
            named("path=", F.split(F.regexp_replace(path, "[0-9]+", "#"), "/")),
            named("query=", keys),
        )
    )


def wilson_floor(hits: Column, total: Column, deviations: float) -> Column:
    """Lower end of the Wilson score interval of a share."""
    z2 = deviations * deviations
    middle = hits + z2 / 2
    return (middle - deviations * F.sqrt(hits * (total - hits) / total + z2 / 4)) / (total + z2)


def token_groups(baskets: DataFrame, min_pages: int) -> DataFrame:
    """``token``, ``item``, ``tokens``: the tokens that enough unwanted pages have, those on exactly the same pages
    as one item (the first of them) with all of them; so what always comes together is not combined."""
    each = baskets.select("weight", "bad", F.xxhash64("items").alias("h"), F.explode("items").alias("token"))
    cover = each.groupBy("token").agg(
        F.sum("weight").alias("n"), F.sum("bad").alias("b"), F.bit_xor("h").alias("x"), F.bit_xor(F.xxhash64("h")).alias("y")
    )
    same = cover.filter(F.col("b") >= min_pages).groupBy("n", "b", "x", "y").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    return same.select(F.explode("tokens").alias("token"), F.element_at("tokens", 1).alias("item"), "tokens")


def mine(tokens: DataFrame, items: str, unwanted: Column, mining: Mining = Mining()) -> DataFrame:
    """``antecedent`` (for each item of a rule, its interchangeable tokens), ``confidence``, ``pages`` (unwanted
    ones) of the rules for unwanted pages, by Spark's FP-growth with the label as an item of its own.

    ``tokens`` holds a row per labelled page. Rules that hold another rule less one item are left out, as they
    block nothing more. A table without labelled or without unwanted pages gives no rules."""
    pages = tokens.select(F.array_sort(F.array_distinct(items)).alias("items"), unwanted.cast("long").alias("bad")).filter(F.size("items") > 0)
    pages = written(pages, "labelled")
    total, bad = pages.agg(F.count("*"), F.coalesce(F.sum("bad"), F.lit(0))).first()
    schema = "antecedent array<array<string>>, confidence double, pages long"
    if bad < mining.min_pages:
        return tokens.sparkSession.createDataFrame([], schema)
    groups = written(token_groups(pages.groupBy("items").agg(F.count("*").alias("weight"), F.sum("bad").alias("bad")), mining.min_pages), "tokens")
    numbered = pages.withColumn("page", F.monotonically_increasing_id())
    kept = numbered.select("page", "bad", F.explode("items").alias("token")).join(keys_for_join(groups.select("token", "item")), "token")
    label = F.when(F.col("bad") == 1, F.array(F.lit(LABEL))).otherwise(F.array().cast("array<string>"))
    baskets = kept.groupBy("page", "bad").agg(F.collect_set("item").alias("items")).select(F.concat("items", label).alias("items"))
    baskets = written(baskets, "baskets")
    floor = mining.lift * bad / total
    held = baskets.count()
    model = FPGrowth(minSupport=(mining.min_pages - 0.5) / max(held, 1), minConfidence=mining.confidence).fit(baskets)
    rules = model.associationRules.filter(F.col("consequent") == F.array(F.lit(LABEL)))
    hits = F.round(F.col("support") * held)
    seen = F.round(hits / F.col("confidence"))
    found = written(
        rules.select(F.array_sort("antecedent").alias("set"), "confidence", hits.cast("long").alias("pages"), seen.alias("seen"))
        .filter((F.col("pages") >= mining.min_pages) & (F.col("pages") > mining.confidence * F.col("seen")))
        .filter(wilson_floor(F.col("pages"), F.col("seen"), mining.deviations) >= floor),
        "rules",
    )
    parts = found.select("set", F.explode(F.transform("set", lambda x: F.array_remove("set", x))).alias("part"))
    more = parts.join(found.select(F.col("set").alias("part")), "part", "left_semi").select("set").distinct()
    least = found.join(more, "set", "left_anti").withColumn("rule", F.monotonically_increasing_id())
    least = written(least, "least-rules")
    named = least.select("rule", "confidence", "pages", F.explode("set").alias("item"))
    members = groups.filter("token = item").select("item", "tokens")
    return named.join(members, "item").groupBy("rule", "confidence", "pages").agg(F.collect_list("tokens").alias("antecedent")).select("antecedent", "confidence", "pages")


def listed_rule(host: Column, path: Column, rules=LISTED) -> tuple[Column, Column]:
    """Name and verdict of the longest listed rule that fits the host or a domain above it, and whose
    path starts the path; both NULL without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for domain, start, decision in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        name, verdict = F.when(fits, domain + start).otherwise(name), F.when(fits, decision).otherwise(verdict)
    return name, verdict


def blocked_urls(urls: DataFrame, url: str, items: str, rules: DataFrame) -> DataFrame:
    """Distinct ``url`` that hold, of every item of a rule, one of its tokens.

    The rules are indexed by their rarest item, and a URL meets only the rules of its tokens."""
    single = urls.select(url, items).dropDuplicates([url])
    parts = written(rules.select(F.monotonically_increasing_id().alias("rule"), "antecedent"), "rules")
    choices = parts.select("rule", F.explode("antecedent").alias("tokens"))
    known = written(choices.select(F.explode("tokens").alias("token")).distinct(), "known")
    spread = single.select(url, items, F.explode(items).alias("token"))
    seen = spread.select("token").join(keys_for_join(known), "token").groupBy("token").count()
    rarest = (
        choices.withColumn("token", F.explode("tokens"))
        .join(written(seen, "seen"), "token")
        .groupBy("rule", "tokens")
        .agg(F.sum("count").alias("count"))
        .groupBy("rule")
        .agg(F.min_by("tokens", F.struct("count", "tokens")).alias("tokens"))
    )
    index = written(parts.join(rarest, "rule").select("antecedent", F.explode("tokens").alias("token")), "index")
    held = F.forall("antecedent", lambda tokens: F.arrays_overlap(tokens, F.col(items)))
    return spread.join(index, "token").filter(held).select(url).distinct()


def filter_urls(
    df: DataFrame, labels: DataFrame, url: str = "url", page_id: str = "page_id", mining: Mining = Mining(), rules=LISTED
) -> DataFrame:
    """All columns, with ``host``, ``path``, ``rule``, ``verdict`` and ``mined`` (whether a mined rule blocks);
    columns of these names are replaced.

    ``labels`` holds ``page_id`` and ``unwanted`` (boolean, NULL as false). A listed rule decides; else a mined
    one blocks; else the page is allowed. A NULL URL has empty parts, no tokens, and is allowed. Rows that
    repeat a URL get the same verdict, and labels of a repeated identifier count once each."""
    df = df.drop(*[c for c in df.columns if c.lower() in ("host", "path", "rule", "verdict", "mined")])
    (items,) = fresh(df, "_items")
    parts = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    tokens = parts.select(page_id, url, tokens_of(F.col(url), F.col("host"), F.col("path")).alias(items)).filter(F.col(url).isNotNull())
    labelled = tokens.select(page_id, items).join(labels.select(F.col(page_id), F.col("unwanted").alias("_unwanted")), page_id)
    mined = mine(labelled, items, F.coalesce("_unwanted", F.lit(False)), mining)
    blocked = written(blocked_urls(tokens, url, items, mined).withColumn("mined", F.lit(True)), "blocked")
    name, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    out = parts.join(blocked, url, "left").withColumn("mined", F.coalesce("mined", F.lit(False)))
    return out.withColumns(
        {"rule": name, "verdict": F.coalesce(verdict, F.when(F.col("mined"), "block").otherwise("allow"))}
    ).select(*df.columns, "host", "path", "rule", "verdict", "mined")
