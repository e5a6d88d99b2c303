"""Quality rules per document, and host verdicts by shrunken failure rates.

Every measure is a built-in expression evaluated inside the scan; no rows of words are made.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import WORD_CHAR, fresh, words_of, written

# The symbols that are counted.
SYMBOL_PATTERN = "[#*$%&|<>]"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class HostRules:
    """``min_words`` and ``max_repeat_pct`` are the document rules. ``max_symbol_pct`` (symbols per
    word character) and ``max_dup_line_pct`` (repeated lines per line with a word) only count
    towards a host. A host is rejected when the shrunken rate of any rule exceeds ``host_limit`` and has more
    than ``host_odds`` times the odds of the corpus. ``least_strength``: documents that the prior is worth at least."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_symbol_pct: int = 10
    max_dup_line_pct: int = 30
    host_limit: float = 0.5
    host_odds: float = 20.0
    least_strength: float = 2.0


RULES = ("few_words", "repeats", "symbols", "dup_lines")


def _covered(positions: Column) -> Column:
    """Words under three-word windows that start at the given ascending positions."""
    spans = F.transform(positions, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(positions, i + 1) - p, F.lit(3))))
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, span: total + span)


def with_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``MEASURES`` and ``n_lines`` (lines with a word); columns of these names are replaced.

    A NULL or empty text has no words and no lines. Windows of three words are told apart by a
    64-bit hash within their document."""
    words, lines, windows, ranked, starts = fresh(df, "_words", "_lines", "_windows", "_ranked", "_starts")
    whole = F.coalesce(F.col(text), F.lit(""))
    w = F.col(words)
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    r = F.col(ranked)
    repeated = F.filter(
        r,
        lambda x, i: F.coalesce(x["h"] == F.get(r, i - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(r, i + 1)["h"], F.lit(False)),
    )
    has_word = lambda line: line.rlike(WORD_CHAR)
    return (
        df.withColumns({words: words_of(F.col(text)), lines: F.filter(F.split(whole, "\n"), has_word)})
        .withColumns(
            {
                windows: F.when(F.size(w) >= 3, hashed),
                "n_words": F.size(w).cast("long"),
                "word_chars": F.length(F.array_join(w, "")).cast("long"),
                "n_symbols": F.regexp_count(whole, F.lit(SYMBOL_PATTERN)).cast("long"),
                "n_lines": F.size(lines).cast("long"),
                "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            }
        )
        .drop(words, lines)
        .withColumn(
            ranked,
            F.when(
                F.size(F.array_distinct(windows)) < F.size(windows),
                F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ),
        )
        .drop(windows)
        .withColumn(starts, F.sort_array(F.transform(repeated, lambda x: x["i"])))
        .drop(ranked)
        .withColumn("n_repeat_words", F.coalesce(_covered(F.col(starts)), F.lit(0).cast("long")))
        .drop(starts)
    )


def failures(rules: HostRules) -> dict[str, Column]:
    """One condition per rule over the measures."""
    return {
        "few_words": F.col("n_words") < rules.min_words,
        "repeats": 100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > rules.max_symbol_pct * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > rules.max_dup_line_pct * F.col("n_lines"),
    }


def host_verdicts(measured: DataFrame, host: str, rules: HostRules = HostRules()) -> DataFrame:
    """Per host: ``n_docs``, the shrunken failure rate of each rule (``rate_<rule>``) and ``host_kept``.

    Hosts are folded to one row each before anything else. The beta prior of a rule has the mean of the corpus
    and the strength that beta-binomial moments give: how far the hosts' rates spread beyond what documents
    drawn at the mean rate would. Hosts that spread no further, or all have one document, get the mean; no
    host's own documents outweigh the prior with fewer than ``least_strength``. Rows without a host take no
    part. Only the sums of each rule reach the driver."""
    counted = written(
        measured.filter(F.col(host).isNotNull())
        .groupBy(host)
        .agg(F.count("*").alias("n_docs"), *[F.count_if(c).alias(f"f_{r}") for r, c in failures(rules).items()]),
        "hosts",
    )
    sums = counted.agg(
        F.count("*").alias("hosts"),
        F.sum("n_docs").alias("n"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("squares"),
        *[F.sum(f"f_{r}").alias(f"m_{r}") for r in RULES],
        *[F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("n_docs")).alias(f"q_{r}") for r in RULES],
    ).first()
    n, within = sums["n"] or 0, max(sums["hosts"] - 1, 0)
    rates, over = {}, F.lit(False)
    for r in RULES:
        mean = sums[f"m_{r}"] / n if n else 0.0
        spread, room = mean * (1 - mean), n - sums["squares"] / n - within if n else 0.0
        between = ((sums[f"q_{r}"] - n * mean * mean) / spread - within) / room if spread > 0 and room > 0 else 0.0
        strength = max(1 / between - 1, rules.least_strength) if between > 1e-9 else None
        rate = (
            F.lit(mean)
            if strength is None
            else (F.col(f"f_{r}") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
        )
        rates[f"rate_{r}"] = rate
        odds = rules.host_odds * mean
        over = over | (rate > max(rules.host_limit, odds / (1 - mean + odds)))
    judged = counted.select(host, "n_docs", *[c.alias(n) for n, c in rates.items()], (~over).alias("host_kept"))
    return judged


def judge(df: DataFrame, text: str = "text", host: str = "source", rules: HostRules = HostRules(), carry=None) -> DataFrame:
    """``carry`` columns (all but the text when None) with the measures, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_pct`` percent of
    the words in repeated three-word windows. ``kept``: not failed, and the host not rejected.
    A row without a host is judged by itself; repeated rows are judged alike, an empty table
    gives no rows, and columns that bear the names of results are replaced. The measures are
    written once; only rejected hosts are joined back, broadcast by Spark when their file is small.
    """
    carry = [c for c in df.columns if c != text] if carry is None else carry
    results = {*MEASURES, "n_lines", "base_failed", "kept", "host_kept"}
    carry = [c for c in carry if c not in results]
    if host in carry or host in results:
        key = host
    else:
        key = fresh(df, "_host")[0]
        df = df.withColumn(key, F.col(host))
    few, repeats = (failures(rules)[r] for r in ("few_words", "repeats"))
    measured = with_measures(df, text).withColumn("base_failed", few | repeats)
    measured = written(
        measured.select(*dict.fromkeys([*carry, key, *MEASURES, "n_lines", "base_failed"])), "measures"
    )
    rejected = written(
        host_verdicts(measured, key, rules).filter(~F.col("host_kept")).select(key, F.lit(False).alias("host_kept")),
        "rejected",
    )
    return (
        measured.join(rejected, key, "left")
        .withColumn("kept", ~F.col("base_failed") & F.coalesce("host_kept", F.lit(True)))
        .select(*carry, *MEASURES, "base_failed", "kept")
    )


def keep_good(df: DataFrame, text: str = "text", host: str = "source", rules: HostRules = HostRules()) -> DataFrame:
    """The rows that ``judge`` keeps, with all their columns as they were.

    The table is written once with its measures; so no row is measured twice, nothing is joined
    by identifier, and repeated or NULL identifiers do no harm."""
    columns = df.columns
    names = {c: f"c{i}_" for i, c in enumerate(columns)}
    plain = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    kept = judge(plain, names[text], names[host], rules, carry=list(names.values()))
    return kept.filter("kept").select(*[F.col(n).alias(c) for c, n in names.items()])
