"""Quality rules with host-level verdicts (op4), in DataFrame functions alone.

Each text gets its counts and fails or passes each rule. Failures are added up by host.
A host's rate per rule is shrunk towards that of all hosts with a beta prior whose mean and
strength are taken from the hosts themselves (moments); a host whose shrunk rate of any
rule is above ``REJECT`` is rejected, and the verdict is joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tunesmith.llm.common import BLANKS, lookup_join, quoted
from tunesmith.sources.scratch import stored

WINDOW, LEAST_WORDS, REPEATED_PERCENT = 5, 10, 20
# Limits of the rules that count for hosts only: symbols per 100 words, repeated lines per 100 lines.
SYMBOL_PERCENT, LINE_PERCENT = 30, 30
#: Characters counted as symbols: a fixed value.
SYMBOLS = "#*$%&|<>"
# A host is rejected above this shrunk rate; bounds of the prior's strength in documents.
REJECT, WEAKEST, STRONGEST = 0.5, 1.0, 1000.0
RULES = ("base", "symbols", "lines")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, BLANKS[1:], " " * (len(BLANKS) - 1)), " "), "")


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (long), base_failed.

    Words are runs of anything but blank, tab, line and page ends; a null text has none.
    Windows are compared by a 64-bit hash of their words' hashes.
    """
    whole = F.coalesce(quoted(text), F.lit(""))
    taken = [quoted(c) for c in df.columns]
    step = df.select(*taken, whole.alias("__t")).withColumn("__w", F.transform(_words(F.col("__t")), lambda w: F.xxhash64(w)))
    lines = F.filter(F.split("__t", "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    step = step.withColumn("__lines", lines).withColumn("__n", F.size("__w"))
    hashed = F.transform(F.sequence(F.lit(0), F.col("__n") - WINDOW), lambda i: F.xxhash64(*[F.get("__w", i + k) for k in range(WINDOW)]))
    step = step.withColumn("__h", F.when(F.col("__n") >= WINDOW, hashed))
    # Windows in the order of their hashes, made only where some hash is there twice.
    ordered = F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), ordered))
    twice = F.filter("__s", lambda x, k: F.coalesce(F.get("__s", k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("__s", k + 1)["h"] == x["h"], F.lit(False)))
    step = step.withColumn("__p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("__p", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("__p", k + 1), p + WINDOW) - p)),
        F.lit(0),
        lambda total, x: total + x,
    )
    counts = {
        "n_words": F.col("__n"),
        "word_chars": F.length(F.translate("__t", BLANKS, "")),
        "n_symbols": F.length("__t") - F.length(F.translate("__t", SYMBOLS, "")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("__lines"),
    }
    found = step.select(*taken, *[c.cast("long").alias(name) for name, c in counts.items()])
    return found.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")))


def host_of(source: Column) -> Column:
    """The host of a URL in small letters; other text is a host's name itself."""
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit("")), source)


def host_verdicts(flags: DataFrame, host: str = "host") -> DataFrame:
    """Per host: ``n`` documents and ``host_failed``; ``flags`` has a boolean per rule in ``f_<rule>``.

    Documents without a host (null) give no row. The prior of a rule has the mean m of all
    documents and the strength m(1-m)/v - 1, v being the hosts' variance weighted by their
    documents, within [WEAKEST, STRONGEST].
    """
    sums = [F.sum(F.col(f"f_{r}").cast("long")).alias(f"x_{r}") for r in RULES]
    hosts = stored(flags.where(F.col(host).isNotNull()).groupBy(host).agg(F.count("*").alias("n"), *sums), "hosts")
    totals = hosts.agg(F.sum("n").alias("n"), *[F.sum(f"x_{r}").alias(f"x_{r}") for r in RULES]).first()
    if not totals["n"]:
        return hosts.select(host, "n", F.lit(False).alias("host_failed"))
    mean = {r: totals[f"x_{r}"] / totals["n"] for r in RULES}
    spread = hosts.agg(*[(F.sum(F.col("n") * F.pow(F.col(f"x_{r}") / F.col("n") - mean[r], 2)) / totals["n"]).alias(r) for r in RULES]).first()
    failed = F.lit(False)
    for r in RULES:
        m, v = mean[r], spread[r]
        strength = min(max(m * (1 - m) / v - 1, WEAKEST), STRONGEST) if v > 0 else STRONGEST
        failed = failed | ((F.col(f"x_{r}") + m * strength) / (F.col("n") + strength) > REJECT)
    return hosts.select(host, "n", failed.alias("host_failed"))


def _flags(counts: DataFrame) -> list[Column]:
    return [
        F.col("base_failed").alias("f_base"),
        (100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("n_words")).alias("f_symbols"),
        (100 * F.col("n_dup_lines") > LINE_PERCENT * F.col("n_lines")).alias("f_lines"),
    ]


def quality(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """Per row: key, the counts of ``with_counts``, base_failed, and ``kept``.

    ``kept`` is false if the base rules fail or the row's host is rejected; a row without a
    source has no host and goes by the base rules. Rows that repeat count each; null keys
    stay; an empty table gives no row.
    """
    narrow = df.select(quoted(key).alias(key), host_of(quoted(source)).alias("host"), quoted(text).alias("__text"))
    counts = with_counts(narrow, "__text").drop("__text")
    counts = stored(counts.select("*", *_flags(counts)), "quality")
    known = lookup_join(counts, host_verdicts(counts), "host", "n")
    return known.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))).alias("kept"))


def kept_rows(df: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``df`` that ``quality`` keeps, with their columns.

    Texts are counted twice instead of being shuffled: once for the hosts, once to filter.
    The rejected hosts are broadcast while they are under a thousand, else their join is
    that of ``lookup_join``.
    """
    narrow = df.select(host_of(quoted(source)).alias("host"), quoted(text).alias("__text"))
    counts = with_counts(narrow, "__text").drop("__text")
    verdicts = stored(host_verdicts(counts.select("host", *_flags(counts))), "verdicts")
    names = list(df.columns)
    plain = df.toDF(*[f"c{k}" for k in range(len(names))])
    text, source = f"c{names.index(text)}", f"c{names.index(source)}"
    # Spark moves a filter below the steps of the counts, and so repeats those at every use of
    # a column; it moves none past a column that is not a function of the row.
    counted = with_counts(plain, text).withColumn("__row", F.monotonically_increasing_id())
    passed = counted.where(~F.col("base_failed") & (F.col("__row") >= 0)).select(*plain.columns, host_of(F.col(source)).alias("__host"))
    bad = verdicts.where("host_failed")
    if bad.limit(1001).count() <= 1000:
        bad = F.broadcast(bad.select(F.col("host").alias("__bad")))
        kept = passed.join(bad, F.col("__host") == F.col("__bad"), "left_anti")
    else:
        verdicts = verdicts.withColumnRenamed("host", "__host")
        kept = lookup_join(passed, verdicts, "__host", "n").where(~F.coalesce("host_failed", F.lit(False)))
    return kept.select(*plain.columns).toDF(*names)
