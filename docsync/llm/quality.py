"""Quality rules of documents and of their hosts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import GAP, SPACES, packed, stage, unpacked

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: The rules beside the base ones, with the limits that Rae et al. (2021, "Gopher") publish: symbols
#: for each 100 words, and lines that repeat an earlier one for each 100 lines.
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
#: A host whose shrunken share of failing documents is above this is rejected as a whole: by the
#: base rules alone (as in the SQL of op8), and by all rules. A document of a host that fails more
#: often than not is more likely bad than good, whatever rules it passed.
MAX_HOST_RATE = 0.75
MAX_HOST_RATE_ALL = 0.5
SYMBOLS = "#*$%&|<>"


def _repeat_words(ordered: Column) -> Column:
    """Words covered by windows that occur twice or more; ``ordered``: sorted (hash, place)."""
    pairs = F.zip_with(
        ordered, F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0))),
        lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)))
    at = F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    empty = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(
        at, empty,
        lambda a, i: F.struct((a.n + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a.n)


def measured(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the base measures of ``text`` in columns that start with ``_q_``.

    The windows of three words are compared by 64-bit hash, inside one document only; texts
    without a repeated window (most) never reach the sort.
    """
    clean = F.coalesce(text, F.lit(""))
    df = df.withColumn("_q_text", clean)
    df = df.withColumn("_q_words", F.split(F.trim(F.regexp_replace("_q_text", GAP, " ")), " "))
    blank = F.translate("_q_text", SPACES, "")
    lines = F.filter(F.split("_q_text", "\n"), lambda s: F.translate(s, SPACES, "") != "")
    df = df.withColumns({
        "_q_chars": F.length(blank).cast("long"),
        "_q_n": F.when(F.length(blank) > 0, F.size("_q_words")).otherwise(0).cast("long"),
        "_q_symbols": (F.length("_q_text")
                       - F.length(F.translate("_q_text", SYMBOLS, ""))).cast("long"),
        "_q_lines": lines})
    # The three references to the words keep Spark from repeating the split for every window.
    hashes = F.transform(F.sequence(F.lit(0), F.col("_q_n").cast("int") - 3), lambda i: F.xxhash64(
        F.get("_q_words", i), F.get("_q_words", i + 1), F.get("_q_words", i + 2)))
    df = df.withColumns({
        "_q_windows": F.when(F.col("_q_n") >= 3, hashes).otherwise(
            F.array().cast("array<bigint>")),
        "_q_dup_lines": (F.size("_q_lines")
                         - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "_q_all_lines": F.size("_q_lines").cast("long")})
    distinct = F.size(F.array_distinct("_q_windows"))
    df = df.withColumn("_q_sorted", F.when(
        distinct < F.size("_q_windows"), F.array_sort(F.transform(
            "_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("_q_repeat", F.coalesce(
        _repeat_words(F.col("_q_sorted")), F.lit(0)).cast("long"))
    failed = (F.col("_q_n") < MIN_WORDS) | (
        100 * F.col("_q_repeat") > MAX_REPEAT_PERCENT * F.col("_q_n"))
    more = (100 * F.col("_q_symbols") > MAX_SYMBOL_PERCENT * F.col("_q_n")) | (
        100 * F.col("_q_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("_q_all_lines"))
    return (df.withColumns({"_q_failed": failed, "_q_rejected": failed | more})
            .drop("_q_text", "_q_words", "_q_lines", "_q_all_lines", "_q_windows", "_q_sorted"))


def host_rates(failures: DataFrame, host: str, failed: str) -> DataFrame:
    """Per host: documents, failures and the failure rate shrunk by an empirical beta prior.

    The prior's mean and strength come from the hosts' own rates by moments: mean m and
    variance v of the rates (each host once) give a + b = m (1 - m) / v - 1, at least 1. With one
    host, or without variance, a + b is the mean host size. The posterior rate of a host is
    (failures + a) / (documents + a + b). Rows without a host belong to none.
    """
    per_host = stage(
        failures.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
        .agg(F.count("*").alias("documents"), F.sum(F.col(failed).cast("long")).alias("failures")),
        "hosts")
    rate = F.col("failures") / F.col("documents")
    prior = per_host.agg(F.avg(rate).alias("m"), F.coalesce(F.var_samp(rate), F.lit(0.0)).alias("v"),
                         F.avg("documents").alias("size")).first()  # one row of three numbers
    if prior.m is None:
        return per_host.withColumn("rate", F.lit(0.0))
    strength = max(1.0, prior.m * (1 - prior.m) / prior.v - 1) if prior.v > 1e-12 else prior.size
    posterior = ((F.col("failures") + prior.m * strength) / (F.col("documents") + strength))
    return per_host.withColumn("rate", posterior)


def judged(docs: DataFrame, carry: list[str] | None = None, base_only: bool = False) -> DataFrame:
    """Struct ``row`` of every input row (its columns ``carry``, default all), its measures,
    ``base_failed`` and ``kept``.

    A document is kept if it passes all rules and its host (``source``) is not rejected; with
    ``base_only`` the rules of symbols and repeated lines count neither for it nor for its host. A
    null text has no words and fails; a null host is never rejected. Rows are judged one by one,
    so repeated rows and repeated ids get a verdict each; ties cannot arise. An empty table gives
    no rows. Columns of any other name, also those of this module's measures, are only carried.
    """
    slim = docs if carry is None else docs.select(*carry)
    rows = docs.select(packed(slim).alias("row"), docs["text"].alias("_text"),
                       docs["source"].cast("string").alias("_host"))
    # One pass over the texts; the host rates and the verdicts both read what it wrote.
    rows = stage(measured(rows, F.col("_text")).drop("_text"), "quality")
    # Written, because its size then decides between broadcast and shuffle in the last join.
    failed, max_rate = (("_q_failed", MAX_HOST_RATE) if base_only
                        else ("_q_rejected", MAX_HOST_RATE_ALL))
    bad = stage(host_rates(rows, "_host", failed).filter(F.col("rate") > max_rate)
                .select("host", F.lit(True).alias("host_failed")), "hosts")
    out = rows.join(bad, rows["_host"] == bad["host"], "left")
    return out.select(
        "row", F.col("_q_n").alias("n_words"), F.col("_q_chars").alias("word_chars"),
        F.col("_q_symbols").alias("n_symbols"), F.col("_q_dup_lines").alias("n_dup_lines"),
        F.col("_q_repeat").alias("n_repeat_words"), F.col("_q_failed").alias("base_failed"),
        (~F.col(failed) & F.col("host_failed").isNull()).alias("kept"))


def quality(docs: DataFrame) -> DataFrame:
    """Measures and the base rules' verdict per document, with its ``doc_id``, as in the SQL of op8."""
    out = judged(docs, ["doc_id"], base_only=True)
    return unpacked(out, "row", ["doc_id"], *[c for c in out.columns if c != "row"])


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that all rules keep, with their own columns."""
    return unpacked(judged(docs).filter("kept"), "row", docs.columns)
