"""Quality rules of documents and of their hosts, as DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftmill.lineage import cut, fits, salted_join
from weftmill.llm.texts import BLANKS

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Rules that count against the host only: symbols per 100 words, repeated lines per 100 words, and
# characters per word.
MAX_SYMBOL_PERCENT = 50
MAX_LINE_PERCENT = 10
MIN_WORD_CHARS, MAX_WORD_CHARS = 2, 20
# A host is dropped whole if its shrunk share of failing documents lies above the prior's mean by so many of
# the prior's standard deviations (2: the upper 2.3 % of hosts like these). Hosts below MIN_HOST_RATE are
# never dropped, however alike the others are; hosts above MAX_HOST_RATE always are, however few others there are.
HOST_DEVIATIONS = 2.0
MIN_HOST_RATE, MAX_HOST_RATE = 0.3, 0.8
# A prior is at least and at most worth so many documents.
MIN_PRIOR, MAX_PRIOR = 1.0, 1e6


def _let(value: Column, use) -> Column:
    """`use(value)` with `value` computed once."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column, n: Column) -> Column:
    """Words in windows of `WINDOW` words that occur twice or more, the first occurrence included.

    Windows are compared by 64-bit hash. Only texts in which a hash repeats are sorted.
    """
    hashes = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(rows: Column) -> Column:
            same = lambda j, k: F.get(rows, j)["h"] == F.get(rows, k)["h"]
            twice = F.filter(
                F.sequence(F.lit(0), F.size(rows) - 1),
                lambda j: F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)),
            )
            return F.array_sort(F.transform(twice, lambda j: F.get(rows, j)["i"]))

        return F.aggregate(
            _let(ordered, repeats),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
            lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")),
            lambda s: s["n"],
        )

    return _let(
        hashes,
        lambda h: F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0).cast("long")).otherwise(covered(h)),
    )


def document_rules(docs: DataFrame, text_col: str = "text", *carry: Column) -> DataFrame:
    """`carry` columns with the counts of each text and `base_failed` and `failed`.

    Null and empty texts have no word, line or symbol and fail. `failed` also holds the rules that
    only count against the host.
    """
    rows = docs.select(F.coalesce(docs[text_col], F.lit("")).alias("t"), *carry)
    names = rows.columns[1:]
    # \z and not $, which also matches before some characters that end a line.
    trimmed = F.regexp_replace("t", f"^{BLANKS}|{BLANKS}\\z", "")
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))
    rows = rows.select("t", *names, words.alias("w"))
    lines = F.filter(F.split("t", "\n"), lambda line: F.regexp_like(line, F.lit("[^\\x20\\x09-\\x0D]")))
    rows = rows.select(
        *names,
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", BLANKS, "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w"), F.size("w")).alias("n_repeat_words"),
    )
    n = F.col("n_words")
    base = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    soft = (
        (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * n)
        | (100 * F.col("n_dup_lines") > MAX_LINE_PERCENT * n)
        | (F.col("word_chars") < MIN_WORD_CHARS * n)
        | (F.col("word_chars") > MAX_WORD_CHARS * n)
    )
    return rows.withColumn("base_failed", base).withColumn("failed", base | soft)


def host_rates(rows: DataFrame) -> DataFrame:
    """`(host, n_docs, n_failed, host_rate, bar)`: share of failing documents, shrunk by a beta prior, and
    the rate above which a host is dropped.

    The prior's mean and weight are fitted to the rates of all hosts by moments: the variance between
    hosts is what remains of the rates' variance beyond that of drawing n documents. Counts are combined
    before the shuffle, so a host with a third of all rows is no large group.
    """
    counts = rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")
    )
    counts = cut(counts)
    rate = F.col("n_failed") / F.col("n_docs")
    over = counts.agg(
        (F.sum("n_failed") / F.sum("n_docs")).alias("mean"),
        F.var_pop(rate).alias("variance"),
        F.avg(F.lit(1.0) / F.col("n_docs")).alias("per_doc"),
    ).first()
    mean, weight = over["mean"] or 0.0, MAX_PRIOR
    between = (over["variance"] or 0.0) - mean * (1 - mean) * (over["per_doc"] or 0.0)
    if between > 0:
        weight = min(max(mean * (1 - mean) / between - 1, MIN_PRIOR), MAX_PRIOR)
    shrunk = (F.col("n_failed") + F.lit(weight * mean)) / (F.col("n_docs") + F.lit(weight))
    spread = (mean * (1 - mean) / (weight + 1)) ** 0.5
    bar = min(max(mean + HOST_DEVIATIONS * spread, MIN_HOST_RATE), MAX_HOST_RATE)
    return counts.withColumn("host_rate", shrunk).withColumn("bar", F.lit(bar))


def judge(docs: DataFrame, host: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(doc_id, counts, base_failed, failed, host_rate, bar, kept)`, one row per row of `docs`.

    `kept` is false if a base rule fails or the host's shrunk rate of failing documents is above the bar
    that the prior sets (see `HOST_DEVIATIONS`). A null host is a host of its own. Repeated rows count each. Extra columns aren't
    read; no rows give no rows.
    """
    key = F.concat(F.when(host.isNull(), "0").otherwise("1"), F.coalesce(host, F.lit("")))
    rows = cut(document_rules(docs, text_col, docs[id_col].alias("doc_id"), key.alias("host")))
    hosts = cut(host_rates(rows).select("host", "host_rate", "bar"))
    if fits(hosts, F.octet_length("host")):
        joined = rows.join(F.broadcast(hosts), "host")
    else:
        joined = salted_join(rows, hosts, "host", ["doc_id"])
    kept = ~F.col("base_failed") & (F.col("host_rate") <= F.col("bar"))
    return joined.withColumn("kept", kept).drop("host")
