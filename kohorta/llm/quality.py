"""Quality rules per document and per host."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession, functions as F

from kohorta.llm.common import durable, map_rows, query, read_table

SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A host is rejected when its shrunk failure rate is above this.
HOST_RATE = 0.5
SALTS = 32


def measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    data = text.encode("utf-8")
    words = data.split()  # on exactly the six ASCII spaces
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = Counter(line for line in data.split(b"\n") if not line.isspace() and line)
    repeated = sum(lines.values()) - len(lines)
    windows = list(zip(words, words[1:], words[2:]))
    covered = 0
    if len(set(windows)) < len(windows):
        times, end = Counter(windows), 0
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered += i + 3 - max(i, end)
                end = i + 3
    return len(words), chars, symbols, repeated, covered


def document_rules(docs: DataFrame, host: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Measures and rule failures of every document, with its host."""

    def rows(keys, hosts, texts):
        for k, h, t in zip(keys, hosts, texts):
            n, chars, symbols, lines, covered = measures(t or "")
            failed = n < MIN_WORDS or 100 * covered > MAX_REPEAT_PERCENT * n
            yield k, h, n, chars, symbols, lines, covered, failed

    schema = (
        "doc_id bigint, host string, n_words bigint, word_chars bigint, n_symbols bigint, "
        "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean"
    )
    return map_rows(docs.select(F.col(key), F.col(host).cast("string").alias("host"), F.col(text)), [key, "host", text], rows, schema)


def host_rates(rules: DataFrame) -> DataFrame:
    """host, n_docs, n_failed, rate, shrunk_rate.

    The prior is a beta distribution fitted to all hosts by the method of
    moments: its mean is the share of failing documents, its weight follows from
    how much the rates of the hosts differ beyond chance. Where they differ no
    more than chance, all hosts get the mean.
    """
    hosts = rules.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")
    )
    hosts = durable(hosts)
    # One row of sums: weighted mean, between-host variance of the rates.
    total = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n_docs").alias("docs"),
        F.sum("n_failed").alias("failed"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("squares"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("sizes"),
    ).first()
    mean, weight = beta_prior(total["hosts"], total["docs"], total["failed"], total["squares"], total["sizes"])
    rate = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.select(
        "host", "n_docs", "n_failed", (F.col("n_failed") / F.col("n_docs")).alias("rate"), rate.alias("shrunk_rate")
    )


# The prior of equal hosts counts as this many documents.
MOST_WEIGHT = 1e6


def beta_prior(hosts, docs, failed, squares, sizes) -> tuple[float, float]:
    """Mean and weight (a + b) of the beta prior, by moments of the host rates.

    ``squares`` is the sum of failed^2 / docs and ``sizes`` the sum of docs^2
    over hosts. With one host, or none failing, the prior is its mean.
    """
    if not docs:
        return 0.0, 1.0
    mean = failed / docs
    within = mean * (1 - mean)
    effective = docs - sizes / docs
    if hosts < 2 or within == 0 or effective <= 0:
        return mean, 1.0
    between = (squares - docs * mean * mean - (hosts - 1) * within) / effective
    if between <= within / MOST_WEIGHT:
        return mean, MOST_WEIGHT
    return mean, max(within / between - 1, 1e-3)


def quality_verdicts(
    docs: DataFrame, host: str = "source", text: str = "text", key: str = "doc_id", most: float = HOST_RATE
) -> DataFrame:
    """Document measures with the verdict of the host joined back.

    ``kept`` is false for a document that fails by itself and for all documents
    of a host whose shrunk rate is above ``most``. A document without a host is
    judged alone. A missing text is empty and fails. Rows of one host are spread
    over salts, as one host may hold a third of all documents.
    """
    rules = durable(document_rules(docs, host, text, key))
    hosts = host_rates(rules).select(
        F.col("host").alias("of_host"),
        "shrunk_rate",
        (F.col("shrunk_rate") > most).alias("host_rejected"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"),
    )
    rows = rules.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    joined = rows.join(hosts, (rows.host == hosts.of_host) & (rows.salt == hosts.of_salt), "left")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~rejected).alias("kept"),
        "host", "shrunk_rate",
    )


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(read_table(spark, sf_dir, "documents"))
