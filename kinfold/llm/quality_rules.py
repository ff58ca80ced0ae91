"""Host-level quality rules: failures by host, shrunk with an empirical beta prior, decide on whole hosts.

Each document gets simple counts. Per rule, a host's failures and documents give a rate; the rates of all hosts give a beta prior (by
moments), and a host's rate is replaced by its posterior mean, so that a host with two pages is judged by what hosts are like and a host with
a million by its own pages. A document is kept when it passes the base rule itself and its host fails no rule.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.llm.common import batches
from kinfold.session import materialize

SPACES = b" \t\n\r\x0b\x0c"  # fixed values: what separates words
SYMBOLS = "#*$%&|<>"  # fixed values
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# The soft rules by name: when a document fails. Thresholds are parameters of this operator.
RULES = {
    "base": "base_failed",
    "symbols": "n_words > 0 and 10 * n_symbols > n_words",
    "dup_lines": "n_lines > 0 and 10 * n_dup_lines > 3 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 3 * n_words or word_chars > 10 * n_words)",
}
MAX_HOST_RATE = 0.5  # a host whose posterior failure rate is above this fails the rule


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in a window of ``window`` words that occurs twice or more."""
    if len(words) <= window:
        return 0
    windows = list(zip(*(words[i:] for i in range(window))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, until = 0, 0
    for start, key in enumerate(windows):
        if counts[key] > 1:
            covered += start + window - max(start, until)
            until = start + window
    return covered


def counts_of(text: str | None) -> tuple[int, int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of one text; null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, SPACES))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    symbols = sum(text.count(c) for c in SYMBOLS)
    return len(words), len(text) - spaces, symbols, len(lines), len(lines) - len(set(lines)), repeated_words(words)


def document_counts(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed)."""
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

    def step(id, host, text):
        rows = [counts_of(t) for t in text]
        return {"id": id, "host": host} | {n: [r[i] for r in rows] for i, n in enumerate(names)}

    kinds = {c: docs.schema[c].dataType.simpleString() for c in (id_col, host_col)}
    out = batches(
        docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(text_col).alias("text")),
        step,
        f"id {kinds[id_col]}, host {kinds[host_col]}, " + ", ".join(f"{n} bigint" for n in names),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumnRenamed("id", "doc_id").withColumn("base_failed", failed)


def beta_prior(hosts: DataFrame, failures: str) -> tuple[Column, Column]:
    """Aggregates for the prior's a and b from one row per host with ``n`` documents, by moments of the host rates.

    Two pseudo-hosts, one that failed and one that did not, keep the moments inside (0, 1); a variance that no beta can have gives the
    flat strength of two documents.
    """
    rate = F.col(failures) / F.col("n")
    n = F.count(F.lit(1)) + 2
    mean = (F.sum(rate) + 1) / n
    variance = (F.sum(rate * rate) + 1) / n - mean * mean
    strength = F.greatest(mean * (1 - mean) / F.greatest(variance, F.lit(1e-9)) - 1, F.lit(2.0))
    return (mean * strength), ((1 - mean) * strength)


def host_verdicts(counted: DataFrame, rules: dict[str, str] = RULES, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, host_docs, rate_<rule>..., host_failed): one row per host, null being one host of its own."""
    failures = [F.sum(F.expr(rule).cast("bigint")).alias(f"f_{name}") for name, rule in rules.items()]
    hosts = materialize(counted.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *failures), "hosts")
    columns = []
    for name in rules:
        a, b = beta_prior(hosts, f"f_{name}")
        columns += [a.alias(f"a_{name}"), b.alias(f"b_{name}")]
    prior = hosts.agg(*columns)  # one row
    rates = {
        f"rate_{name}": (F.col(f"f_{name}") + F.col(f"a_{name}")) / (F.col("n") + F.col(f"a_{name}") + F.col(f"b_{name}"))
        for name in rules
    }
    judged = hosts.join(F.broadcast(prior)).withColumns(rates)
    worst = F.greatest(*rates) if len(rates) > 1 else F.col(next(iter(rates)))
    return judged.select("host", F.col("n").alias("host_docs"), *rates, (worst > max_rate).alias("host_failed"))


def apply_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """One row per document with its counts, its host's rates and ``kept``.

    Null and empty texts have no words, fail the base rule and count as failures of their host. A null host is a host like any other. Repeated rows
    each count and each get a row. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    counted = materialize(document_counts(docs, id_col, text_col, host_col), "counts")
    verdicts = host_verdicts(counted, max_rate=max_rate).withColumnRenamed("host", "of")
    joined = counted.join(verdicts, F.col("host").eqNullSafe(F.col("of"))).drop("of")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
