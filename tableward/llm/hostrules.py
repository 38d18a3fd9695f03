"""Quality rules whose strictness follows the host a document comes from.

Every document is counted by itself (``counts``) and judged by fixed rules (``failures``).
Failures are then summed per host.  The rate of a host with few documents says little, so
each rate is shrunk towards the corpus by a beta prior fitted to the hosts' rates by their
mean and variance (``prior``).  The shrunk rate makes the host's verdict:

* ``blocked`` (over ``BLOCKED``): most of what it holds fails; all its documents go,
* ``watched`` (over ``WATCHED`` times the corpus mean): one soft failure is enough to go,
* ``trusted``: a document goes when two soft rules fail, one of them grossly, or a hard one.

All of it is DataFrame expressions.  NULL or empty text has no words and fails the hard
rule; NULL is a host like any other.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableward.llm.common import BLANKS, free_name, join_facts, let, words_of
from tableward.session import stage

#: Hard rule: fewer words than this, or more than this share of them in repeated windows.
LEAST_WORDS, REPEATED_PERCENT = 50, 50
#: Soft rules: symbols per word and share of repeated lines (the second figure is a gross failure), characters per word.
SYMBOLS, SYMBOLS_PER_WORD, LINES_REPEATED, WORD_LENGTH = "#*$%&|<>", (0.1, 0.3), (0.3, 0.9), (2, 15)
#: Host verdicts, by the shrunk rate of failing documents.
BLOCKED, WATCHED = 0.5, 1.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are sorted by hash beside their position; equal neighbours are compared word by word.
    """

    def same(windows: Column, i: Column, j: Column) -> Column:
        a, b = F.get(windows, i), F.get(windows, j)
        equal = a["h"] == b["h"]
        for k in range(3):
            equal = equal & (F.get(words, a["p"] + k) == F.get(words, b["p"] + k))
        return F.coalesce(equal, F.lit(False))

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    def sorted_windows(hashes: Column) -> Column:
        return F.sort_array(F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))

    def starts(windows: Column) -> Column:
        found = F.transform(
            windows, lambda w, i: F.when(same(windows, i, i - 1) | same(windows, i, i + 1), w["p"])
        )
        return F.sort_array(F.filter(found, lambda p: p.isNotNull()))

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )
    counted = let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(sorted_windows(h), lambda w: let(starts(w), covered))
        ),
    )
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(counted)


def counts(text: Column) -> Column:
    """A struct of the counts of one text, and ``n_lines``, its lines that hold a word."""

    def lines(t: Column) -> Column:
        return F.filter(F.split(t, "\n"), lambda line: without(line, BLANKS) != "")

    text = F.coalesce(text, F.lit(""))
    return let(
        words_of(text),
        lambda words: let(
            lines(text),
            lambda rows: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(without(text, BLANKS)).cast("long").alias("word_chars"),
                (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
                (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"),
                repeated_words(words).cast("long").alias("n_repeat_words"),
                F.size(rows).cast("long").alias("n_lines"),
            ),
        ),
    )


def scored(text: Column) -> Column:
    """The counts with ``base_failed`` and ``n_soft``, the number of soft rules that fail, gross failures twice."""

    def judged(c: Column) -> Column:
        low, high = WORD_LENGTH
        soft = (
            *(c["n_symbols"] > most * c["n_words"] for most in SYMBOLS_PER_WORD),
            *(c["n_dup_lines"] > most * c["n_lines"] for most in LINES_REPEATED),
            (c["word_chars"] < low * c["n_words"]) | (c["word_chars"] > high * c["n_words"]),
        )
        return F.struct(
            *[c[n].alias(n) for n in COUNTS],
            ((c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > REPEATED_PERCENT * c["n_words"])).alias("base_failed"),
            sum((s.cast("int") for s in soft), F.lit(0)).alias("n_soft"),
        )

    return let(counts(text), judged)


@dataclass(frozen=True)
class Prior:
    """A beta distribution of failure rates."""

    alpha: float
    beta: float

    @property
    def mean(self) -> float:
        return self.alpha / (self.alpha + self.beta)


def prior(hosts: DataFrame) -> Prior:
    """The beta distribution with the mean and variance of the hosts' rates.

    Hosts count by their documents; what sampling alone adds to the variance is taken off.
    One row of four sums reaches the driver.  Without hosts, or with rates that do not
    differ, the prior is worth a million documents at most and one at least.
    """
    rate = F.col("failed") / F.col("docs")
    got = hosts.agg(
        F.sum("docs").cast("double").alias("docs"), F.sum("failed").cast("double").alias("failed"), F.count("*").alias("hosts"),
        F.sum(F.col("docs") * rate * rate).alias("squares"),
    ).first()
    if not got["docs"]:
        return Prior(1.0, 1.0)
    n, mean = got["docs"], got["failed"] / got["docs"]
    spread = mean * (1 - mean)
    between = got["squares"] / n - mean * mean - spread * got["hosts"] / n
    worth = min(max(spread / between - 1, 1.0), 1e6) if between > 0 else 1e6
    mean = min(max(mean, 1e-9), 1 - 1e-9)
    return Prior(mean * worth, (1 - mean) * worth)


def verdicts(judged: DataFrame) -> DataFrame:
    """One row per ``host`` of a table of ``host, base_failed, n_soft``: its shrunk failure rate and its verdict."""
    failed = F.col("base_failed") | (F.col("n_soft") > 0)
    hosts = judged.groupBy("host").agg(F.count("*").alias("docs"), F.sum(failed.cast("long")).alias("failed"))
    hosts = stage(hosts, "hosts")
    p = prior(hosts)
    rate = (F.col("failed") + p.alpha) / (F.col("docs") + p.alpha + p.beta)
    word = F.when(rate > BLOCKED, "blocked").when(rate > WATCHED * p.mean, "watched").otherwise("trusted")
    return hosts.select("host", rate.alias("host_rate"), word.alias("verdict"))


def kept(base_failed: Column, n_soft: Column, verdict: Column) -> Column:
    allowed = F.when(verdict == "blocked", -1).when(verdict == "watched", 0).otherwise(1)
    return ~base_failed & (n_soft <= allowed)


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str = "source") -> DataFrame:
    """One row per document: ``doc_id``, the counts, ``base_failed``, ``kept``, host rate and verdict."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), scored(F.col(text)).alias("c"))
    # The counts are small; the texts are read once and never shuffled.
    judged = stage(slim.select("doc_id", "host", "c.*"), "counts")
    found = join_facts(judged, F.col("host"), verdicts(judged), "host", F.col("doc_id"), "of_host")
    keep = kept(F.col("base_failed"), F.col("n_soft"), F.col("of_host.verdict"))
    return found.select("doc_id", *COUNTS, "base_failed", keep.alias("kept"), "n_soft", "of_host.*")


def accepted(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    c, of_host = free_name(docs, "_counts"), free_name(docs, "_of_host")
    # Written with the counts beside the texts, so that the second pass counts nothing again.
    staged = stage(docs.withColumn(c, scored(F.col(text))), "counted")
    known = verdicts(staged.select(F.col(host).alias("host"), F.col(f"{c}.base_failed"), F.col(f"{c}.n_soft")))
    found = join_facts(staged, F.col(host), known, "host", F.xxhash64(text), of_host)
    return found.where(kept(F.col(f"{c}.base_failed"), F.col(f"{c}.n_soft"), F.col(f"{of_host}.verdict"))).select(*docs.columns)
