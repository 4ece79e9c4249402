"""Quality rules with host verdicts.

Base rules measure each whole text in its own task. Their failures are then
counted per host (one small row per host after map-side sums), each host's
failure rate is shrunk towards the corpus by a beta prior fitted to all hosts
(method of moments), and hosts whose shrunk rate exceeds ``max_host_rate``
reject their remaining documents.

The measures are a function of the text column, so a filter over them keeps
every column and moves no text. Host counts join back to documents on the host;
a hot host is split by the skew join, or the join is a broadcast when the host
table is measured to be small.

Defined results: a null text has no words and fails the base rules; a document
with a null host gets no host verdict; repeated rows count separately; an
empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlog.llm.common import byte_texts, map_batches, written
from viewlog.session import ship_package

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
MAX_HOST_RATE = 0.5
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    code: dict[bytes, int] = {}
    ids = np.fromiter((code.setdefault(w, len(code)) for w in words), np.uint64, len(words))
    if len(code) == len(words):
        return 0
    mixed = np.zeros(n, np.uint64)
    for i in range(window):  # a wrapping polynomial only proposes repeats
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[i:i + n] + np.uint64(1)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    held = np.zeros(n, bool)
    held[order[1:][same]] = True
    held[order[:-1][same]] = True
    at = np.flatnonzero(held)
    rows = np.lib.stride_tricks.sliding_window_view(ids, window)[at]
    _, which, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    at = at[count[which.reshape(-1)] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(data: bytes | None) -> tuple[int, int, int, int, int]:
    """The base measures of one text: ``MEASURES``."""
    data = data or b""
    words = data.split()
    packed = data.translate(None, BLANKS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (len(words), len(packed.decode("utf-8", "replace")), len(data) - len(data.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def measures(text: Column) -> Column:
    """The measures as a struct column; needs the package shipped to the workers."""

    @F.pandas_udf(MEASURES)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MEASURES.split(", ")]
        for batch in texts:
            yield pd.DataFrame([measure(t.encode() if t is not None else None) for t in batch], columns=names, dtype="int64")

    return run(text)


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in MEASURES.split(", ")]
    for batch in batches:
        found = np.array([measure(t) for t in byte_texts(batch.column("text"))], np.int64).reshape(-1, len(names))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("host"), *(pa.array(c) for c in found.T)],
                                         names=["doc_id", "host", *names])


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PCT * n_words)


def host_verdicts(measured: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``host, host_docs, host_failed, host_rate, host_ok`` of rows with ``host, base_failed``.

    ``host_rate`` is the posterior mean under the beta prior of all hosts. The
    prior's strength comes from the spread of host rates beyond what binomial
    noise gives; without such spread every host gets the corpus rate.
    """
    hosts = (measured.where("host is not null").groupBy("host")
             .agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed")))
    hosts = written(hosts, "hosts")
    # Five sums over the host table, in two passes: constants, whatever the number of hosts.
    total, failed, n_hosts, squares = hosts.agg(
        F.coalesce(F.sum("host_docs"), F.lit(0)), F.coalesce(F.sum("host_failed"), F.lit(0)), F.count("*"),
        F.coalesce(F.sum(F.col("host_docs").cast("double") * F.col("host_docs")), F.lit(0.0))).first()
    if not total:
        alpha = beta = 1.0
    else:
        mean = failed / total
        spread = hosts.agg(F.sum(F.col("host_docs") * F.pow(F.col("host_failed") / F.col("host_docs") - F.lit(mean), 2))).first()[0] / total
        noise = mean * (1 - mean) * (n_hosts - 1) / total
        share = 1 - squares / (total * total)
        between = max(0.0, spread - noise) / share if share > 1e-12 else 0.0
        strength = min(max(mean * (1 - mean) / between - 1, 2.0), 1e6) if between > 0 else 1e6
        alpha, beta = mean * strength, (1 - mean) * strength
    rate = (F.col("host_failed") + F.lit(alpha)) / (F.col("host_docs") + F.lit(alpha + beta))
    return hosts.withColumn("host_rate", rate).withColumn("host_ok", F.col("host_rate") <= max_host_rate)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                     max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per row: ``doc_id``, the measures, ``base_failed``, ``kept`` and ``host_rate`` (null without a host)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.col(text_col).cast("string").alias("text"))
    found = map_batches(rows, _measure_batches, "doc_id long, host string, " + MEASURES)
    found = written(found.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))), "measures")
    verdicts = host_verdicts(found, max_host_rate).select("host", "host_rate", "host_ok")
    kept = ~F.col("base_failed") & F.coalesce("host_ok", F.lit(True))
    return found.join(verdicts, "host", "left").select(
        "doc_id", *(c.split()[0] for c in MEASURES.split(", ")), "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
              max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that the verdicts keep, all columns as they were.

    Rows are judged in place (the measures are taken again), so neither texts
    nor document ids are shuffled: only the host verdicts are joined.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.col(text_col).cast("string").alias("text"))
    found = map_batches(rows, _measure_batches, "doc_id long, host string, " + MEASURES)
    found = written(found.select("host", base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed")), "measures")
    bad = host_verdicts(found, max_host_rate).where("not host_ok").select(F.col("host").alias("_bad_host"))
    good = docs.withColumn("_m", measures(F.col(text_col).cast("string")))
    good = good.where(~base_failed(F.col("_m.n_words"), F.col("_m.n_repeat_words"))).drop("_m")
    return good.join(bad, F.col(host_col).cast("string") == F.col("_bad_host"), "left_anti").select(*docs.columns)
