"""Quality rules with risk-controlled cutoffs.

Signals of each text are compared with cutoffs. A cutoff is admitted in a stratum only if
labelled holdout documents of good quality show, by an exact binomial bound corrected for
all cutoffs tried, that it rejects no more than its share of good documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, stage, text_of
from riskframe.llm.words import SPACE, Words, mix, word_batches

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTERS = UPPER.copy()
LETTERS[97:123] = True
SHOUTS = np.zeros(256, bool)
SHOUTS[list(b"!?")] = True

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_shouts"]
#: Share of bad style by signal: more is worse.
SIGNALS = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "n_letters"),
    "shouts": ("n_shouts", "word_chars"),
}
CUTOFFS = [0.01, 0.02, 0.03, 0.05, 0.075, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8]


def repeat_words(words: Words, k: int = 3) -> np.ndarray:
    """Per text, the words inside a k-word window that the text holds twice or more."""
    at, h = words.windows(k)
    key = mix(h + words.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
    at = at[counts[back] > 1]
    edges = np.zeros(len(words) + 1, np.int64)
    edges[at] += 1
    edges[at + k] -= 1
    covered = np.append(0, np.cumsum(np.cumsum(edges[:-1]) > 0))
    return covered[words.first[1:]] - covered[words.first[:-1]]


def measures(words: Words) -> list[np.ndarray]:
    """The columns of MEASURES for each text."""
    data, at = words.data, words.offsets

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(mask))
        return total[at[1:]] - total[at[:-1]]

    n_lines, n_dup = [], []
    for a, b in zip(at, at[1:]):
        lines = [x for x in data[a:b].tobytes().split(b"\n") if x and not x.isspace()]
        n_lines.append(len(lines))
        n_dup.append(len(lines) - len(set(lines)))
    points = per_text(((data & 0xC0) != 0x80) & ~SPACE[data])
    return [
        np.diff(words.first), points, per_text(SYMBOLS[data]), np.array(n_dup, np.int64), repeat_words(words),
        np.array(n_lines, np.int64), per_text(UPPER[data]), per_text(LETTERS[data]), per_text(SHOUTS[data]),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, words in word_batches(batch):
            part = batch.slice(a, b - a)
            found = [pa.array(m, pa.int64()) for m in measures(words)]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *found], ["doc_id", "stratum", "node", *MEASURES])


def measured(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, node (a hash of the text), the measures and ``base_failed``."""
    small_batches(docs.sparkSession)
    of = F.col(stratum).cast("string") if stratum in docs.columns else F.lit(None).cast("string")
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), of.alias("stratum"), F.xxhash64(text_of()).alias("node"), text_of().alias("text")
    )
    schema = "doc_id long, stratum string, node long, " + ", ".join(f"{m} long" for m in MEASURES)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return source.mapInArrow(_measure, schema).withColumn("base_failed", failed)


def _signal(name: str) -> Column:
    top, bottom = SIGNALS[name]
    return F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom)), F.lit(0.0))


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(X <= k) for X of n trials at probability p, exact; 1 where k is above the mean."""
    if k > n * p:
        return 1.0
    i = np.arange(k + 1)
    log_choose = math.lgamma(n + 1) - np.array([math.lgamma(x + 1) + math.lgamma(n - x + 1) for x in i])
    return float(min(1.0, np.exp(log_choose + i * math.log(p) + (n - i) * math.log1p(-p)).sum()))


def _tries(name: str) -> Column:
    """A signal against every cutoff."""
    return F.transform(
        F.array(*map(F.lit, CUTOFFS)),
        lambda c: F.struct(F.lit(name).alias("signal"), c.alias("cutoff"), (F.col(name) > c).alias("out")),
    )


def admitted_cutoffs(found: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """One row per stratum: its cutoff for each signal, NULL where none is admitted.

    The holdout is every labelled document that passes the base rules; a document labelled
    twice is good if any label says so. Each signal may reject ``risk`` divided by the
    number of signals of good documents. A cutoff is admitted if so few rejections among
    the good ones had probability at most ``error`` divided by all cutoffs tried
    (strata, signals, grid) at a higher rate: with probability ``1 - error`` no stratum
    loses more than ``risk``. Of the admitted ones, that which rejects the most bad
    documents is taken; ties go to the higher, and one that rejects none is not used.
    """
    label = labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    holdout = found.where("not base_failed").join(label, "doc_id").select(
        "stratum", (F.col("quality") == 1).alias("good"), *[_signal(s).alias(s) for s in SIGNALS]
    )
    tries = F.explode(F.flatten(F.array(*map(_tries, SIGNALS))))
    counted = holdout.select("stratum", "good", tries.alias("t")).groupBy("stratum", "t.signal", "t.cutoff").agg(
        F.count_if("good").alias("n"), F.count_if(F.col("good") & F.col("t.out")).alias("k"),
        F.count_if(~F.col("good") & F.col("t.out")).alias("gain"),
    )
    counted = stage(counted)
    tried = max(1, counted.count())
    share = risk / len(SIGNALS)

    @F.pandas_udf("double")
    def tail(n: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(a), int(b), share) for a, b in zip(n, k)])

    good = counted.where("gain > 0").withColumn("p", tail("n", "k")).where(F.col("p") <= error / tried)
    best = good.groupBy("stratum", "signal").agg(F.max(F.struct("gain", "cutoff")).alias("b"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("signal") == s, F.col("b.cutoff"))).alias(f"cut_{s}") for s in SIGNALS])


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """One row per document: its measures, base_failed, kept and the signals above their cutoff.

    ``kept`` is false if the base rules fail or a signal is above an admitted cutoff of the
    document's stratum. Without labels, or with too few, no cutoff is admitted and the base
    rules decide alone. NULL texts are empty and fail; a NULL stratum is a stratum;
    repeated rows are judged alike; an empty table gives no rows. ``node`` is a hash of the
    text.
    """
    found = stage(measured(docs, stratum))
    cuts = stage(admitted_cutoffs(found, labels, risk, error)).withColumnRenamed("stratum", "s")
    joined = found.join(cuts, F.col("stratum").eqNullSafe(F.col("s")), "left")
    out = F.array_compact(F.array(*[F.when(_signal(s) > F.col(f"cut_{s}"), F.lit(s)) for s in SIGNALS]))
    return joined.withColumn("rejected_by", F.concat_ws(",", out)).select(
        "doc_id", *MEASURES[:5], "base_failed", (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"),
        "rejected_by", "stratum", "node",
    )
