"""Toxicity by weak supervision: lexicon voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, stage, text_of
from riskframe.llm.decontamination import HOW
from riskframe.llm.words import Words, mix, word_batches

#: Labelled rows that a fit reads at most, about: drawn by a hash of doc_id.
FIT_ROWS = 40_000
#: Entries of the learned lexicon: whole words, and starts of words of so many bytes.
LEXICON = 2048
STARTS = (3, 4, 5, 6)
#: Voters made of the lexicon: those of whole words, then those of each length of starts.
WORD_VOTERS, START_VOTERS = 6, 2
PATTERN_VOTERS = 2
VOTERS = WORD_VOTERS + START_VOTERS * len(STARTS) + PATTERN_VOTERS
ROUNDS = 25


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text index and key of every feature: each word, and its starts. The key's lowest bits are the kind."""
    size = words.stops - words.starts
    docs, keys = [words.doc], [_key(words.hash, 0)]
    for kind, n in enumerate(STARTS, 1):
        long = np.flatnonzero(size > n)
        docs.append(words.doc[long])
        keys.append(_key(words.hash_between(words.starts[long], words.starts[long] + n), kind))
    return np.concatenate(docs), np.concatenate(keys)


def _key(h: np.ndarray, kind: int) -> np.ndarray:
    return (mix(h + np.uint64(kind)) & ~np.uint64(7)) | np.uint64(kind)


def voter_of(keys: np.ndarray) -> np.ndarray:
    """The voter that a lexicon entry belongs to."""
    kind = (keys & np.uint64(7)).astype(np.int64)
    part = (keys >> np.uint64(32)).astype(np.int64)
    return np.where(kind == 0, part % WORD_VOTERS, WORD_VOTERS + (kind - 1) * START_VOTERS + part % START_VOTERS)


def held_out() -> Column:
    """The fold that no fit reads: crc32 of doc_id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for a, b, words in word_batches(batch, **HOW):
            doc, key = features(words)
            order = np.lexsort((doc, key))
            doc, key = doc[order], key[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            doc, key = doc[new], key[new]
            distinct, back = np.unique(key, return_inverse=True)
            yes = np.bincount(back, toxic[a:b][doc], len(distinct)).astype(np.int64)
            no = np.bincount(back, ~toxic[a:b][doc], len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(yes), pa.array(no)], ["key", "yes", "no"])


def learn_lexicon(labelled: DataFrame, size: int = LEXICON) -> np.ndarray:
    """Keys of the ``size`` features that toxic texts hold most surely more often, sorted.

    Ranked by the log odds ratio less two standard errors; it must be above 1.
    """
    totals = labelled.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    counted = labelled.select(text_of().alias("text"), "toxic").mapInArrow(_count, "key long, yes long, no long")
    counted = counted.groupBy("key").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).where("yes >= 3")
    yes, no = F.col("yes") + 0.5, F.col("no") + 0.5
    odds = F.log(yes / (totals[0] + 1 - yes)) - F.log(no / (totals[1] + 1 - no))
    sure = odds - 2 * F.sqrt(1 / yes + 1 / no)
    best = counted.select("key", sure.alias("sure")).where("sure > 1").orderBy(F.desc("sure"), "key").limit(size)
    return np.sort(np.array([r["key"] for r in best.collect()], np.int64).view(np.uint64))


def entries(words: Words, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text index, lexicon index) of a piece of texts."""
    doc, key = features(words)
    if not len(lexicon) or not len(key):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place = np.minimum(np.searchsorted(lexicon, key), len(lexicon) - 1)
    hit = lexicon[place] == key
    pair = np.unique(doc[hit] * len(lexicon) + place[hit])
    return pair // len(lexicon), pair % len(lexicon)


def votes(doc: np.ndarray, entry: np.ndarray, words: Words, lexicon: np.ndarray) -> np.ndarray:
    """Matrix of texts and voters: whether a voter finds an entry of its own.

    The two pattern voters fire on three distinct entries, and on one per fifty words.
    """
    n = np.diff(words.first)
    out = np.zeros((len(n), VOTERS), bool)
    if len(entry):
        out[doc, voter_of(lexicon)[entry]] = True
    distinct = np.bincount(doc, minlength=len(n))
    out[:, -2] = distinct >= 3
    out[:, -1] = distinct * 50 > n
    return out


def _vote(lexicon: np.ndarray) -> Callable:
    bits = 1 << np.arange(VOTERS, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in word_batches(batch, **HOW):
                doc, entry = entries(words, lexicon)
                pattern = votes(doc, entry, words, lexicon) @ bits
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.slice(a, b - a).column(1), pa.array(pattern),
                     pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(entry, pa.int64()))],
                    ["toxic", "pattern", "entries"],
                )

    return run


@dataclass
class LabelModel:
    """Class share and each voter's rate in both classes, with its weight after correlations."""

    share: float
    rates: np.ndarray  # class, voter
    trust: np.ndarray  # voter

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        on, off = np.log(self.rates), np.log1p(-self.rates)
        odds = np.log(self.share / (1 - self.share)) + fired @ ((on[1] - on[0]) * self.trust) + ~fired @ ((off[1] - off[0]) * self.trust)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit_label_model(fired: np.ndarray, yes: np.ndarray, no: np.ndarray) -> LabelModel:
    """Expectation-maximization over distinct vote patterns with their numbers of rows.

    It starts from the rates among labelled rows; from then on votes alone speak. After each
    round the voters' correlations inside the classes are estimated, and a voter that says
    what others say is trusted by as much less: 1 / (1 + its mean-class correlations).
    """
    n, label = yes + no, yes / np.maximum(yes + no, 1)
    model = None
    for _ in range(ROUNDS):
        p = label if model is None else model.posterior(fired)
        share = float((n * p).sum() + 1) / (n.sum() + 2)
        rates, same = [], np.zeros((VOTERS, VOTERS))
        for w in (n * (1 - p), n * p):
            rate = (w @ fired + 0.5) / (w.sum() + 1)
            apart = fired - rate
            cov = (apart * w[:, None]).T @ apart / max(w.sum(), 1)
            dev = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            same += np.abs(cov / dev[:, None] / dev) / 2
            rates.append(rate)
        np.fill_diagonal(same, 0)
        model = LabelModel(share, np.array(rates), 1 / (1 + same.sum(axis=1)))
    return model


@dataclass
class Classifier:
    lexicon: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, doc: np.ndarray, entry: np.ndarray, n: int) -> np.ndarray:
        z = self.bias + np.bincount(doc, self.weights[entry], n) if len(entry) else np.full(n, self.bias)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Classifier:
    """Learn from labelled documents outside the held-out fold.

    Fits read at most about ``rows`` labelled documents, drawn by a hash of doc_id; scoring
    reads everything. A document labelled twice is toxic if any label says so.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import SparseVector, VectorUDT

    spark = docs.sparkSession
    small_batches(spark)
    known = labels.where("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).alias("toxic"))
    known = known.where(~held_out())
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, rows / max(n, 1)))
    labelled = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(
        F.broadcast(known.where(draw)), "doc_id"  # about ``rows`` rows at most
    ).select("text", "toxic"))
    lexicon = learn_lexicon(labelled)
    voted = stage(labelled.mapInArrow(_vote(lexicon), "toxic boolean, pattern long, entries array<long>"))
    # at most 2 ** VOTERS patterns
    seen = voted.groupBy("pattern").agg(F.count_if("toxic").alias("yes"), F.count_if(~F.col("toxic")).alias("no")).orderBy("pattern").toPandas()
    if not len(seen) or not len(lexicon):
        return Classifier(lexicon, np.zeros(len(lexicon)), -2.0)
    fired = (seen["pattern"].to_numpy()[:, None] >> np.arange(VOTERS)) & 1 == 1
    model = fit_label_model(fired, seen["yes"].to_numpy(float), seen["no"].to_numpy(float))
    said = spark.createDataFrame(list(zip(seen["pattern"].tolist(), model.posterior(fired).tolist())), "pattern long, p double")
    size = len(lexicon)
    vector = F.udf(lambda x: SparseVector(size, x, [1.0] * len(x)), VectorUDT())
    soft = voted.join(F.broadcast(said), "pattern").select(vector("entries").alias("features"), F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")),
    )).alias("y")).select("features", "y.label", "y.weight").where("weight > 1e-6")
    trained = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50, standardization=False).fit(stage(soft))
    return Classifier(lexicon, trained.coefficients.toArray(), float(trained.intercept))


def _score(model: Classifier) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in word_batches(batch, **HOW):
                doc, entry = entries(words, model.lexicon)
                part = batch.slice(a, b - a)
                score = pa.array(model.scores(doc, entry, b - a))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), score], ["doc_id", "held_out", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1) and predicted (score >= 0.5).

    A score depends on the text alone. NULL and empty texts score as a text without any
    lexicon entry; repeated rows score alike; without labels every score is the same; an
    empty table gives no rows; other columns are ignored.
    """
    model = fit(docs, labels, rows)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_of().alias("text"))
    scored = source.mapInArrow(_score(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
