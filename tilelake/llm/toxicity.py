"""Toxicity by class-conditional Kneser-Ney bigram models.

One model is counted on toxic and one on ordinary documents of a bounded labelled sample. Bigrams are token counts less DISCOUNT;
they back off to their class's continuation counts (how many different words a word follows), which are discounted
likewise and back off to continuation counts of both classes together. So an expression that only few documents hold
still tells something, but only as much as its class has beyond what the classes share.

A logistic curve, fitted on labelled documents that were not counted, turns a text into a probability. It sees the difference of
the two log-likelihoods by length, the length, and how many words lean to the toxic class, counted by how far their
log-likelihoods differ (STRENGTHS) and by how many standard deviations their continuation counts lie above the class's share (DEVIATIONS):
words that are rare lean to either class by chance, and the curve learns how far to trust each kind.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tilelake.llm.common import column, documents, remainder, words_of

#: Labelled documents taken of each class at most, those of least hash; two thirds are counted, the rest fit the curve.
SAMPLE = 2400
#: What every count gives up for the backoff.
DISCOUNT = 0.75
#: Bounds of the kinds of words that lean to the toxic class.
STRENGTHS, DEVIATIONS = (0.5, 1.0, 1.5), (1.0, 2.0, 4.0, 8.0, 16.0)
#: Constant, difference by length, logarithm of the length, then one for each kind.
_FEATURES = 3 + len(STRENGTHS) + len(DEVIATIONS)
_BEGIN = b"\n"  # no word holds white space


class Model:
    """The log-likelihood differences (toxic less ordinary) of words, of contexts without the bigram, and of bigrams."""

    def __init__(self, toxic: list[str], ordinary: list[str]):
        self.numbers = {_BEGIN: 0}
        numbers = self.numbers
        pairs = Counter(), Counter()  # of ordinary and of toxic texts, a bigram being one integer
        for texts, found in zip((ordinary, toxic), pairs):
            for text in dict.fromkeys(texts):
                before = 0
                for w in words_of(text):
                    n = numbers.setdefault(w, len(numbers))
                    found[before << 32 | n] += 1
                    before = n
        size = len(numbers)
        v, w = (np.array([f(p) for c in pairs for p in c], np.int64) for f in (lambda p: p >> 32, lambda p: p & 0xFFFFFFFF))
        n = np.array([n for c in pairs for n in c.values()], float)
        of = np.repeat([0, 1], [len(c) for c in pairs])
        heard, follows, goes_on = np.zeros((2, size)), np.zeros((2, size)), np.zeros((2, size))
        np.add.at(heard, (of, v), n)  # tokens after a context
        np.add.at(goes_on, (of, v), 1)  # different words after it
        np.add.at(follows, (of, w), 1)  # different contexts before a word
        either = np.bincount(np.unique(v << 32 | w) & 0xFFFFFFFF, minlength=size)
        total = max(1, either.sum())
        spare = 1 - np.maximum(either - DISCOUNT, 0).sum() / total
        shared = np.maximum(either - DISCOUNT, 0) / total + spare / (size + 1)
        kinds = np.maximum(1, follows.sum(1))
        kept = np.maximum(follows - DISCOUNT, 0)
        left = 1 - kept.sum(1) / kinds
        words = kept / kinds[:, None] + left[:, None] * shared
        back = np.where(heard > 0, DISCOUNT * goes_on / np.maximum(heard, 1), 1.0)
        self.words = np.log(words[1] / words[0]).tolist()
        self.contexts = np.log(back[1] / back[0]).tolist()
        self.unseen = log(left[1] / left[0])  # a word of neither class has the shared model's share for it

        def of_class(k: int, p: int) -> float:
            a, b = p >> 32, p & 0xFFFFFFFF
            own = max(pairs[k].get(p, 0) - DISCOUNT, 0) / heard[k, a] if heard[k, a] else 0.0
            return own + back[k, a] * words[k, b]

        self.pairs = {p: log(of_class(1, p) / of_class(0, p)) for p in pairs[0].keys() | pairs[1].keys()}
        # the kinds of a word that leans to the toxic class
        share = kinds[1] / kinds.sum()
        both = follows.sum(0)
        beyond = (follows[1] - both * share) / np.sqrt(np.maximum(both, 1) * share * (1 - share))
        self.kinds = {
            i: (bisect_right(STRENGTHS, d) - 1, bisect_right(DEVIATIONS, z) - 1)
            for i, (d, z) in enumerate(zip(self.words, beyond.tolist()))
            if d >= STRENGTHS[0]
        }
        self.curve = np.zeros(_FEATURES)

    def features(self, text: str | None) -> list[float]:
        """Constant, length-normalised difference, logarithms of the length and of the number of words of each kind."""
        numbers, words, contexts, pairs, kinds = self.numbers, self.words, self.contexts, self.pairs, self.kinds
        strengths, deviations = [0] * len(STRENGTHS), [0] * len(DEVIATIONS)
        total, before = 0.0, 0
        tokens = words_of(text)
        for token in tokens:
            w = numbers.get(token, -1)
            d = pairs.get(before << 32 | w) if before >= 0 and w >= 0 else None
            if d is None:
                d = (words[w] if w >= 0 else self.unseen) + (contexts[before] if before >= 0 else 0.0)
            total += d
            kind = kinds.get(w)
            if kind is not None:
                strengths[kind[0]] += 1
                if kind[1] >= 0:
                    deviations[kind[1]] += 1
            before = w
        n = len(tokens)
        return [1.0, total / max(1, n), *(log(1 + c) for c in (n, *strengths, *deviations))]

    def fit(self, texts: list[str], toxic: np.ndarray, weights: np.ndarray) -> None:
        """Logistic regression by Newton steps, with a little shrinkage."""
        x = np.array([self.features(t) for t in texts], float)
        b = np.zeros(_FEATURES)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            g = x.T @ (weights * (toxic - p)) - 0.1 * b
            h = (x * (weights * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(_FEATURES)
            b = b + np.linalg.solve(h, g)
        self.curve = b

    def score(self, text: str | None) -> float:
        z = self.curve @ np.array(self.features(text))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """A model of the labelled rows that may be learned from; None if one class has none."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(remainder(F.col("doc_id"), 5) != 0)
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = {}
    for k in (0, 1):
        chosen = known.filter(F.col("toxic") == k).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        ids |= {r["doc_id"]: (k, i) for i, r in enumerate(chosen.collect())}
    if not ids:
        return None
    # at most twice SAMPLE ids, and their texts
    sample = docs.sparkSession.createDataFrame([(i,) for i in ids], "wanted long")
    rows = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("wanted"), "left_semi")
    counted, fitted = ([], []), []
    for r in rows.distinct().toLocalIterator():
        k, place = ids[r["doc_id"]]
        if place % 3 < 2:
            counted[k].append((place, r["text"]))
        else:
            fitted.append((place, k, r["text"] or ""))
    if not counted[0] or not counted[1] or not fitted:
        return None
    model = Model(*([t or "" for _, t in sorted(c, key=lambda x: (x[0], x[1] or ""))] for c in (counted[1], counted[0])))
    fitted.sort()
    toxic = np.array([k for _, k, _ in fitted], float)
    # the sample's classes weigh as much as in all labels
    share = [totals.get(k, 1) / max(1, (toxic == k).sum()) for k in (0, 1)]
    weights = np.where(toxic == 1, share[1], share[0])
    model.fit([t for *_, t in fitted], toxic, weights * len(fitted) / weights.sum())
    return model


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (1 from 0.5).

    Learns from labels whose id has a crc32 remainder other than 0 by 5. Null and empty texts get the score of a text without
    evidence. Without labels of both classes every score is 0. A document of several labels is toxic if one says so. Rows are scored each by
    itself; all columns are passed on and result columns replace those of the same name.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col))
    kept = [c for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    at = kept.index(text_col)
    given = docs.select(*map(column, kept), (remainder(column(id_col), 5) == 0).alias("held_out"))
    # Spark hands columns to the function by plain names only, so names with dots come back afterwards
    plain = given.toDF(*(f"c{i}" for i in range(len(given.columns))))
    schema = StructType([*plain.schema, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = model.value
            scores = np.array([m.score(t.as_py()) if m else 0.0 for t in batch.column(at)], float)
            columns = [*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return plain.mapInArrow(run, schema).toDF(*given.columns, "score", "predicted")


def op3(spark, sf_dir) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(documents(spark, sf_dir).select("doc_id", "text"), labels).drop("text")
