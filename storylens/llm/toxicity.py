"""Toxicity by class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary texts, give each word a
log-likelihood ratio by its letters; the short orders share their counts
(``kneser_ney``). A document's evidence is length-normalised: the mean ratio of
its words, the largest mean of ``WINDOWS`` successive words, and the mean of its
``STRONGEST`` different words, so that a few expressions in a long text weigh
as they would in a short one. A logistic regression turns the evidence into a
score. It is fitted on documents that the models of its features have not seen.
A word counts once for each training document, and equal texts train once.

The models count the texts of all training rows: words, then their n-grams, are
summed in Spark, and only the table of different n-grams comes to the driver. The
logistic regression is fitted on a bounded sample: about ``TOXIC`` and
``ORDINARY`` texts, those of the smallest hashes. All rows of the input are
scored, over the whole text.

A null text counts as empty. A text without letters has no evidence and gets
the score of none. A document labelled more than once counts as toxic if any
label says so; rows with null ids or labels don't train. If either class has
no training rows, the score is the other's label (0 without any). Equal texts
get equal scores. Only id and text of the documents are read.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylens.llm.common import SLICE, documents, hash_bound, map_columns, ship_package, worker_state, written
from storylens.llm.kneser_ney import Ratios, logistic, ngrams, sigmoid

#: Texts of either class that the logistic regression is fitted on, about (half of them if there are two folds).
TOXIC, ORDINARY = 2500, 5000
#: Counted words that a worker holds, and words whose n-grams it sums at once.
HELD, TOGETHER = 300_000, 50_000
#: Words of a passage whose mean ratio counts.
WINDOWS = (1, 8, 32)
#: Different words of the largest ratios whose mean counts.
STRONGEST = (3, 6, 12)
EVIDENCE = 1 + len(WINDOWS) + len(STRONGEST)
#: Words whose ratios a worker keeps; longer words than LONGEST are scored each time.
KEPT, LONGEST = 400_000, 40
#: The score from which a text counts as toxic; the sample's labels decide what evidence reaches it.
CUT = 0.7
WORD = re.compile(r"[^\W\d_]+")


def training_rows(doc_id: Column) -> Column:
    """Rows that labels may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


class Scorer:
    """Evidence and scores of texts; keeps the ratios of words it has met."""

    def __init__(self, ratios: Ratios, weights: np.ndarray | None = None):
        self.ratios, self.weights = ratios, weights
        self.kept: dict[str, float] = {}

    def evidence(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), EVIDENCE))
        for k in range(0, len(texts), 256):
            words = [WORD.findall(t.lower()) for t in texts[k:k + 256]]
            fresh = list(set().union(*words).difference(self.kept)) if words else []
            if len(self.kept) + len(fresh) > KEPT:
                self.kept.clear()
                fresh = list(set().union(*words))
            made = dict(zip(fresh, self.ratios.score(fresh).tolist()))
            self.kept.update(made)
            for i, w in enumerate(words, k):
                if w:
                    r = np.fromiter(map(self.kept.__getitem__, w), np.float64, len(w))
                    sums = np.concatenate(([0.0], np.cumsum(r)))
                    out[i, 0] = r.mean()
                    for j, n in enumerate(WINDOWS, 1):
                        n = min(n, len(r))
                        out[i, j] = (sums[n:] - sums[:-n]).max() / n
                    kinds = set(w)
                    most = np.fromiter(map(self.kept.__getitem__, kinds), np.float64, len(kinds))
                    if len(most) > STRONGEST[-1]:
                        most = np.partition(most, len(most) - STRONGEST[-1])[-STRONGEST[-1]:]
                    most = np.sort(most)[::-1]
                    for j, n in enumerate(STRONGEST, 1 + len(WINDOWS)):
                        out[i, j] = most[:n].mean()
            if any(len(x) > LONGEST for x in made):
                for x in made:
                    if len(x) > LONGEST:
                        self.kept.pop(x, None)
        return out

    def scores(self, texts: list[str]) -> list[float]:
        e = self.evidence(texts)
        return [sigmoid(x) for x in e @ self.weights[:-1] + self.weights[-1]]


def _scorer(shared) -> Scorer:
    name, value = shared.value
    return worker_state(("toxicity", name), lambda: Scorer(*value))


def best_cut(found: np.ndarray, labels: np.ndarray) -> float:
    """Where a cut meets the labels best (highest F1, and of equal ones the lowest cut), half-way to the next lower value."""
    order = np.argsort(-found, kind="stable")
    values, met = found[order], np.cumsum(labels[order])
    last = np.append(np.flatnonzero(np.diff(values)), len(values) - 1)  # of equal values
    f1 = 2 * met[last] / (last + 1 + met[-1])
    k = last[len(f1) - 1 - int(np.argmax(f1[::-1]))]
    return float(values[k] + values[min(k + 1, len(values) - 1)]) / 2


def _word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n00, n01, n10, n11)``: in how many texts of a fold and label a word stands."""
    ship_package(texts.sparkSession)

    def run(batches):
        from collections import Counter, defaultdict

        counts: dict[tuple[int, int], Counter] = defaultdict(Counter)

        def made():
            for (fold, label), c in counts.items():
                yield pa.RecordBatch.from_pydict(
                    {"fold": pa.array([fold] * len(c), pa.int32()), "label": pa.array([label] * len(c), pa.int32()),
                     "word": pa.array(list(c), pa.string()), "n": pa.array(list(c.values()), pa.int64())})
            counts.clear()

        for b in (whole.slice(k, SLICE) for whole in batches for k in range(0, whole.num_rows, SLICE)):
            for t, fold, label in zip(*(b.column(c).to_pylist() for c in ("text", "fold", "label"))):
                counts[fold, label].update(set(WORD.findall(t.lower())))
            if sum(map(len, counts.values())) > HELD:
                yield from made()
        yield from made()

    parts = texts.select("text", "fold", "label").mapInArrow(run, "fold int, label int, word string, n bigint")
    return parts.groupBy("word").agg(*(
        F.sum(F.when((F.col("fold") == f) & (F.col("label") == c), F.col("n")).otherwise(0)).alias(f"n{f}{c}")
        for f in (0, 1) for c in (0, 1)))


def _gram_counts(words: DataFrame) -> DataFrame:
    """``(high, low, n00, n01, n10, n11)``: the sums of the words' counts for each n-gram (``kneser_ney.ngrams``)."""
    names = [f"n{f}{c}" for f in (0, 1) for c in (0, 1)]

    def run(batches):
        def made():
            table = pa.Table.from_batches(held)
            high, low, sums = ngrams(table["word"].to_pylist(), np.stack([table[c].to_numpy() for c in names], 1))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (high, low, *sums.T)], ["high", "low", *names])

        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= TOGETHER:
                yield made()
                held.clear()
        if sum(x.num_rows for x in held):
            yield made()

    parts = words.mapInArrow(run, "high bigint, low bigint, " + ", ".join(f"{c} bigint" for c in names))
    return parts.groupBy("high", "low").agg(*(F.sum(c).alias(c) for c in names))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", toxic: int = TOXIC, ordinary: int = ORDINARY):
    """``(ratios, weights)`` from the training rows, or the one label that they have (0 without any)."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where("doc_id is not null and label in (0, 1)").where(training_rows(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    texts = documents(docs).where(training_rows(F.col("doc_id"))).withColumn("key", F.md5("text"))
    # a row of two small numbers for each different training text
    marks = written(texts.select("doc_id", "key").join(known, "doc_id").groupBy("key").agg(F.max("label").alias("label"))
                    .withColumn("fold", F.pmod(F.xxhash64("key", F.lit("fold")), F.lit(2)).cast("int")), "toxicity-labels")
    have = {(r.fold, r.label): r["count"] for r in marks.groupBy("fold", "label").count().collect()}
    classes = {label for _, label in have}
    if len(classes) < 2:
        return max(classes, default=0)
    # texts and their labels meet in one aggregate, so that copies of a text are one row before they move
    none = F.lit(None).cast("int")
    trained = (texts.select("key", "text", none.alias("fold"), none.alias("label"))
               .unionByName(marks.select("key", F.lit(None).cast("string").alias("text"), "fold", "label"))
               .groupBy("key").agg(F.max("text").alias("text"), F.max("fold").alias("fold"), F.max("label").alias("label"))
               .where("label is not null"))
    counts = _gram_counts(_word_counts(trained)).toArrow()
    high, low = counts["high"].to_numpy(), counts["low"].to_numpy()

    def model(folds):
        by_class = np.stack([sum(counts[f"n{f}{c}"].to_numpy() for f in folds) for c in (1, 0)], 1)
        used = by_class.sum(1) > 0
        return Ratios.of_counts(high[used], low[used], by_class[used])

    final = model((0, 1))
    held = model((0,)) if len(have) == 4 else final  # too few rows for two halves
    del counts, high, low
    # the bounded sample: about toxic + ordinary rows
    most = F.create_map(*(F.lit(x) for c, n in ((1, toxic), (0, ordinary))
                          for x in (c, hash_bound(n / max(1, sum(have.get((f, c), 0) for f in (0, 1)))))))
    chosen = marks.where(F.xxhash64("key", F.lit("toxicity")) <= most[F.col("label")])
    if len(have) == 4:
        chosen = chosen.where("fold = 1")
    calibrating = texts.join(F.broadcast(chosen), "key").groupBy("text").agg(F.max("label").alias("label"))
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, (held,)))
    names = [f"e{i}" for i in range(EVIDENCE)]

    def make():
        scorer = _scorer(shared)
        return lambda texts: list(scorer.evidence(texts).T)

    rows = map_columns(calibrating, ["text"], ", ".join(f"{n} double" for n in names), make)
    rows = rows.select("label", *names).toPandas()  # of the bounded sample
    rows = rows.sort_values(["label", *names])  # the same weights from any order of the rows
    x, y = rows[names].to_numpy(), rows["label"].to_numpy()
    weights = logistic(x, y)
    weights[-1] += math.log(CUT / (1 - CUT)) - best_cut(x @ weights[:-1] + weights[-1], y)
    return final, weights


def score(docs: DataFrame, fitted, id_col: str = "doc_id", text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """Append the score, 0 to 1, of the whole text."""
    if isinstance(fitted, int):
        return docs.withColumn(score_col, F.lit(float(fitted)))
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, fitted))

    def make():
        scorer = _scorer(shared)
        return lambda texts: [scorer.scores([t or "" for t in texts])]

    return map_columns(docs, [text_col], f"`{score_col}` double", make)
