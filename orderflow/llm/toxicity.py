"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of two lexicons, how near their words stand to a second person,
rates of capitals, punctuation and obfuscated spelling. The lexicons are learned from labels:
words that toxic documents have and others have not, counted once per document by Spark. Words are
in lower case, with digits and signs that stand for letters put back.

Labels are learned from a bounded sample, ``SAMPLE`` documents by a hash of the id, of those whose
fold (crc32 of the id as text, modulo 4) is not 2. Folds 0 and 1 give lexicon and trees; each gets its
features from the lexicon of the other, so that no document is described by words that its own label
put there. Fold 3 calibrates: the trees' probabilities are mapped to shares of toxic documents by
isotonic regression. Trees and calibration are Spark MLlib's, trained on the executors; the driver
gets the model and the lexicon: words of the sample, so bounded by it.

Defined results: null and empty texts have zero rates and get the score of such a text; without labels
of both classes every document gets the share of toxic labels, 0 if there are none; a document
labelled twice counts once, as toxic if either says so; labels without a document or a class are left out; a null
id is of no fold that learns and is not held out; repeated rows get equal scores; an empty table gives an
empty table; of the documents' other columns none is looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import stored, text_of

HELD_OUT, CALIBRATION = 2, 3
SAMPLE = 40_000
THRESHOLD = 0.3
TREES, DEPTH = 30, 4
NEAR = 5
LEAST_DOCUMENTS, SURE_DOCUMENTS, LEAST_LOG_ODDS = 3, 10, 2.0

_LETTERS = str.maketrans("013457@$", "oieastas")
_MARKS = "!\"#%&'()*+,-./:;<=>?[\\]^_`{|}~"

_INSIDE = re.compile(r"[^\W\d_][\d@$*#.!_-]+[^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre "
    "tú ti contigo usted ustedes vosotros".split()
)
FEATURES = (
    "sure_density", "sure_distinct", "weak_density", "weak_distinct", "best_word", "mean_of_best",
    "near_second_person", "second_person", "capitals", "all_capitals", "exclamations", "marks",
    "obfuscated", "found_obfuscated", "stretched", "log_words",
)


def fold(key: str | Column) -> Column:
    return F.crc32(F.encode((F.col(key) if isinstance(key, str) else key).cast("string"), "UTF-8")) % 4


def tokens(text: str) -> tuple[list[str], list[str]]:
    """The words of a text with letters put back, and as they are written in lower case."""
    lowered = text.lower()
    for mark in _MARKS:
        if mark in lowered:
            lowered = lowered.replace(mark, " ")
    raw = lowered.split()
    return [w if w.isalpha() else w.translate(_LETTERS) for w in raw], raw


def features(text: str, lexicon: dict[str, tuple[float, bool]]) -> list[float]:
    """The values of ``FEATURES``; a lexicon word has a log odds and whether it is sure."""
    words, raw = tokens(text)
    n = max(len(words), 1)
    hits = [(i, *lexicon[w]) for i, w in enumerate(words) if w in lexicon]
    sure = [h for h in hits if h[2]]
    weak = [h for h in hits if not h[2]]
    persons = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
    near = 0
    if len(persons):
        near = sum(int(np.abs(persons - h[0]).min() <= NEAR) for h in hits)
    best = sorted(({words[h[0]]: h[1] for h in hits}).values(), reverse=True)[:5]
    letters = sum(map(str.isalpha, text))
    capitals = sum(map(str.isupper, text))
    written = text.split()
    return [
        len(sure) / n,
        float(len({words[h[0]] for h in sure})),
        len(weak) / n,
        float(len({words[h[0]] for h in weak})),
        best[0] if best else 0.0,
        sum(best) / 5,
        near / n,
        len(persons) / n,
        capitals / max(letters, 1),
        sum(len(w) > 1 and w.isupper() for w in written) / n,
        text.count("!") / n,
        sum(text.count(m) for m in _MARKS) / max(len(text), 1),
        len(_INSIDE.findall(text)) / n,
        sum(words[h[0]] != raw[h[0]] for h in hits) / n,
        len(_STRETCHED.findall(text)) / n,
        float(np.log1p(len(words))),
    ]


def _spoken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each document, one row each, with its fold and label."""
    for batch in batches:
        for text, own, label in zip(*(batch.column(c).to_pylist() for c in ("text", "fold", "toxic")), strict=True):
            words = sorted(set(tokens(text)[0]))
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(words, pa.string()), "fold": pa.array([own] * len(words), pa.int64()),
                 "toxic": pa.array([label] * len(words), pa.int32())}
            )


def learn_lexicons(training: DataFrame) -> dict[str, dict[str, tuple[float, bool]]]:
    """Lexicons for documents of fold 0 (from fold 1), of fold 1 (from 0) and all others (from both)."""
    sizes = {(r.fold, r.toxic): r.n for r in training.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    words = stored(
        training.select("text", "fold", "toxic")
        .mapInArrow(_spoken, "word string, fold long, toxic int")
        .groupBy("word")
        .agg(*[
            F.count(F.when((F.col("fold") == f) & (F.col("toxic") == t), 1)).alias(f"n{f}{t}")
            for f in (0, 1) for t in (0, 1)
        ])
        .filter(f"n01 + n11 >= {LEAST_DOCUMENTS}"),
        "words",
    )
    lexicons = {}
    for name, folds in (("0", (1,)), ("1", (0,)), ("all", (0, 1))):
        toxic, clean = (sum(sizes.get((f, t), 0) for f in folds) for t in (1, 0))
        a, b = (F.expr("+".join(f"n{f}{t}" for f in folds)) for t in (1, 0))
        odds = F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (clean + 1))
        chosen = (
            words.select("word", a.alias("a"), odds.alias("odds"))
            .filter(f"a >= {LEAST_DOCUMENTS} and odds >= {LEAST_LOG_ODDS}")
        )
        lexicons[name] = {r.word: (r.odds, r.a >= SURE_DOCUMENTS) for r in chosen.collect()}
    return lexicons


def described(rows: DataFrame, lexicons: dict) -> DataFrame:
    """``rows`` (id, fold, toxic, text) with the features ``x`` in place of the text."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, use in zip(batch.column("text").to_pylist(), batch.column("use").to_pylist(), strict=True):
                found.append(features(text, lexicons[use]))
            columns = [batch.column(c) for c in ("id", "fold", "toxic")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.list_(pa.float64()))], ["id", "fold", "toxic", "x"]
            )

    return rows.mapInArrow(describe, "id long, fold long, toxic int, x array<double>").withColumn(
        "x", array_to_vector("x")
    )


@dataclass
class Model:
    lexicons: dict
    trees: object
    calibration: object
    share: float

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` (id, fold, text) with a score."""
        rows = rows.withColumn("toxic", F.lit(None).cast("int"))
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.share))
        found = described(rows.withColumn("use", F.lit("all")), self.lexicons)
        return self.calibrated(found)

    def calibrated(self, found: DataFrame) -> DataFrame:
        found = self.trees.transform(found).withColumn("p", vector_to_array("probability")[1])
        if self.calibration is None:
            return found.withColumn("score", F.col("p"))
        return self.calibration.transform(found).withColumn(
            "score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "prediction_calibrated"))
        )


def training_rows(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(id, fold, toxic, text) of the labelled documents to learn from, at most about ``sample``."""
    own = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("id is not null and toxic in (0, 1)")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("fold", fold("id"))
        .filter(F.col("fold") != HELD_OUT)
    )
    share = min(1.0, sample / max(own.count(), 1))
    own = own.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), text_of("text").alias("text"))
    # The labels are at most about ``sample`` narrow rows, so they go to the texts.
    return stored(texts.join(F.broadcast(own), "id").select("id", "fold", "toxic", "text"), "training")


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = training_rows(documents, labels, sample)
    learning = rows.filter(F.col("fold") != CALIBRATION)
    n, positive = learning.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if positive in (0, n):
        return Model({}, None, None, positive / n if n else 0.0)
    lexicons = learn_lexicons(learning)
    use = F.when(F.col("fold") == CALIBRATION, "all").otherwise(F.col("fold").cast("string"))
    found = stored(described(rows.withColumn("use", use), lexicons), "features")
    trees = GBTClassifier(
        featuresCol="x", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1, minInstancesPerNode=5
    ).fit(found.filter(F.col("fold") != CALIBRATION))
    model = Model(lexicons, trees, None, positive / n)
    held = model.calibrated(found.filter(F.col("fold") == CALIBRATION)).select("p", F.col("toxic").cast("double").alias("y"))
    if not held.isEmpty():
        model.calibration = IsotonicRegression(
            featuresCol="p", labelCol="y", predictionCol="prediction_calibrated"
        ).fit(held)
    return model


def score(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(documents, labels, sample)
    rows = documents.select(F.col("doc_id").alias("id"), fold("doc_id").alias("fold"), text_of("text").alias("text"))
    return model.scored(rows).select(
        F.col("id").alias("doc_id"),
        F.coalesce(F.col("fold") == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
