"""Toxicity by a counterfactually regularised word classifier.

A logistic model on the words that a text holds and on their stems (leading
characters, for languages that compound and inflect). For every training text that
names a group, a counterfactual copy names another group of the same kind
instead, in words and stems; the fit penalises the squared change of the score between the two. The
model cannot learn that a group's name alone is toxic, and neutral mentions
stay clean.

The words are chosen by counts over the sample in Spark, the model is fitted on
the driver from at most ``labelled.SAMPLE_ROWS`` labelled rows and at most
``VOCABULARY`` words, and scoring is a map over whole texts with the weights in
a broadcast of that size.

Cases: null texts count as empty and get the score of a text without known
words; very long texts are read whole; without labels of both kinds every
score is the labels' own share (0 without any); repeated words count once, so
repeated text changes nothing; repeated rows are scored each on its own; words
equally telling are chosen in alphabetical order; a score equal to the
threshold is toxic; an empty table gives an empty result. Extra columns are ignored; labels, language,
source and id are never inputs of a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.llm.common import lean
from glossaflow.llm.labelled import labelled_sample, sigmoid

VOCABULARY = 5_000
MIN_DOCS = 5
#: Standard errors by which a word's share must differ between the classes.
LEAST_Z = 4.0
RIDGE = 0.05
PENALTY = 5.0
THRESHOLD = 0.7

#: Terms that name groups, by kind.
IDENTITY: dict[str, tuple[str, ...]] = {
    "religion": ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant", "sikh", "musulman", "chrétien", "juif", "muslimisch", "christlich", "jüdisch", "musulmán", "cristiano", "judío"),
    "religions": ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants", "sikhs", "musulmans", "chrétiens", "juifs", "muslime", "christen", "juden", "musulmanes", "cristianos", "judíos"),
    "origin": ("black", "white", "asian", "african", "european", "american", "arab", "latino", "indian", "chinese", "mexican", "turkish", "german", "french", "spanish"),
    "gender": ("woman", "man", "femme", "homme", "frau", "mann", "mujer", "hombre"),
    "genders": ("women", "men", "femmes", "hommes", "frauen", "männer", "mujeres", "hombres"),
    "orientation": ("gay", "lesbian", "bisexual", "straight", "homosexual", "heterosexual", "transgender", "queer"),
    "ability": ("disabled", "deaf", "blind", "autistic"),
    "status": ("immigrants", "refugees", "migrants", "citizens", "foreigners", "locals"),
}

#: Lengths of the stems, marked by ``*``, that stand beside whole words.
STEMS = (4, 5, 6, 7)
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(words: set[str]) -> set[str]:
    return words.union(w[:k] + "*" for k in STEMS for w in words if len(w) > k)


@dataclass
class Model:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        known = self.weights
        return float(sigmoid(np.float64(self.bias + sum(known[w] for w in sorted(features_of(words_of(text)).intersection(known))))))


def counterfactuals(words: set[str], kinds: Mapping[str, Sequence[str]] = IDENTITY) -> list[tuple[str, str]]:
    """(term, other): swaps for each term in ``words``, one per kind member
    chosen by a hash, and so spread over the kind."""
    out = []
    for terms in kinds.values():
        for term in sorted(words.intersection(terms)):
            others = [t for t in terms if t != term]
            if others:
                out.append((term, others[zlib.crc32(f"{term}|{min(words)}".encode()) % len(others)]))
    return out


def fit_words(rows: Sequence[Sequence[int]], labels: np.ndarray, swaps: Sequence[Sequence[int]], size: int, penalty: float = PENALTY, ridge: float = RIDGE, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient steps over sparse rows.

    Minimises the mean logistic loss, plus the ridge, plus ``penalty`` times
    the mean squared difference of score between a row and its counterfactual.
    A swap lists what it takes (i + 1) and what it brings (-i - 1).
    """
    n = len(labels)
    r = np.repeat(np.arange(n), [len(x) for x in rows])
    c = np.fromiter((i for x in rows for i in x), np.int64, len(r))
    k = np.repeat(np.arange(len(swaps)), [len(x) for x in swaps])
    signed = np.fromiter((i for x in swaps for i in x), np.int64, len(k))
    at, sign = np.abs(signed) - 1, np.sign(signed)
    w, bias = np.zeros(size), float(np.log(max(labels.mean(), 1e-6) / max(1 - labels.mean(), 1e-6)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        gap = sigmoid(np.bincount(r, w[c], n) + bias) - labels
        grad = np.bincount(c, gap[r], size) / n + ridge / n * w
        if len(swaps):
            change = np.bincount(k, w[at] * sign, len(swaps))
            grad += 2 * penalty / len(swaps) * np.bincount(at, sign * change[k], size)
        g = np.append(grad, gap.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w, float(bias)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", only: Column | None = None, kinds: Mapping[str, Sequence[str]] = IDENTITY, penalty: float = PENALTY) -> Model:
    sample = labelled_sample(docs, labels, label_col, id_col=id_col, text_col=text_col, only=only)
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    pos, neg = counts.get(1, 0), counts.get(0, 0)
    if not pos or not neg:
        return Model(40.0 if pos else -40.0)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(features_of(words_of(t.as_py()))) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), batch.column(1)], ["words", "label"])

    spelled = sample.select("text", "label").mapInArrow(lean(spell), "words array<string>, label int")
    seen = spelled.select(F.explode("words").alias("word"), "label").groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    share = (F.col("a") + F.col("b")) / (pos + neg)
    z = F.abs(F.col("a") / pos - F.col("b") / neg) / F.sqrt(share * (1 - share) * (1 / pos + 1 / neg) + 1e-12)
    terms = sorted(features_of({t for k in kinds.values() for t in k}))
    chosen = seen.where(((F.col("a") + F.col("b") >= MIN_DOCS) & (z >= LEAST_Z)) | F.col("word").isin(terms)).select("word", z.alias("z")).orderBy(F.desc("z"), "word").limit(VOCABULARY)
    vocabulary = sorted(r["word"] for r in chosen.collect())
    place = {w: i for i, w in enumerate(vocabulary)}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, swaps = [], []
            for text in batch.column(0):
                words = words_of(text.as_py())
                rows.append(sorted(place[w] for w in features_of(words).intersection(place)))
                before, changes = features_of(words), []
                for term, other in counterfactuals(words, kinds):
                    after = features_of(words - {term} | {other})
                    changes.append([place[w] + 1 for w in sorted((before - after).intersection(place))] + [-place[w] - 1 for w in sorted((after - before).intersection(place))])
                swaps.append(changes)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), pa.array(swaps, pa.list_(pa.list_(pa.int32()))), batch.column(1)], ["rows", "swaps", "label"])

    data = sample.select("text", "label").mapInArrow(lean(index), "rows array<int>, swaps array<array<int>>, label int").toPandas()
    order = sorted(range(len(data)), key=lambda i: (list(data["rows"][i]), data["label"][i]))  # same sums in every run
    changes = [[int(x) for x in s] for i in order for s in data["swaps"][i] if len(s)]
    w, bias = fit_words([data["rows"][i] for i in order], data["label"].to_numpy(float)[order], changes, len(place), penalty)
    return Model(bias, {word: float(w[i]) for word, i in place.items() if abs(w[i]) > 1e-3})


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text; a pure map."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.score(t.as_py()) for t in batch.column(1)], pa.float64())], [id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(lean(run), T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())]))


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, *, kinds: Mapping[str, Sequence[str]] = IDENTITY, penalty: float = PENALTY) -> DataFrame:
    """(id, held_out, score, predicted), trained on what is not held out."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, only=~held_out(F.col(id_col)), kinds=kinds, penalty=penalty)
    scored = score(docs, model, id_col, text_col)
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
