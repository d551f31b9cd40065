"""Toxicity classifier with counterfactual regularisation.

A linear model over the distinct words of a text and their beginnings, fitted
on labelled texts. Beside the logistic loss it pays for unfairness: in labelled
texts that mention a group of people, the group's name is swapped for another
one of the same kind and the squared change of the score is added to the loss.
What a mention alone contributes is thereby held equal across groups and near
that of the neutral word, so plain mentions are not taken for abuse.

Training uses a bounded sample (``PER_CLASS`` texts of each label, whole texts),
whose features are made in tasks; fitting it is a small job on the driver. All
texts are scored in tasks with the model's few thousand weights.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.texts import OWN, require

#: Labelled texts of each class that the model is fitted on, in expectation.
PER_CLASS = 4_000
FOLDS = 5
FEATURE_BITS = 20
SPARSITY = 3e-5
FAIRNESS = 5.0
ITERATIONS = 300
STEP = 0.5
#: A feature takes part if it leans to one class by so many standard deviations.
LEAST_LEAN, LEAST_TEXTS = 2.5, 3
KEPT_WORDS = 500_000

# Names of groups of people, and a neutral word for each kind.
IDENTITY_TERMS = [
    ["people", "women", "men", "girls", "boys"],
    ["person", "woman", "man", "girl", "boy", "female", "male"],
    ["believers", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["religious", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["local", "black", "white", "asian", "african", "arab", "latino", "mexican", "chinese", "indian"],
    ["adults", "gays", "lesbians", "homosexuals", "heterosexuals"],
    ["adult", "gay", "lesbian", "bisexual", "homosexual", "heterosexual", "queer", "transgender", "straight"],
    ["residents", "immigrants", "refugees", "foreigners", "natives"],
    ["personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes"],
    ["personnes", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés"],
    ["leute", "frauen", "männer", "muslime", "christen", "juden", "einwanderer"],
]
_GROUP = {term: group for group in IDENTITY_TERMS for term in group}
_WORD = re.compile(r"\w+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[int]:
    """Hashed features of a word: itself and its first four to eight letters."""
    mask = (1 << FEATURE_BITS) - 1
    parts = ["w " + word, *[f"{n} {word[:n]}" for n in range(4, 9) if len(word) >= n]]
    return [zlib.crc32(f.encode()) & mask for f in parts]


def features_in(words: set[str]) -> list[int]:
    """Distinct features of a text."""
    return sorted({f for w in words for f in features_of(w)})


def swapped(words: set[str], shift: int) -> set[str] | None:
    """The words with each group's name replaced by the name ``shift`` places
    on in its list; None for texts without such names."""
    if not any(w in _GROUP for w in words):
        return None
    turn = lambda w, g: g[(g.index(w) + shift) % len(g)]
    return {turn(w, _GROUP[w]) if w in _GROUP else w for w in words}


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text modulo 5; fold 0 is held out, as are null ids."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS, F.lit(0))


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[int, float]

    def score_words(self, words: set[str], known: dict[str, tuple]) -> float:
        """``known`` keeps the weighted features of words met before."""
        present: set[int] = set()
        for w in words:
            s = known.get(w)
            if s is None:
                if len(known) > KEPT_WORDS:
                    known.clear()
                s = known[w] = tuple(f for f in features_of(w) if f in self.weights)
            if s:
                present.update(s)
        total = self.bias + sum(self.weights[f] for f in sorted(present))
        return 1.0 / (1.0 + math.exp(-min(max(total, -60.0), 60.0)))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """toxic, weight, features (of the text) and changes (feature, difference) by
    swapping names, of a hashed sample of the labelled rows outside fold 0.

    Several labels of one id count by their majority; null labels do not count.
    """
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg((F.avg(F.col("toxic").cast("double")) >= 0.5).cast("int").alias("toxic"))
        .where(fold() != 0)
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = lambda c: min(1.0, per_class / max(counts.get(c, 0), 1))
    chosen = known.where(part < F.when(F.col("toxic") == 1, F.lit(share(1))).otherwise(F.lit(share(0))))
    weight = F.when(F.col("toxic") == 1, F.lit(1 / share(1))).otherwise(F.lit(1 / share(0)))
    # at most about 2 * per_class ids
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", weight.alias("weight"), "text")
    out = pa.schema(
        [("toxic", pa.int32()), ("weight", pa.float64())]
        + [(c, pa.list_(pa.int32())) for c in ("features", "changed", "change")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], []]
            for text in batch.column(2):
                words = words_of(text.as_py() or "")
                features = features_in(words)
                changed, change = [], []
                other = swapped(words, 1 + len(words) % 3)
                if other is not None:
                    mine, theirs = set(features), set(features_in(other))
                    changed = sorted(mine ^ theirs)
                    change = [1 if f in mine else -1 for f in changed]
                for col, v in zip(cols, (features, changed, change)):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *[pa.array(c, pa.list_(pa.int32())) for c in cols]], schema=out
            )

    return rows.mapInArrow(
        run, "toxic int, weight double, features array<int>, changed array<int>, change array<int>"
    )


def fit(rows: DataFrame, sparsity: float = SPARSITY, fairness: float = FAIRNESS) -> Model:
    """Fit the weights by proximal steps, scaled for each feature by its past
    gradients: logistic loss, L1, and the squared change of the score under
    swaps. Without labelled texts, or with one class only, the model is constant."""
    data = rows.toArrow()
    y = data["toxic"].to_numpy().astype(np.float64)
    c = data["weight"].to_numpy().astype(np.float64)
    if not len(y):
        return Model(-5.0, {})
    c = c / c.sum()
    base = float(np.clip((c * y).sum(), 1e-3, 1 - 1e-3))
    bias = float(np.log(base / (1 - base)))
    if len(set(y.tolist())) < 2:
        return Model(bias, {})
    flat, owner = _flat(data["features"])
    size = 1 << FEATURE_BITS
    # Only features whose share of toxic texts differs clearly from the average.
    spread = np.sqrt((c**2).sum() * base * (1 - base))
    mass, toxic, seen = (_sums(flat, owner, v, size) for v in (c, c * y, np.ones(len(y))))
    lean = np.abs(toxic - mass * base) / (spread * np.sqrt(np.maximum(mass, 1e-12)))
    kept = np.flatnonzero((lean > LEAST_LEAN) & (seen >= LEAST_TEXTS))
    place = np.full(size, -1)
    place[kept] = np.arange(len(kept))
    flat, owner = _only(place, flat, owner)
    changed, pair = _flat(data["changed"])
    change = _flat(data["change"])[0].astype(np.float64)
    inside = place[changed] >= 0
    changed, pair, change = place[changed[inside]], pair[inside], change[inside]

    w, past, past_bias = np.zeros(len(kept)), np.full(len(kept), 1e-12), 1e-12
    for _ in range(ITERATIONS):
        z = np.bincount(owner, weights=w[flat], minlength=len(y)) + bias
        r = c * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y)
        g = np.bincount(flat, weights=r[owner], minlength=len(kept))
        if len(changed):
            d = np.bincount(pair, weights=w[changed] * change, minlength=len(y)) * c
            g = g + 2 * fairness * np.bincount(changed, weights=d[pair] * change, minlength=len(kept))
        past += g * g
        past_bias += r.sum() ** 2
        step = STEP / np.sqrt(past)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * sparsity, 0)
        bias -= float(STEP * r.sum() / np.sqrt(past_bias))
    return Model(bias, {int(kept[i]): float(w[i]) for i in np.flatnonzero(w)})


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row each belongs to."""
    whole = lists.combine_chunks()
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks) if whole.num_chunks else pa.array([], lists.type)
    sizes = np.diff(whole.offsets.to_numpy())
    return whole.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)


def _sums(flat: np.ndarray, owner: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """Per feature the weights of the rows that have it, a piece at a time."""
    out, step = np.zeros(size), 1 << 22
    for i in range(0, len(flat), step):
        out += np.bincount(flat[i : i + step], weights=weights[owner[i : i + step]], minlength=size)
    return out


def _only(place: np.ndarray, flat: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = place[flat] >= 0
    return place[flat[inside]], owner[inside]


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    require(docs, "doc_id", "text")
    require(labels, "doc_id", "toxic")
    return fit(training_rows(docs, labels, per_class))


def with_scores(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of each whole text, a pure function of
    the text; null and empty texts get the score of no words. A column of the
    same name is replaced."""
    require(docs, text)
    docs = docs.drop(name) if name != text else docs
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            scores = [model.score_words(words_of(t.as_py() or ""), known) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score and predicted."""
    scored = with_scores(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        (fold() == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` that are not predicted to be toxic, columns as they are."""
    name = OWN + "score"
    return with_scores(docs, model, name=name).where(F.col(name) < 0.5).drop(name)
