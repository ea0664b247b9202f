"""Toxicity scores from a classifier that is held to counterfactual fairness.

A text is the set of hashed features of its words (the word and its first
characters). A logistic model with an L1 penalty is fitted to a bounded
sample of labelled texts. Besides the labels it sees counterfactual pairs:
in labelled texts that mention an identity term, the term is swapped for the
others of its list, and neutral mentions are swapped likewise; the squared
change of the logit within each pair is penalised, so that a group's name
does not move a score by itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow.llm.common import id_bucket, stage

#: At most this many labelled texts of each class are fitted.
SAMPLE = 3072
#: Features are hashed to this many bits.
BITS = 20
PREFIXES = (4, 5, 6)
#: The L1 penalty, divided by the root of the number of texts in the smaller class.
L1 = 0.01
L2 = 1e-3
FAIR = 1.0
#: Standard scores below this say nothing.
SURE = 2.0
ROUNDS = 150
THRESHOLD = 0.3
#: Words without weight that a worker remembers.
CACHED_WORDS = 500_000

#: Identity terms, one list a language; a term is swapped for the others of its list.
IDENTITY = (
    ("women", "men", "muslims", "christians", "jews", "immigrants", "refugees", "gay", "lesbian", "transgender", "black", "white", "asian", "disabled", "elderly"),
    ("frauen", "männer", "muslime", "christen", "juden", "einwanderer", "flüchtlinge", "schwule", "lesben", "schwarze", "weiße", "behinderte"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés", "homosexuels", "lesbiennes", "noirs", "blancs", "handicapés"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados", "gais", "lesbianas", "negros", "blancos", "discapacitados"),
)

_WORDS = re.compile(r"[^\W\d_]+")
_MASK = (1 << BITS) - 1


def word_features(word: str) -> list[int]:
    """Hashed features of one word: itself and its first characters."""
    parts = ["=" + word] + ["^" + word[:k] for k in PREFIXES if len(word) >= k]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) & _MASK for p in parts]


def text_words(text: str | None) -> set[str]:
    return set(_WORDS.findall(text.lower())) if text else set()


@dataclass
class Model:
    bias: float
    weights: dict[int, float]


def _log_loss_gradient(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return weight * (1.0 / (1.0 + np.exp(-np.clip(z, -35, 35))) - y)


def fit(rows: list[tuple[np.ndarray, int]], pairs: list[tuple[list[int], list[int]]], share: float, fair: float = FAIR, rounds: int = ROUNDS) -> Model:
    """Accelerated proximal gradient on log loss + L1 + L2 + ``fair`` * mean squared logit change over ``pairs``.

    ``share``: the share of class 1 among all labelled rows; the sample may
    be drawn evenly by class, the bias is put right for it. One class alone
    gives a constant model.
    """
    y = np.array([t for _, t in rows], float)
    share = min(max(share, 1e-4), 1 - 1e-4)
    if not len(y) or y.min() == y.max():
        return Model(float(np.log(share / (1 - share))), {})
    seen, hits = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for f, t in rows:
        seen[f] += 1
        if t:
            hits[f] += 1
    pos = y.mean()
    # a feature counts by how surely it tells the classes apart: its standard score beyond SURE, shrunk where it is rare
    scale = np.maximum(np.abs(hits - seen * pos) / np.sqrt(seen * pos * (1 - pos) + 1.0) - SURE, 0.0)
    scale[seen < 2] = 0.0
    named = np.unique([f for a, b in pairs for f in (*a, *b)]).astype(np.int64)
    scale[named] += 1.0  # identity terms stay in the model, whatever their count
    keep = np.flatnonzero(scale)
    scale = np.minimum(scale[keep], 10.0)
    column = np.full(1 << BITS, -1, np.int32)
    column[keep] = np.arange(len(keep))

    def sparse(lists: list) -> tuple[np.ndarray, np.ndarray]:
        cols = [c[c >= 0] for c in (column[np.asarray(x, np.int64)] for x in lists)]
        return (np.concatenate(cols) if cols else np.zeros(0, np.int32)), np.repeat(np.arange(len(cols)), [len(c) for c in cols])

    cols, at = sparse([f for f, _ in rows])  # few features are left of the many
    plus, plus_at = sparse([a for a, _ in pairs])
    minus, minus_at = sparse([b for _, b in pairs])
    d = len(keep)
    even = np.where(y == 1, 0.5 / pos, 0.5 / (1 - pos)) / len(y)  # both classes weigh the same
    times = lambda w: np.bincount(at, (w * scale)[cols], len(y))
    back = lambda g: scale * np.bincount(cols, g[at], d)
    change = lambda w: np.bincount(plus_at, (w * scale)[plus], len(pairs)) - np.bincount(minus_at, (w * scale)[minus], len(pairs))
    change_back = lambda c: scale * (np.bincount(plus, c[plus_at], d) - np.bincount(minus, c[minus_at], d))

    # step: one over the largest curvature, by the power method
    def curvature(v: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        z = 0.25 * even * (times(v) + b)
        u = back(z) + L2 * v
        return (u + 2 * fair / len(pairs) * change_back(change(v)) if pairs else u), z.sum()

    v, v_b, top = np.ones(d), 1.0, 1.0
    for _ in range(20):
        top = max(np.sqrt(v @ v + v_b * v_b), 1e-12)
        v, v_b = curvature(v / top, v_b / top)
    step, l1 = 0.9 / max(np.sqrt(v @ v + v_b * v_b), 1e-12), L1 / np.sqrt(len(y) * min(pos, 1 - pos))
    w, b, t = np.zeros(d), 0.0, 1.0
    w_at, b_at = w, b
    for _ in range(rounds):
        g = _log_loss_gradient(times(w_at) + b_at, y, even)
        grad = back(g) + L2 * w_at
        if pairs:
            grad += 2 * fair / len(pairs) * change_back(change(w_at))
        new = w_at - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0.0)
        new_b = b_at - step * g.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_at, b_at = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    w = w * scale
    used = np.flatnonzero(w)
    return Model(float(b + np.log(share / (1 - share))), dict(zip(keep[used].tolist(), w[used].tolist(), strict=True)))


def counterfactuals(mentions: list[tuple[int, ...]], identity: tuple[tuple[str, ...], ...] = IDENTITY) -> list[tuple[list[int], list[int]]]:
    """Feature pairs (term, swapped term): one per labelled text and term in it, and one neutral mention of every term against the next of its list.

    ``mentions``: per labelled text the numbers of the identity terms in it
    (counted through all lists). What a text has besides its term is the same
    on both sides of a pair, so only the term's features are kept.
    """
    terms = [(i, k) for i, group in enumerate(identity) for k in range(len(group))]
    out = []
    for i, k in terms:
        group = identity[i]
        out.append((word_features(group[k]), word_features(group[(k + 1) % len(group)])))
        out.append((word_features(group[k]), []))  # a mention against none
    for text, numbers in enumerate(mentions):
        for n in numbers:
            i, k = terms[n]
            group = identity[i]
            swap = (k + 1 + text % (len(group) - 1)) % len(group)
            out.append((word_features(group[k]), word_features(group[swap])))
    return out


def training_sample(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, label) of at most ``sample`` rows of each class, those of the smallest id hash."""
    pick = lambda y: labelled.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return pick(0).unionByName(pick(1))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from (doc_id, toxic) rows of ``labels``; a null label teaches nothing, of repeated ids the highest label counts."""
    labelled = stage(labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("label")), "toxic-labels")
    share = labelled.agg(F.avg(F.col("label").cast("double"))).first()[0] or 0.0
    chosen = training_sample(labelled, sample)  # at most 2 * sample rows
    terms = {w: i for i, w in enumerate(w for group in IDENTITY for w in group)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, named = [], []
            for text in batch.column(1):
                words = text_words(text.as_py())
                features.append(sorted({f for w in words for f in word_features(w)}))
                named.append(sorted(terms[w] for w in words if w in terms))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(features, pa.list_(pa.int32())), pa.array(named, pa.list_(pa.int32()))], names=["label", "features", "named"])

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("label").cast("int").alias("label"), "text")
    got = texts.mapInArrow(run, "label int, features array<int>, named array<int>").toArrow()
    features = [x.values.to_numpy()[a:b] for x in got.column("features").chunks for a, b in zip(x.offsets.to_numpy(), x.offsets.to_numpy()[1:], strict=False)]
    rows = list(zip(features, got.column("label").to_pylist(), strict=True))
    return fit(rows, counterfactuals([tuple(n) for n in got.column("named").to_pylist()]), share)


def score_texts(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (0 or 1) appended, replacing columns of these names.

    Needs the column text only, nothing else enters a score. A null or empty
    text has the score of no features at all. Texts are read whole; equal
    texts get equal scores.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.drop("score", "predicted")
    at = base.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        plain: set[str] = set()
        loaded: dict[str, list[int]] = {}
        for batch in batches:
            z = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(at)):
                hits: set[int] = set()
                for w in text_words(text.as_py()) - plain:
                    found = loaded.get(w)
                    if found is None:
                        found = [f for f in word_features(w) if f in m.weights]
                        if found:
                            loaded[w] = found
                        else:
                            plain.add(w)
                    hits.update(found)
                z[i] = m.bias + sum(m.weights[f] for f in sorted(hits))
                if len(plain) + len(loaded) > CACHED_WORDS:
                    plain, loaded = set(), {}
            score = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
            cols = [*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "score", "predicted"])

    added = StructType().add("score", "double").add("predicted", "integer")
    return base.mapInArrow(run, StructType([*base.schema.fields, *added.fields]))


def held_out(col: str = "doc_id"):
    """Rows whose label is never learnt from: crc32 of the id as text, mod 4, is 2. A null id is not held out."""
    return F.coalesce(id_bucket(col, 4) == 2, F.lit(False))
