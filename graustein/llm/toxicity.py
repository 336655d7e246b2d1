"""Toxicity by cumulative-link ordinal regression on sparse word features.

The labels say toxic or not; severity grades order the toxic ones by how much they hold of the
words that mark toxic texts (z of ``MARK_Z``, or half the best): 0 not toxic, 1 toxic, 2 toxic with more of these words than the
median of the toxic texts that have any. All thresholds share one weight vector w:
P(grade <= k) = sigmoid(theta_k - w.x), theta_0 < theta_1; the expected severity is the sum of
P(grade >= k) over k = 1, 2, and a document is rejected when P(grade >= 1) reaches ``reject``.

Features are the hashed lower-case words (runs of ASCII letters and digits and bytes over
127) of whole texts, x = log(1 + count). The model is fitted on a bounded sample: the
``TRAIN_ROWS`` labelled documents with the least hashed ids (all of them if there are fewer).
The ``FEATURES`` words with the highest z-score of their share of toxic documents are taken, from
``MIN_Z`` on (a word of all toxic documents alone has the root of the number of the others, so four
of these suffice at any number of toxic ones). Words
below ``SURE_Z`` (or the best word's z, where that is less) may be noise and have a penalty that
grows with the fourth power of what they lack. At most ``FEATURES`` words and ``TRAIN_ROWS`` sparse
rows reach the driver. Every document is scored.

Defined cases: null text counts as empty; several labels of one document count as toxic if one
says so; a label without ``toxic`` is ignored; without labels of both classes, or
without a word that tells them apart (as with fewer than four labels that aren't toxic), nothing is
rejected; a handful of labels makes a weak model; a null id stays null; no rows give no rows. Other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.llm import base
from graustein.llm.base import map_arrow, stored

TRAIN_ROWS = 20_000
FEATURES = 1000
MIN_Z, MIN_DOCS = 2.0, 4  # in all toxic documents, where there are fewer
MARK_Z, SURE_Z = 5.0, 6.0
GRADES = 3

APART = np.ones(256, bool)
APART[128:] = False
for _range in (b"09", b"AZ", b"az"):
    APART[_range[0]:_range[1] + 1] = False


def words(column: pa.Array):
    """(first row, end row, text number and hash of every word) of slices of the rows."""
    for i, j, data, offsets in base.slices(column):
        starts, ends, doc = base.word_spans(data, offsets, APART)
        yield i, j, doc, base.span_hashes(base.LOWER[data], starts, ends).view(np.int64)


def _distinct_words(batches):
    """(toxic, word) of every distinct word of every text."""
    for batch in batches:
        toxic = batch.column(0).to_numpy() > 0
        for i, _, doc, h in words(batch.column(1)):
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
            yield pa.record_batch([pa.array(toxic[i + doc[new]].astype(np.int32)), pa.array(h[new])], ["toxic", "word"])


def _known_counts(known: np.ndarray):
    """(text number, feature, count) of the words in ``known`` (sorted)."""
    def of(doc: np.ndarray, h: np.ndarray):
        at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
        hit = known[at] == h if len(known) else np.zeros(len(h), bool)
        pair, count = np.unique(doc[hit] * max(len(known), 1) + at[hit], return_counts=True)
        return pair // max(len(known), 1), pair % max(len(known), 1), count
    return of


def _sparse_rows(known: np.ndarray):
    counts = _known_counts(known)

    def run(batches):
        for batch in batches:
            for i, j, doc, h in words(batch.column(1)):
                text, feature, count = counts(doc, h)
                cut = pa.array(np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32))
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(cut, pa.array(feature.astype(np.int32))),
                                       pa.ListArray.from_arrays(cut, pa.array(count.astype(np.int32)))], ["toxic", "features", "counts"])
    return run


def sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit(grade: np.ndarray, row: np.ndarray, feature: np.ndarray, x: np.ndarray, n_features: int,
        penalty: float = 1e-3, steps: int = 400, weak: np.ndarray | float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) that maximise the penalised likelihood, by Adam on all rows; ``weak``
    multiplies the penalty of a feature."""
    n, eps = len(grade), 1e-9
    share = np.array([(grade <= k).mean() for k in range(GRADES - 1)]).clip(1e-3, 1 - 1e-3)
    theta = np.maximum.accumulate(np.log(share / (1 - share)) + np.arange(GRADES - 1) * 1e-2)
    p = np.concatenate([np.zeros(n_features), theta[:1], np.log(np.diff(theta) + 1e-2)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        w, gaps = p[:n_features], np.exp(p[n_features + 1:])
        theta = p[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(row, weights=w[feature] * x, minlength=n)
        edge = np.concatenate([np.zeros((n, 1)), sigmoid(theta - score[:, None]), np.ones((n, 1))], axis=1)
        slope = edge * (1 - edge)  # of P(grade <= k) in theta_k; 0 at both ends
        rows = np.arange(n)
        likely = edge[rows, grade + 1] - edge[rows, grade] + eps
        up, down = slope[rows, grade + 1] / likely, slope[rows, grade] / likely
        by_theta = np.array([up[grade == k].sum() - down[grade == k + 1].sum() for k in range(GRADES - 1)]) / n
        by_score = (down - up) / n
        g = np.concatenate([np.bincount(feature, weights=by_score[row] * x, minlength=n_features) - penalty * weak * w / np.sqrt(n),
                            [by_theta.sum()], [by_theta[k:].sum() * gaps[k - 1] for k in range(1, GRADES - 1)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-12)
    return p[:n_features], p[n_features] + np.concatenate([[0], np.cumsum(np.exp(p[n_features + 1:]))])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known words, weights, thresholds); the words are hashes in ascending order."""
    judged = labels.filter("toxic IS NOT NULL").groupBy(F.col("doc_id").alias("key")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    picked = judged.orderBy(F.xxhash64("key"), "key").limit(train_rows)  # at most train_rows small rows: broadcast
    texts = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sample = stored(texts.join(F.broadcast(picked), "key").select("toxic", "text"), "labelled")
    total = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = total["n"], total["toxic"] or 0
    none = np.zeros(0, np.int64), np.zeros(0), np.array([30.0, 31.0])
    if not 0 < toxic < n:
        return none
    share = toxic / n
    seen = map_arrow(sample, _distinct_words, "toxic int, word long").groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t"))
    z = (F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    chosen = seen.filter(F.col("n") >= min(MIN_DOCS, toxic)).withColumn("z", z).filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "word").limit(FEATURES)
    words_z = sorted((r["word"], r["z"]) for r in chosen.select("word", "z").collect())
    if not words_z:
        return none
    known, z_of = np.array([w for w, _ in words_z], np.int64), np.array([v for _, v in words_z])
    marks = z_of >= min(MARK_Z, z_of.max() / 2)
    weak = np.maximum(1, min(SURE_Z, z_of.max()) / z_of) ** 4
    rows = map_arrow(sample, _sparse_rows(known), "toxic int, features array<int>, counts array<int>").collect()
    rows.sort(key=lambda r: (r["toxic"], r["features"], r["counts"]))  # the same sums whatever the order of the tasks
    toxic, held = np.array([r["toxic"] for r in rows]), np.array([sum(c for f, c in zip(r["features"], r["counts"]) if marks[f]) for r in rows])
    some = held[(toxic > 0) & (held > 0)]
    grade = toxic + toxic * (held > (np.median(some) if len(some) else 0))
    row = np.repeat(np.arange(len(rows)), [len(r["features"]) for r in rows])
    feature = np.array([f for r in rows for f in r["features"]], np.int64)
    x = np.log1p(np.array([c for r in rows for c in r["counts"]], float))
    return known, *fit(grade, row, feature, x, len(known), weak=weak)


def _score(known: np.ndarray, weights: np.ndarray, theta: np.ndarray):
    counts = _known_counts(known)

    def run(batches):
        for batch in batches:
            for i, j, doc, h in words(batch.column(1)):
                text, feature, count = counts(doc, h)
                score = np.bincount(text, weights=weights[feature] * np.log1p(count), minlength=j - i) if len(text) else np.zeros(j - i)
                above = 1 - sigmoid(theta - score[:, None])  # P(grade >= 1), P(grade >= 2)
                each = np.concatenate([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]], axis=1)
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(above.sum(axis=1)), pa.array(above[:, 0]),
                                       pa.array(each.argmax(axis=1).astype(np.int32))], ["id", "severity", "p_toxic", "grade"])
    return run


def scored(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", reject: float = 0.5) -> DataFrame:
    """(id, severity, p_toxic, grade, rejected) of every row."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {texts.schema['id'].dataType.simpleString()}, severity double, p_toxic double, grade int"
    return map_arrow(texts, _score(*model), schema).withColumn("rejected", F.col("p_toxic") >= reject)


def _keep(model, reject: float, text_at: int):
    known, weights, theta = model
    score = _score(known, weights, theta)

    def run(batches):
        for batch in batches:
            asked = pa.record_batch([batch.column(text_at), batch.column(text_at)], ["id", "text"])
            p = np.concatenate([b.column(2).to_numpy() for b in score([asked])]) if batch.num_rows else np.zeros(0)
            yield batch.filter(pa.array(p < reject))
    return run


def kept(docs: DataFrame, model, text_col: str = "text", reject: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with all their columns."""
    schema = docs.schema
    return map_arrow(docs, _keep(model, reject, docs.columns.index(text_col)), schema)
