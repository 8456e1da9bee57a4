"""Toxicity by multiple-instance learning.

Only documents are labelled. A document is taken as toxic if at least one of its
sentences is: its score is the noisy-or of sentence scores, ``1 - prod(1 - p)``,
and each ``p`` is a logistic function of the sentence's hashed words. The weights
are fitted to document labels through the noisy-or, so that blame goes to the
sentences that explain the label. These sentences are then located.

The fit sees a bounded sample of the labelled rows (``sample`` documents, by a
hash of the id) in one task; scoring reads every whole text.

Defined results: a sentence is a stretch without ``. ! ?`` or line feed that has a
word; null and empty texts have no sentence and score 0. Without labels of both
kinds nothing can be learned and every score is 0. A document labelled both ways
counts as toxic, null ids or labels are left out of the fit. Repeated rows give
repeated results. Only the text is an input of the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractcheck.llm.words import LETTERS, LOWER, byte_table, hash_spans, map_columns, slices

SAMPLE = 16_000
BUCKETS = 1 << 20
IN_SENTENCE = ~byte_table(b".!?\n")
MIN_DOCS, MIN_CHI2, ROUNDS, RATE, DECAY = 5, 12.0, 300, 0.1, 2e-4


@dataclass
class Model:
    """Log-odds of a sentence: ``bias`` plus the weights of its words."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray

    def table(self) -> np.ndarray:
        out = np.zeros(BUCKETS, dtype=np.float64)
        out[self.buckets] = self.weights
        return out


def sentences(s) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of sentences that have a word, each word's sentence and bucket."""
    low = LOWER[s.buf]
    starts, ends = s.spans(LETTERS, low)
    first, last = s.spans(IN_SENTENCE)
    of_word = np.searchsorted(first, starts, "right") - 1
    used, owner = np.unique(of_word, return_inverse=True)
    buckets = (hash_spans(low, starts, ends) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return first[used], last[used], owner, buckets


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(texts: list[str | None], labels: np.ndarray) -> Model | None:
    """Weights that maximise the likelihood of document labels under the noisy-or."""
    n_docs = len(texts)
    if not 0 < labels.sum() < n_docs:
        return None
    sent_doc, word_sent, word_bucket, n_sent, doc = [], [], [], 0, 0
    for s in slices(pa.array(texts, pa.large_string())):
        first, _, owner, buckets = sentences(s)
        sent_doc.append(np.searchsorted(s.offsets, first, "right") - 1 + doc)
        word_sent.append(owner + n_sent)
        word_bucket.append(buckets)
        n_sent += len(first)
        doc += s.n
    sent_doc, word_sent, word_bucket = map(np.concatenate, (sent_doc, word_sent, word_bucket))
    pairs = np.unique(word_sent * BUCKETS + word_bucket)
    word_sent, word_bucket = pairs // BUCKETS, pairs % BUCKETS
    in_docs = np.unique(sent_doc[word_sent] * BUCKETS + word_bucket)
    positive = labels[in_docs // BUCKETS].astype(bool)
    pos = np.bincount((in_docs % BUCKETS)[positive], minlength=BUCKETS).astype(float)
    neg = np.bincount((in_docs % BUCKETS)[~positive], minlength=BUCKETS).astype(float)
    n_pos, n_neg = float(labels.sum()), float(n_docs - labels.sum())
    # Words tell only if they come up more often in toxic documents than chance allows.
    both = pos + neg
    expected = both * n_pos / n_docs
    chi2 = np.where(both >= MIN_DOCS, (pos - expected) ** 2 / np.maximum(expected * (1 - both / n_docs) * n_neg / n_docs, 1e-9), 0)
    chosen = np.flatnonzero((chi2 >= MIN_CHI2) & (pos > expected))
    number = np.full(BUCKETS, -1)
    number[chosen] = np.arange(len(chosen))
    use = number[word_bucket] >= 0
    told, column = np.unique(word_sent[use], return_inverse=True)
    feature = number[word_bucket[use]]
    told_doc = sent_doc[told]
    plain = np.bincount(sent_doc, minlength=n_docs) - np.bincount(told_doc, minlength=n_docs)
    weights = np.log((pos[chosen] + 0.5) / (n_pos + 1)) - np.log((neg[chosen] + 0.5) / (n_neg + 1))
    bias = float(np.log(n_pos / n_docs / max(1.0, n_sent / n_docs)))
    squares_w, square_b = np.full(len(chosen), 1e-8), 1e-8
    for _ in range(ROUNDS):
        p = _sigmoid(bias + np.bincount(column, weights[feature], minlength=len(told)))
        p0 = float(_sigmoid(np.array([bias]))[0])
        clean = np.bincount(told_doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n_docs) + plain * np.log1p(-p0)
        toxic = np.maximum(-np.expm1(clean), 1e-9)
        pull = np.where(labels > 0, -np.exp(clean) / toxic, 1.0)
        on_sentence = p * pull[told_doc]
        step_w = np.bincount(feature, on_sentence[column], minlength=len(chosen)) / n_docs + DECAY * weights
        step_b = float(on_sentence.sum() + (pull * plain).sum() * p0) / n_docs
        squares_w += step_w**2
        square_b += step_b**2
        weights = weights - RATE * step_w / np.sqrt(squares_w)
        bias -= RATE * step_b / square_b**0.5
    return Model(bias, chosen, weights)


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", usable: Column | None = None, sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` labelled documents, those with the smallest hashes of ids."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.where(usable) if usable is not None else known
    known = known.groupBy(F.col(id_col).alias("i")).agg(F.max(label_col).alias("y")).orderBy(F.xxhash64("i"), "i").limit(sample)
    rows = df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(known), "i")
    rows = rows.groupBy("i").agg(F.min("t").alias("t"), F.max("y").cast("int").alias("y")).repartition(1).sortWithinPartitions("i")

    def run(batches):
        texts, ys = [], []
        for batch in batches:
            texts += batch.column(1).to_pylist()
            ys += batch.column(2).to_pylist()
        model = fit(texts, np.array(ys, dtype=np.int64)) if texts else None
        if model is not None:
            buckets = np.concatenate(([-1], model.buckets))
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(np.concatenate(([model.bias], model.weights)))], names=["bucket", "weight"])

    found = sorted(rows.mapInArrow(run, "bucket bigint, weight double").collect())
    if not found:
        return None
    return Model(found[0][1], np.array([r[0] for r in found[1:]], dtype=np.int64), np.array([r[1] for r in found[1:]]))


def toxicity(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.5) -> DataFrame:
    """Per input row: id, ``score`` and ``sentences`` with a score of ``at_least``.

    ``sentences`` holds code point positions, end exclusive, and scores.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    tables: dict[str, np.ndarray] = {}

    def make(ids, texts):
        own = shared.value
        if own is not None and "w" not in tables:
            tables["w"] = own.table()
        scores, spans = [], []
        for s in slices(texts):
            if own is None:
                scores.append(np.zeros(s.n))
                spans += [[]] * s.n
                continue
            first, last, owner, buckets = sentences(s)
            pairs = np.unique(owner * BUCKETS + buckets) if len(owner) else owner
            weight = tables["w"][pairs % BUCKETS]
            told = weight != 0
            p = _sigmoid(own.bias + np.bincount(pairs[told] // BUCKETS, weight[told], minlength=len(first)))
            text = np.searchsorted(s.offsets, first, "right") - 1
            scores.append(-np.expm1(np.bincount(text, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=s.n)))
            here: list[list] = [[] for _ in range(s.n)]
            worst = np.flatnonzero(p >= at_least)
            if len(worst):
                lead = np.concatenate(([0], np.cumsum((s.buf & 0xC0) != 0x80)))
                for k in worst:
                    base = lead[s.offsets[text[k]]]
                    here[text[k]].append({"start": int(lead[first[k]] - base), "end": int(lead[last[k]] - base), "score": float(p[k])})
            spans += here
        return {id_col: ids, "score": pa.array(np.concatenate(scores)), "sentences": pa.array(spans, kind)}

    id_kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df, [id_col, text_col], make, f"`{id_col}` {id_kind}, score double, sentences array<struct<start:bigint,end:bigint,score:double>>")
