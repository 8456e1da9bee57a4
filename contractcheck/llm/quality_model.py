"""Quality classifier from weak labels.

Heuristic labellers look at every text and vote good, bad or not at all. Nobody
tells which labellers are right: expectation-maximisation estimates, from the
counts of vote patterns over all documents, how often each labeller votes what on
good and on bad texts, and so the probability that a text with a pattern is good.
These posterior labels train a linear scorer over hashed features (words, word
shapes, levels of measurements), which gives the decision.

The vote patterns of all documents are counted; there are at most
``3 ** len(LABELLERS)`` of them. The scorer is fitted on a bounded sample of
``sample`` documents, by a hash of id and text, in one task.

Defined results: null and empty texts have no votes; their posterior and score
are 0 and they are rejected. An empty table gives no rows. Repeated rows give
repeated results; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractcheck.llm.rules import measure_slice
from contractcheck.llm.words import LETTERS, LOWER, NOT_BLANK, filter_rows, hash_spans, map_columns, mix, slices

SAMPLE = 3_000
BUCKETS = 1 << 17
ROUNDS, RATE, DECAY = 80, 0.3, 1e-5

#: Labellers: (measurement, at most this: good, at least this: bad); between them no vote.
#: Bounds the other way round mean: at least the first is good, at most the second is bad.
LABELLERS: tuple[tuple[str, float, float], ...] = (
    ("symbols", 0.05, 0.25),
    ("repeated", 0.15, 0.45),
    ("duplicate_lines", 0.0, 0.3),
    ("upper", 0.2, 0.5),
    ("bare", 0.02, 0.15),
    ("variety", 0.4, 0.2),
    ("word_length", 9.0, 14.0),
    ("length", 20.0, 2.0),
)


def shares(s) -> tuple[dict[str, np.ndarray], tuple]:
    """Measurements of a slice as shares, and its words."""
    m = measure_slice(s)
    starts, ends = s.spans(NOT_BLANK)
    at = s.per_text(starts)
    n = np.maximum(np.diff(at), 1)
    low = LOWER[s.buf]
    hashes = hash_spans(low, starts, ends)
    letters = np.concatenate(([0], np.cumsum(LETTERS[low])))
    bare = np.concatenate(([0], np.cumsum(letters[ends] == letters[starts])))
    owner = np.repeat(np.arange(s.n), np.diff(at))
    distinct = np.unique(hashes ^ mix(owner.astype(np.uint64) + np.uint64(1)), return_index=True)[1]
    # Variety falls with length by itself; the measure is taken against the square root beyond 400 words.
    variety = np.bincount(owner[distinct], minlength=s.n) / np.where(n > 400, 20 * np.sqrt(n), n)
    return {
        "symbols": m["n_symbols"] / n,
        "repeated": m["n_repeat_words"] / n,
        "duplicate_lines": m["n_dup_lines"] / np.maximum(m["n_lines"], 1),
        "upper": m["n_upper"] / np.maximum(m["n_letters"], 1),
        "bare": (bare[at[1:]] - bare[at[:-1]]) / n,
        "variety": variety,
        "word_length": m["word_chars"] / n,
        "length": m["n_words"].astype(float),
    }, (s, low, starts, ends, hashes, at)


def votes(measured: dict[str, np.ndarray]) -> np.ndarray:
    """Texts by labellers: 2 good, 1 bad, 0 no vote."""
    out = []
    for name, good, bad in LABELLERS:
        x = measured[name]
        up = good < bad
        out.append(np.where(x <= good if up else x >= good, 2, np.where(x >= bad if up else x <= bad, 1, 0)))
    return np.stack(out, axis=1)


def pattern(voted: np.ndarray) -> np.ndarray:
    return voted @ (3 ** np.arange(len(LABELLERS)))


#: Belief about every labeller before any count, by class (bad, good) and vote (none, bad, good): a vote for
#: bad is rarely wrong, but each labeller knows only some kinds of bad texts and takes the others for good.
BELIEF = ((0.1, 0.2, 0.7), (0.09, 0.01, 0.9))
#: Weight of the belief, as a share of all documents.
BELIEF_SHARE, GOOD_SHARE = 0.1, 0.8
#: A vote for bad is wrong on at most this share of good texts. Bad texts are of several kinds that different
#: labellers know; without the bound, the smaller kinds would be taken for a habit of good texts.
FALSE_ALARMS = 0.002


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, belief: float = BELIEF_SHARE, false_alarms: float = FALSE_ALARMS) -> tuple[np.ndarray, np.ndarray, float]:
    """(P(good) per pattern, P(vote | class) by labeller, class and vote, share of good).

    Starts from :data:`BELIEF`, which also fixes what "good" means, and keeps it
    as a Dirichlet prior; the M-step holds each labeller's share of false alarms
    below ``false_alarms``.
    """
    voted = patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    prior = np.broadcast_to(np.array(BELIEF), (len(LABELLERS), 2, 3))
    table, share, good = prior.copy(), GOOD_SHARE, np.full(len(patterns), 0.5)
    for _ in range(rounds):
        log = np.log(table)
        odds = np.log(share / (1 - share)) + sum(log[j, 1, voted[:, j]] - log[j, 0, voted[:, j]] for j in range(len(LABELLERS)))
        fresh = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        moved, good = np.abs(fresh - good).max(), fresh
        if moved < 1e-9:
            break
        table = prior * (belief * counts.sum() / 2 + 1)
        for y, weight in enumerate((counts * (1 - good), counts * good)):
            for v in range(3):
                table[:, y, v] += ((voted == v) * weight[:, None]).sum(axis=0)
        table /= table.sum(axis=2, keepdims=True)
        alarm = np.minimum(table[:, 1, 1], false_alarms)
        table[:, 1, [0, 2]] *= ((1 - alarm) / (1 - table[:, 1, 1]))[:, None]
        table[:, 1, 1] = alarm
        share = float(np.clip((counts * good).sum() / counts.sum(), 0.001, 0.999))
    return good, table, share


def features(measured: dict[str, np.ndarray], words: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of all features: hashed words, shapes and levels."""
    s, low, starts, ends, hashes, at = words
    n = np.diff(at)
    owner = np.repeat(np.arange(s.n), n)
    value = 1.0 / np.maximum(n, 1)[owner]
    kind = np.zeros(256, dtype=np.int64)
    kind[48:58], kind[65:91], kind[97:123], kind[128:] = 1, 2, 3, 3
    kind[33:48] += 4
    shape = kind[s.buf[starts]] * 64 + kind[s.buf[ends - 1]] * 8 + np.minimum(np.log2(ends - starts).astype(np.int64), 7)
    out_text, out_bucket, out_value = [owner, owner], [hashes, mix(shape.astype(np.uint64) + np.uint64(1 << 32))], [value, 4 * value]
    every = np.arange(s.n)
    for j, (name, _, _) in enumerate(LABELLERS):
        x = measured[name]
        level = np.digitize(x, (1, 2, 5, 10, 20, 50, 100, 1000)) if name == "length" else np.digitize(x, (0.001, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7, 2, 5, 9, 14))
        out_text.append(every)
        out_bucket.append(mix((level + 64 * j).astype(np.uint64) + np.uint64(1 << 33)))
        out_value.append(np.ones(s.n))
    buckets = (np.concatenate(out_bucket) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return np.concatenate(out_text), buckets, np.concatenate(out_value)


def fit(texts: list[str | None], posterior: np.ndarray) -> tuple[float, np.ndarray]:
    """Bias and weights of the linear scorer, by gradient steps of adaptive size."""
    text, bucket, value, target, done = [], [], [], [], 0
    for s in slices(pa.array(texts, pa.large_string())):
        measured, words = shares(s)
        t, b, v = features(measured, words)
        text.append(t + done)
        bucket.append(b.astype(np.int32))
        value.append(v)
        target.append(posterior[pattern(votes(measured))])
        done += s.n
    text, bucket, value, target = map(np.concatenate, (text, bucket, value, target))
    order = np.argsort(text, kind="stable")
    text, bucket, value = text[order].astype(np.int32), bucket[order], value[order]
    weights, bias = np.zeros(BUCKETS), 0.0
    squares, square = np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(text, weights[bucket] * value, minlength=done), -30, 30)))
        off = (p - target) / done
        step = np.bincount(bucket, off[text] * value, minlength=BUCKETS) + DECAY * weights
        squares += step**2
        square += float(off.sum()) ** 2
        weights -= RATE * step / np.sqrt(squares)
        bias -= RATE * float(off.sum()) / square**0.5
    return bias, weights


@dataclass
class Model:
    posterior: np.ndarray
    bias: float
    weights: np.ndarray

    def judge(self, s) -> tuple[np.ndarray, np.ndarray]:
        """(posterior, score) of the texts of a slice."""
        measured, words = shares(s)
        text, bucket, value = features(measured, words)
        some = measured["length"] > 0
        z = self.bias + np.bincount(text, self.weights[bucket] * value, minlength=s.n)
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return np.where(some, self.posterior[pattern(votes(measured))], 0.0), np.where(some, score, 0.0)


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model | None:
    """Estimate labellers on all documents and fit the scorer on a sample; None for an empty table."""

    def vote(texts):
        found = []
        for s in slices(texts):
            measured, _ = shares(s)
            found.append(np.where(measured["length"] > 0, pattern(votes(measured)), -1))
        return {"pattern": pa.array(np.concatenate(found), pa.int32())}

    counted = map_columns(df, [text_col], vote, "pattern int").where("pattern >= 0").groupBy("pattern").count().orderBy("pattern").collect()
    if not counted:
        return None
    patterns = np.array([r[0] for r in counted])
    posterior = np.full(3 ** len(LABELLERS), 0.5)
    posterior[patterns] = expectation_maximisation(patterns, np.array([r[1] for r in counted], dtype=float))[0]
    hashed = df.where(F.length(text_col) > 0).select(F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).alias("t"))
    bound = hashed.select("h").distinct().orderBy("h").limit(sample)
    rows = hashed.join(F.broadcast(bound), "h").groupBy("h").agg(F.min("t").alias("t")).repartition(1).sortWithinPartitions("h")

    def run(batches):
        texts = [t for batch in batches for t in batch.column(1).to_pylist()]
        if texts:
            bias, weights = fit(texts, posterior)
            used = np.flatnonzero(weights)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1], used)), pa.int64()), pa.array(np.concatenate(([bias], weights[used])))], names=["bucket", "weight"])

    found = sorted(rows.mapInArrow(run, "bucket bigint, weight double").collect())
    if not found:
        return None
    weights = np.zeros(BUCKETS)
    weights[[r[0] for r in found[1:]]] = [r[1] for r in found[1:]]
    return Model(posterior, found[0][1], weights)


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """Per input row: id, ``posterior`` of the labellers, ``score`` of the scorer, ``keep``."""
    shared = df.sparkSession.sparkContext.broadcast(train(df, id_col, text_col, sample))

    def make(ids, texts):
        own = shared.value
        parts = [own.judge(s) if own else (np.zeros(s.n), np.zeros(s.n)) for s in slices(texts)]
        return {id_col: ids, "posterior": pa.array(np.concatenate([p for p, _ in parts])), "score": pa.array(np.concatenate([x for _, x in parts]))}

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df, [id_col, text_col], make, f"`{id_col}` {kind}, posterior double, score double").withColumn("keep", F.col("score") >= at_least)


def kept(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``df`` that the classifier keeps, with all their columns."""
    shared = df.sparkSession.sparkContext.broadcast(train(df, id_col, text_col, sample))
    return filter_rows(df, text_col, lambda s: shared.value.judge(s)[1] >= at_least if shared.value else np.zeros(s.n, dtype=bool))
