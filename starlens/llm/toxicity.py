"""Toxicity: a bidirectional gated recurrent network over windows of words, in numpy.

A word (a run of letters in lower case) enters as the sum of a vector for the word and
the mean of vectors for its character n-grams, those at its start apart from others;
both come from hashed tables. A gated recurrent layer reads each window of ``WINDOW``
words forwards, another backwards; attention weighs their states, and the weighed sum
gives a logit. Windows start every ``STRIDE`` words, so they overlap, and all windows of
a text are scored. A document's score is that of its worst window.

Training takes a bounded sample of labelled documents (``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN``), whole. A toxic document's label holds for some window only, so words
and word beginnings that tell the sample's classes apart choose the windows to learn
from. A shift of the logit puts the best split of the sample at ``THRESHOLD``. A network
knows by heart what it was trained on, so that split is found on logits from ``FOLDS``
networks, each of which scores the part of the sample that it didn't see. Equal texts
are in the same part. A split that takes more clean texts than toxic ones isn't looked
at, so labels that can't be learnt reject next to nothing.

Defined results: a text that is null or has no letters scores 0, and so does every text
if the labels lack one of the classes. A label counts if it is 0 or 1 and belongs to a
document that isn't held out; several labels of one id count as toxic if any is. Rows
are scored one by one, repeated or not; a row without an id is held out. Other columns
pass through ``score_documents`` as they are.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from starlens.llm.arrays import Spans, grams, letter_words, mix, slices

WINDOW, STRIDE = 32, 24
BUCKETS = 1 << 14
WIDTH = STATE = 8
SAMPLE_TOXIC, SAMPLE_CLEAN = 700, 1100
#: Windows of the sample to learn from.
TRAIN_TOXIC, TRAIN_CLEAN = 3000, 5000
EPOCHS, BATCH, RATE = 12, 128, 0.01
#: Spread of the tables before training: small, as words that it never meets keep their vectors.
TABLE_SPREAD = 0.01
FOLDS = 3
LEAST_PRECISION = 0.5
THRESHOLD = 0.3
SEED = 20


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(True))


@dataclass
class Words:
    """Distinct words as rows of the tables: word bucket, n-gram buckets and their owners."""

    bucket: np.ndarray
    gram: np.ndarray
    owner: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(spans: Spans, starts: np.ndarray, ends: np.ndarray) -> Words:
        bucket = (spans.hash(starts, ends, 1) % np.uint64(BUCKETS)).astype(np.int64)
        keys, owners = [], []
        for n in (3, 4, 5):
            at, owner = grams(starts, ends, n)
            keys.append(spans.hash(at, at + n, 2) + (at == starts[owner]).astype(np.uint64))
            owners.append(owner)
        owner = np.concatenate(owners)
        gram = (mix(np.concatenate(keys)) % np.uint64(BUCKETS)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        return Words(bucket, gram[order], owner[order], np.bincount(owner, minlength=len(starts)))

    def vectors(self, words: np.ndarray, characters: np.ndarray) -> np.ndarray:
        out = words[self.bucket].copy()
        some = np.flatnonzero(self.counts)
        if len(some):
            first = (np.cumsum(self.counts) - self.counts)[some]
            out[some] += np.add.reduceat(characters[self.gram], first, axis=0) / self.counts[some, None]
        return out

    def take(self, which: np.ndarray) -> Words:
        counts = self.counts[which]
        first = (np.cumsum(self.counts) - self.counts)[which]
        owner = np.repeat(np.arange(len(which)), counts)
        at = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner] + first[owner]
        return Words(self.bucket[which], self.gram[at], owner, counts)


def _sum_rows(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows with the same index, as a table of ``size`` rows."""
    out = np.zeros((size, rows.shape[1]), np.float32)
    if len(index):
        order = np.argsort(index, kind="stable")
        held = index[order]
        first = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        out[held[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters by name, the forward pass, and its gradient."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, by=0.3: (rng.standard_normal(shape) * by).astype(np.float32)
        self.p = {
            "words": draw(BUCKETS, WIDTH, by=TABLE_SPREAD), "characters": draw(BUCKETS, WIDTH, by=TABLE_SPREAD),
            "in0": draw(WIDTH, 3 * STATE), "in1": draw(WIDTH, 3 * STATE),
            "bias0": np.zeros(3 * STATE, np.float32), "bias1": np.zeros(3 * STATE, np.float32),
            "back0": draw(STATE, 3 * STATE), "back1": draw(STATE, 3 * STATE),
            "attend": draw(2 * STATE, STATE), "weigh": draw(STATE),
            "out": draw(2 * STATE), "shift": np.zeros(1, np.float32),
        }

    def _layer(self, k: int, inputs: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool):
        """States of one direction: inputs are projected word vectors, index is (windows, steps)."""
        n, steps = index.shape
        back, s = self.p[f"back{k}"], STATE
        h = np.zeros((n, s), np.float32)
        states, held = np.zeros((steps, n, s), np.float32), {}
        for t in range(steps) if k == 0 else range(steps - 1, -1, -1):
            x, u = inputs[index[:, t]], h @ back
            gates = _sigmoid(x[:, : 2 * s] + u[:, : 2 * s])
            z, r = gates[:, :s], gates[:, s:]
            new = np.tanh(x[:, 2 * s :] + r * u[:, 2 * s :])
            step = mask[:, t, None] * (1 - z)
            if keep:
                held[t] = (h, z, r, new, u[:, 2 * s :])
            h = h + step * (new - h)
            states[t] = h
        return states, held

    def forward(self, vectors: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool = False):
        p = self.p
        sides = [self._layer(k, vectors @ p[f"in{k}"] + p[f"bias{k}"], index, mask, keep) for k in (0, 1)]
        states = np.concatenate([sides[0][0], sides[1][0]], axis=2)
        seen = np.tanh(states @ p["attend"])
        scores = np.where(mask.T > 0, seen @ p["weigh"], -1e9)
        weights = np.exp(scores - scores.max(axis=0))
        weights /= weights.sum(axis=0)
        pooled = np.einsum("tn,tns->ns", weights, states)
        return pooled @ p["out"] + p["shift"][0], (sides, states, seen, weights, pooled)

    def gradient(self, vectors, index, mask, target):
        """Loss, gradient of each parameter but the tables, and that of the word vectors."""
        p, s = self.p, STATE
        logit, (sides, states, seen, weights, pooled) = self.forward(vectors, index, mask, keep=True)
        guess = _sigmoid(logit)
        loss = float(-np.mean(target * np.log(guess + 1e-7) + (1 - target) * np.log(1 - guess + 1e-7)))
        d_logit = (guess - target) / len(target)
        g = {"out": pooled.T @ d_logit, "shift": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["out"]
        d_states = weights[:, :, None] * d_pooled
        d_weights = np.einsum("tns,ns->tn", states, d_pooled)
        d_scores = weights * (d_weights - (weights * d_weights).sum(axis=0))
        g["weigh"] = np.einsum("tn,tns->s", d_scores, seen)
        d_seen = d_scores[:, :, None] * p["weigh"] * (1 - seen * seen)
        g["attend"] = np.einsum("tna,tnb->ab", states, d_seen)
        d_states = d_states + d_seen @ p["attend"].T
        d_vectors = np.zeros_like(vectors)
        steps = index.shape[1]
        for k in (0, 1):
            each = np.zeros((steps, len(index), 3 * s), np.float32)
            g[f"back{k}"] = np.zeros_like(p[f"back{k}"])
            d_h = np.zeros((len(index), s), np.float32)
            for t in range(steps - 1, -1, -1) if k == 0 else range(steps):
                h, z, r, new, u_new = sides[k][1][t]
                d_h = d_h + d_states[t, :, k * s : (k + 1) * s]
                m = mask[:, t, None]
                d_new = d_h * m * (1 - z) * (1 - new * new)
                d_z = d_h * m * (h - new) * z * (1 - z)
                d_r = d_new * u_new * r * (1 - r)
                d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
                each[t] = np.concatenate([d_z, d_r, d_new], axis=1)
                g[f"back{k}"] += h.T @ d_u
                d_h = d_h * (1 - m * (1 - z)) + d_u @ p[f"back{k}"].T
            d_inputs = _sum_rows(index.T.ravel(), each.reshape(-1, 3 * s), len(vectors))
            g[f"in{k}"], g[f"bias{k}"] = vectors.T @ d_inputs, d_inputs.sum(axis=0)
            d_vectors += d_inputs @ p[f"in{k}"].T
        return loss, g, d_vectors


def windows_of(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each window of the words of all texts, and its text: every STRIDE words,
    the last one with the text's last word."""
    if not len(owner):
        return owner, owner
    counts = np.bincount(owner)
    first = np.cumsum(counts) - counts
    number = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(counts)), number)
    step = np.arange(len(text)) - (np.cumsum(number) - number)[text]
    return first[text] + step * STRIDE, text


def window_index(owner: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word number of each step of each window, and 1 where the window has a word."""
    at = starts[:, None] + np.arange(WINDOW)
    inside = at < len(owner)
    at = np.minimum(at, max(len(owner) - 1, 0))
    inside &= owner[at] == owner[starts][:, None]
    return which[at], inside.astype(np.float32)


def _distinct(spans: Spans, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first, which = np.unique(spans.hash(starts, ends), return_index=True, return_inverse=True)
    return first, which


@dataclass
class Model:
    network: Network | None
    shift: float = 0.0

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Score of each text: that of its worst window."""
        out = np.zeros(len(texts))
        if self.network is None:
            return out
        best = _worst(self.network, texts)
        some = np.isfinite(best)
        out[some] = 1 / (1 + np.exp(-np.clip(best[some] + self.shift, -40, 40)))
        return out


def _worst(network: Network, texts: list[str | None], together: int = 200) -> np.ndarray:
    """Largest logit of each text's windows; minus infinity without words."""
    best = np.full(len(texts), -np.inf)
    for at in range(0, len(texts), together):
        logits, text = _window_logits(network, texts[at : at + together])
        np.maximum.at(best, at + text, logits)
    return best


def _window_logits(network: Network, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    spans, starts, ends, owner = letter_words(texts)
    if not len(starts):
        return np.zeros(0), np.zeros(0, np.int64)
    first, which = _distinct(spans, starts, ends)
    vectors = Words.of(spans, starts[first], ends[first]).vectors(network.p["words"], network.p["characters"])
    begin, text = windows_of(owner)
    parts = []
    for at in range(0, len(begin), 4096):
        parts.append(network.forward(vectors, *window_index(owner, begin[at : at + 4096], which))[0])
    return np.concatenate(parts), text


def _evidence(keys: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """For each occurrence of a key, how much more often toxic texts have it (log ratio)."""
    kinds, which = np.unique(keys, return_inverse=True)
    _, once = np.unique(which * np.int64(len(toxic)) + owner, return_index=True)
    bad = np.bincount(which[once], weights=toxic[owner[once]], minlength=len(kinds))
    good = np.bincount(which[once], minlength=len(kinds)) - bad
    ratio = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((1 - toxic).sum() + 1))
    ratio[bad < 3] = np.minimum(ratio[bad < 3], 0.5)
    return ratio[which]


def train(texts: list[str], toxic: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Fit the network to whole texts and their labels, and set its threshold on parts held back."""
    toxic = toxic.astype(float)
    network = train_network(texts, toxic, epochs, seed)
    if network is None:
        return Model(None)
    return Model(network, _shift(_unseen_logits(texts, toxic, epochs, seed), toxic))


def _unseen_logits(texts: list[str], toxic: np.ndarray, epochs: int, seed: int) -> np.ndarray:
    """Logit of each text by a network trained without its part; NaN where there is none."""
    part = np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) % FOLDS for t in texts])
    out = np.full(len(texts), np.nan)
    for k in range(FOLDS):
        held = np.flatnonzero(part == k)
        rest = np.flatnonzero(part != k)
        network = train_network([texts[i] for i in rest], toxic[rest], epochs, seed)
        if network is not None:
            out[held] = _worst(network, [texts[i] for i in held])
    return out


def train_network(texts: list[str], toxic: np.ndarray, epochs: int, seed: int) -> Network | None:
    """A network fit to windows of the texts; None without words or with one class only."""
    if not len(texts) or toxic.min() == toxic.max():
        return None
    spans, starts, ends, owner = letter_words(texts)
    if not len(starts):
        return None
    first, which = _distinct(spans, starts, ends)
    words = Words.of(spans, starts[first], ends[first])
    evidence = _evidence(spans.hash(starts, ends), owner, toxic)
    for n in (4, 5, 6):
        evidence = np.maximum(evidence, _evidence(spans.hash(starts, np.minimum(ends, starts + n), n), owner, toxic))
    begin, text = windows_of(owner)
    index, mask = window_index(owner, begin, which)
    at = np.minimum(begin[:, None] + np.arange(WINDOW), len(owner) - 1)
    strength = np.where(mask > 0, evidence[at], -np.inf).max(axis=1)
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, text, strength)
    chosen = strength >= np.minimum(best[text], 2.0)
    rng = np.random.default_rng(seed)
    bad = np.flatnonzero((toxic[text] == 1) & chosen)
    some = rng.random(len(text))
    spare = ((toxic[text] == 0) & ~chosen) | ((toxic[text] == 1) & (strength < 0.7) & (some < 0.1))
    good, spare = np.flatnonzero((toxic[text] == 0) & chosen), np.flatnonzero(spare)
    bad, good = rng.permutation(bad)[:TRAIN_TOXIC], np.concatenate([rng.permutation(good), rng.permutation(spare)])[:TRAIN_CLEAN]
    network = Network(seed)
    rows, target = np.concatenate([bad, good]), np.concatenate([np.ones(len(bad)), np.zeros(len(good))]).astype(np.float32)
    _fit(network, words, index, mask, rows, target, epochs, rng)
    return network


def _fit(network, words, index, mask, rows, target, epochs, rng) -> None:
    mean = {k: np.zeros_like(v) for k, v in network.p.items()}
    square = {k: np.zeros_like(v) for k, v in network.p.items()}
    step, total = 0, epochs * -(-len(rows) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            some = order[at : at + BATCH]
            kinds, own = np.unique(index[rows[some]], return_inverse=True)
            part = words.take(kinds)
            vectors = part.vectors(network.p["words"], network.p["characters"])
            _, g, d_vectors = network.gradient(vectors, own.reshape(len(some), -1), mask[rows[some]], target[some])
            g["words"] = _sum_rows(part.bucket, d_vectors, BUCKETS)
            shared = d_vectors / np.maximum(part.counts, 1)[:, None]
            g["characters"] = _sum_rows(part.gram, shared[part.owner], BUCKETS)
            step += 1
            rate = RATE * (1 - step / (total + 1)) ** 0.5
            for k, v in g.items():
                mean[k] += 0.1 * (v - mean[k])
                square[k] += 0.01 * (v * v - square[k])
                size = np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6
                network.p[k] -= (rate / (1 - 0.9**step)) * mean[k] / size


def _shift(logit: np.ndarray, toxic: np.ndarray) -> float:
    """What to add to logits so that the best split of these lies at the threshold; logits
    that are missing or of texts without words tell nothing."""
    some = np.isfinite(logit)
    logit, toxic = logit[some], toxic[some]
    if not toxic.sum():
        return 0.0
    order = np.argsort(-logit, kind="stable")
    hits, taken = np.cumsum(toxic[order]), np.arange(1, len(order) + 1)
    f1 = np.where(hits >= LEAST_PRECISION * taken, 2 * hits / (taken + toxic.sum()), 0)
    k = int(np.argmax(f1))
    if not f1[k]:
        cut = logit[order[0]] + 1
    else:
        low = logit[order[k + 1]] if k + 1 < len(order) else logit[order[k]] - 1
        cut = 0.5 * (logit[order[k]] + low)
    return float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut)


def training_sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and label of about the sampled numbers of toxic and clean documents."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = lambda kind, size: min(1.0, size / max(counts.get(kind, 0), 1))
    place = F.pmod(F.xxhash64(F.lit("toxicity sample"), "doc_id"), F.lit(1_000_000)) / 1e6
    part = F.when(F.col("label") == 1, share(1, SAMPLE_TOXIC)).otherwise(share(0, SAMPLE_CLEAN))
    chosen = known.where(place < part)  # about SAMPLE_TOXIC + SAMPLE_CLEAN short rows: may be broadcast
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    return narrow.join(F.broadcast(chosen), "doc_id")


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    rows = sorted(training_sample(documents, labels).collect(), key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in rows], np.array([r["label"] for r in rows]))


def score_documents(documents: DataFrame, model: Model, column: str) -> DataFrame:
    """The documents with the score of their whole text in a new column."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, "text"):
            scores = sent.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, column])

    schema = StructType([*documents.schema.fields, StructField(column, DoubleType())])
    return documents.mapInArrow(run, schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_documents(narrow, model, "score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
