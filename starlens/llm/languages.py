"""Language identification: known words first, shorter and shorter n-grams for the rest.

A word is a run of letters in lower case. A word that the model knows adds its log
frequency in each language. For an unseen word the longest n-grams are tried, then
shorter ones, until some of that length are known; their mean log frequency counts.

Defined results: a text that is null or has no letters is ``und`` with score 0, and so
is every text if there was nothing to learn from. Equal sums give the first language in
alphabetical order. Repeated rows give repeated results. A row without an id is held
out, because nothing may be learned from it. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm.arrays import Spans, grams, letter_words, slices

UNKNOWN = "und"
LONGEST = 5
#: About so many documents of each language are counted to fit the model.
SAMPLE_DOCS = 1500
#: A word or n-gram is known if the sample has it so many times.
LEAST_COUNT = 2
SMOOTHING = 0.1


@dataclass(frozen=True)
class Model:
    """Sorted keys of words and n-grams, and their log frequency in each language."""

    languages: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(True))


def _count_batches(batches):
    for batch in slices(batches, "text"):
        spans, starts, ends, owner = letter_words(batch.column("text").to_pylist())
        names, which = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
        for number, name in enumerate(names):
            mine = which[owner] == number
            s, e = starts[mine], ends[mine]
            for n in range(LONGEST + 1):
                at, until = (s, e) if n == 0 else (lambda p: (p, p + n))(grams(s, e, n)[0])
                keys, counts = np.unique(spans.hash(at, until, n), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([name] * len(keys), pa.string()),
                        "size": pa.array(np.full(len(keys), n, dtype=np.int32)),
                        "key": pa.array(keys.view(np.int64)),
                        "n": pa.array(counts.astype(np.int64)),
                    }
                )


def training_sample(documents: DataFrame, size: int = SAMPLE_DOCS) -> DataFrame:
    """About ``size`` documents of each language, chosen by a hash of the id."""
    known = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return known.select("lang", "text").limit(0)
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, size / n))])
    place = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(1_000_000)) / 1e6
    return known.where(place < F.element_at(shares, F.col("lang"))).select("lang", "text")


def fit(documents: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Count words and n-grams of the training sample, and keep those seen often enough.

    The sample's size is a parameter, so the model's size doesn't follow the corpus.
    """
    counted = (
        training_sample(documents, sample_docs)
        .mapInArrow(_count_batches, "lang string, size int, key long, n long")
        .groupBy("size", "key", "lang")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
        .toArrow()
    )
    languages = sorted(set(counted.column("lang").to_pylist()))
    place = {name: i for i, name in enumerate(languages)}
    sizes, keys = counted.column("size").to_numpy(), counted.column("key").to_numpy().view(np.uint64)
    counts = counted.column("n").to_numpy()
    column = np.array([place[x] for x in counted.column("lang").to_pylist()], dtype=np.int64)
    model = Model(languages, [], [])
    for n in range(LONGEST + 1):
        mine = sizes == n
        known, row = np.unique(keys[mine], return_inverse=True)
        table = np.full((len(known), len(languages)), SMOOTHING)
        table[row, column[mine]] += counts[mine]
        model.keys.append(known)
        model.logs.append(np.log(table / np.maximum(table.sum(axis=0), 1e-9)))
    return model


def _find(model: Model, n: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each key in the model and whether it is known."""
    known = model.keys[n]
    if not len(known):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    row = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return row, known[row] == keys


def _word_logs(model: Model, spans: Spans, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Log frequencies in each language, by the word or by its longest known n-grams."""
    logs = np.zeros((len(starts), len(model.languages)))
    row, known = _find(model, 0, spans.hash(starts, ends, 0))
    logs[known] = model.logs[0][row[known]]
    left = np.flatnonzero(~known)
    for n in range(LONGEST, 0, -1):
        if not len(left):
            break
        at, owner = grams(starts[left], ends[left], n)
        row, known = _find(model, n, spans.hash(at, at + n, n))
        row, owner = row[known], owner[known]
        found = np.bincount(owner, minlength=len(left))
        for k in range(len(model.languages)):
            total = np.bincount(owner, weights=model.logs[n][row, k], minlength=len(left))
            logs[left, k] = np.where(found > 0, total / np.maximum(found, 1), logs[left, k])
        left = left[found == 0]
    return logs


def predict_texts(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    spans, starts, ends, owner = letter_words(texts)
    _, first, which = np.unique(spans.hash(starts, ends), return_index=True, return_inverse=True)
    logs = _word_logs(model, spans, starts[first], ends[first])
    sums = np.stack(
        [np.bincount(owner, weights=logs[which, k], minlength=len(texts)) for k in range(len(model.languages))], axis=1
    )
    worded = np.bincount(owner, minlength=len(texts)) > 0
    shares = np.exp(sums - sums.max(axis=1, keepdims=True))
    best = sums.argmax(axis=1)
    score = shares[np.arange(len(texts)), best] / shares.sum(axis=1)
    return [model.languages[b] if w else UNKNOWN for b, w in zip(best, worded, strict=True)], np.where(worded, score, 0.0)


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every document, from its whole text alone."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, "text"):
            names, score = predict_texts(sent.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(score)}
            )

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(documents, fit(documents))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
