"""Ranked lexical search with range-maximum sparse tables over posting lists.

``build_index`` writes shards of documents. A shard holds its documents in ascending order
of ids, their lengths, and for each term the documents that hold it with their counts.
``search`` takes the queries in blocks of bounded size, and for a block

* adds up how many documents of all shards hold each of its terms;
* looks at each shard: the terms' postings become impacts (weight times the saturated
  count), and a sparse table of their maxima answers the largest impact of a term within any
  interval of documents. A query starts with the whole shard as one interval. The intervals
  of largest bound, which is the sum of its terms' range maxima, come first: they are split
  at the document where the largest of these maxima lies, that document is scored, and the
  two sides go back with their own bounds. Short intervals are scored whole. It ends when no
  bound can enter the best ``TOP`` found so far;
* keeps the best of all shards, in two steps so that no task sees a row for each shard.

Scores are whole numbers. Equal scores are ordered by ascending id.

Defined results: a text without terms, or a null one, is in no list and not counted. A
document without an id comes before all others among equal scores; rows with the same id are
documents of their own. A query without terms, or whose terms nothing holds, has no rows.
Queries with the same id and other texts are ranked apart; repeated rows are one query.
Other columns are ignored.
Terms are told apart by 64-bit hashes within a shard, and by their bytes against a query.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlens.llm.arrays import LOWER, Spans, runs, slices, text_bytes
from starlens.session import scratch_path

TOP = 10
#: Bytes of text of a shard, and postings whose tables are held at a time.
SHARD_BYTES = 16_000_000
TABLE_POSTINGS = 300_000
#: Query terms of a block, with repeats.
BLOCK_TERMS = 200_000
#: Intervals split at a time, and documents of an interval that is scored whole.
TOGETHER, SHORT = 64, 48

#: Bytes of terms: letters and digits of ASCII, and all bytes beyond it.
TERM = np.zeros(256, dtype=bool)
TERM[ord("0") : ord("9") + 1] = TERM[ord("A") : ord("Z") + 1] = TERM[ord("a") : ord("z") + 1] = TERM[0x80:] = True


def term_spans(texts: pa.Array) -> tuple[np.ndarray, Spans, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes of all texts, hashes of spans, and each term's start, end and text number."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    return data, Spans(data), *runs(TERM[data], offsets)


# The index


class _Shard:
    """Documents collected for one shard: counts of each term, and one spelling of it."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.lengths: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.words: dict[int, bytes] = {}
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> None:
        texts = batch.column("text")
        data, spans, starts, ends, owner = term_spans(texts)
        hashes = spans.hash(starts, ends)
        order = np.lexsort((hashes, owner))
        h, o = hashes[order], owner[order]
        first = np.ones(len(h), dtype=bool)
        first[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        at = np.flatnonzero(first)
        self.hashes.append(h[at])
        self.docs.append((o[at] + len(self.ids)).astype(np.int32))
        self.counts.append(np.diff(np.append(at, len(h))).astype(np.int32))
        new, where = np.unique(hashes, return_index=True)
        for value, i in zip(new.tolist(), where.tolist(), strict=True):
            if value not in self.words:
                self.words[value] = data[starts[i] : ends[i]].tobytes()
        self.lengths.append(np.bincount(owner, minlength=len(texts)).astype(np.int64))
        self.ids += batch.column("doc_id").to_pylist()
        self.size += len(data)

    def row(self) -> dict:
        lengths = np.concatenate(self.lengths)
        # Documents in ascending order of ids; those without terms are left out.
        held = [i for i in range(len(self.ids)) if lengths[i]]
        held.sort(key=lambda i: (self.ids[i] is not None, self.ids[i] or 0, lengths[i]))
        place = np.zeros(len(self.ids), dtype=np.int64)
        place[held] = np.arange(len(held))
        hashes, docs = np.concatenate(self.hashes), place[np.concatenate(self.docs)]
        order = np.lexsort((docs, hashes))
        hashes = hashes[order]
        terms, starts = np.unique(hashes, return_index=True)
        words = [self.words[t] for t in terms.tolist()]
        counts = np.concatenate(self.counts)[order]
        width = 1 if counts.max(initial=0) < 256 else 4
        return {
            "doc_ids": [self.ids[i] for i in held],
            "lengths": lengths[held].astype("<i8").tobytes(),
            "n_docs": len(held),
            "n_terms": int(lengths.sum()),
            "terms": terms.astype("<u8").tobytes(),
            "words": words,
            "starts": np.append(starts, len(hashes)).astype("<i4").tobytes(),
            "docs": docs[order].astype("<i4").tobytes(),
            "counts": counts.astype(f"<u{width}").tobytes(),
            "count_width": width,
        }


SHARD = (
    "doc_ids array<long>, lengths binary, n_docs long, n_terms long, terms binary, words array<binary>, "
    "starts binary, docs binary, counts binary, count_width int"
)
SHARD_TYPES = pa.schema(
    [("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64()),
     ("terms", pa.binary()), ("words", pa.list_(pa.binary())), ("starts", pa.binary()), ("docs", pa.binary()),
     ("counts", pa.binary()), ("count_width", pa.int32())]
)


def _to_shards(shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in slices(batches, "text"):
            shard.add(batch)
            if shard.size >= shard_bytes:
                yield pa.RecordBatch.from_pylist([shard.row()], SHARD_TYPES)
                shard = _Shard()
        if shard.ids:
            yield pa.RecordBatch.from_pylist([shard.row()], SHARD_TYPES)

    return run


def build_index(documents: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Write the shards of all documents; each task makes its own."""
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    narrow.mapInArrow(_to_shards(shard_bytes), SHARD).write.parquet(folder)


# Queries


def query_terms(text: str | None) -> Counter:
    data, _, starts, ends, _ = term_spans(pa.array([text], pa.string()))
    return Counter(data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True))


def blocks(queries: Iterator, limit: int = BLOCK_TERMS) -> Iterator[list[tuple[object, Counter]]]:
    """The queries (id, text) with their terms, in lists of bounded size."""
    held, size = [], 0
    for key, text in queries:
        terms = query_terms(text)
        if held and size + len(terms) > limit:
            yield held
            held, size = [], 0
        held.append((key, terms))
        size += len(terms)
    if held:
        yield held


def hashed(words: list[bytes]) -> np.ndarray:
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    ends = np.cumsum(lengths)
    return Spans(np.frombuffer(b"".join(words), dtype=np.uint8)).hash(ends - lengths, ends)


def _found(shard: dict, hashes: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Place of each word among the shard's terms, or -1."""
    terms = np.frombuffer(shard["terms"], dtype="<u8")
    if not len(terms):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    at[terms[at] != hashes] = -1
    for i in np.flatnonzero(at >= 0):
        if shard["words"][at[i]] != words[i]:
            at[i] = -1
    return at


def _frequency_task(words: list[bytes]):
    hashes = hashed(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words), dtype=np.int64)
        for batch in batches:
            for shard in batch.to_pylist():
                at = _found(shard, hashes, words)
                sizes = np.diff(np.frombuffer(shard["starts"], dtype="<i4"))
                total[at >= 0] += sizes[at[at >= 0]]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(held, pa.int32()), "df": pa.array(total[held], pa.int64())})

    return run


class Postings:
    """Impacts of some terms in one shard, and the sparse table of their maxima.

    ``keys`` holds ``term << 32 | document`` in ascending order. Level ``k`` of the table
    holds the place of the largest impact among the ``2**k`` postings from each one on, the
    first of equal ones. Questions stay within the postings of one term.
    """

    def __init__(self, keys: np.ndarray, impacts: np.ndarray, longest: int):
        self.keys, self.impacts = keys, impacts
        self.levels = [np.arange(len(keys), dtype=np.int32)]
        step = 1
        while 2 * step <= longest:
            last = self.levels[-1]
            left, right = last[: len(last) - step], last[step:]
            self.levels.append(np.where(impacts[right] > impacts[left], right, left).astype(np.int32))
            step *= 2

    def largest(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of the largest impact of each range, -1 for an empty one."""
        size = end - start
        out = np.full(size.shape, -1, dtype=np.int64)
        level = np.frexp(size.astype(np.float64))[1] - 1
        for k in np.unique(level[size > 0]):
            of = (size > 0) & (level == k)
            a, b = self.levels[k][start[of]], self.levels[k][end[of] - (1 << int(k))]
            out[of] = np.where(self.impacts[b] > self.impacts[a], b, a)
        return out


def best_documents(postings: Postings, terms: np.ndarray, repeats: np.ndarray, n_docs: int, top: int) -> list[tuple[int, int]]:
    """(score, document) of the best documents for the terms: highest score, then lowest number."""
    lows = terms.astype(np.int64) << 32
    best: list[tuple[int, int]] = []  # a heap of (score, -document), the worst on top

    def offer(docs: np.ndarray, scores: np.ndarray) -> None:
        if len(best) == top:
            enough = scores >= best[0][0]
            docs, scores = docs[enough], scores[enough]
        for d, s in zip(docs.tolist(), scores.tolist(), strict=True):
            if s > 0:
                if len(best) < top:
                    heapq.heappush(best, (s, -d))
                elif (s, -d) > best[0]:
                    heapq.heapreplace(best, (s, -d))

    def scored(docs: np.ndarray) -> np.ndarray:
        wanted = lows[None, :] | docs[:, None]
        at = np.minimum(np.searchsorted(postings.keys, wanted), len(postings.keys) - 1)
        return np.where(postings.keys[at] == wanted, postings.impacts[at], 0) @ repeats

    def bounded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the terms' range maxima in each interval, and the document of the largest."""
        start = np.searchsorted(postings.keys, lows[None, :] | low[:, None])
        end = np.searchsorted(postings.keys, lows[None, :] | high[:, None])
        at = postings.largest(start, end)
        values = np.where(at >= 0, postings.impacts[at], 0) * repeats
        row = np.arange(len(low))
        peak = values.argmax(axis=1)
        return values.sum(axis=1), postings.keys[at[row, peak]] & 0xFFFFFFFF

    def score_all(low: np.ndarray, high: np.ndarray) -> None:
        size = high - low
        first = np.cumsum(size) - size
        docs = np.repeat(low - first, size) + np.arange(int(size.sum()))
        offer(docs, scored(docs))

    def keep(low: np.ndarray, high: np.ndarray) -> None:
        low, high = low[high > low], high[high > low]
        if len(low):
            bound, peak = bounded(low, high)
            for item in zip((-bound).tolist(), low.tolist(), high.tolist(), peak.tolist(), strict=True):
                if item[0] < 0:
                    heapq.heappush(waiting, item)

    def open_still(bound: int, low: int) -> bool:
        return len(best) < top or (bound, -low) > best[0]

    waiting: list[tuple[int, int, int, int]] = []
    keep(np.array([0]), np.array([n_docs]))
    while waiting and open_still(-waiting[0][0], waiting[0][1]):
        now = []
        # The first rounds are narrow, so that later ones have a limit to stop at.
        while waiting and len(now) < (TOGETHER if len(best) == top else 4):
            bound, low, high, peak = heapq.heappop(waiting)
            if open_still(-bound, low):
                now.append((low, high, peak))
        if not now:
            continue
        low, high, peak = (np.array(x) for x in zip(*now, strict=True))
        short = high - low <= SHORT
        if short.any():
            score_all(low[short], high[short])
        if not short.all():
            low, high, peak = low[~short], high[~short], peak[~short]
            offer(peak, scored(peak))
            keep(np.concatenate([low, peak + 1]), np.concatenate([peak, high]))
    return [(s, -d) for s, d in sorted(best, reverse=True)]


def _search_task(
    queries: list[tuple[int, np.ndarray, np.ndarray]], words: list[bytes], weights: np.ndarray, n: int, total: int, top: int
):
    hashes = hashed(words)

    def groups(sizes: np.ndarray) -> Iterator[list[int]]:
        """Queries whose distinct terms' postings are held together."""
        held, terms, size = [], set(), 0
        for i, (_, own, _) in enumerate(queries):
            new = [t for t in own.tolist() if t not in terms and sizes[t]]
            more = int(sizes[new].sum()) if new else 0
            if held and size + more > TABLE_POSTINGS:
                yield held
                held, terms, size = [], set(), 0
                new = [t for t in own.tolist() if sizes[t]]
                more = int(sizes[new].sum()) if new else 0
            held.append(i)
            terms.update(new)
            size += more
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                out: dict[str, list] = {"query": [], "doc_id": [], "score": []}
                starts = np.frombuffer(shard["starts"], dtype="<i4")
                docs = np.frombuffer(shard["docs"], dtype="<i4")
                counts = np.frombuffer(shard["counts"], dtype=f"<u{shard['count_width']}")
                lengths = np.frombuffer(shard["lengths"], dtype="<i8")
                at = _found(shard, hashes, words)
                at[weights <= 0] = -1
                sizes = np.where(at >= 0, starts[at + 1] - starts[at], 0)
                # m for each document; n * 75 * N passes a long, so it is done in whole numbers.
                length_part = np.array([25 + (75 * int(x) * n) // total for x in lengths.tolist()], dtype=np.int64)
                for group in groups(sizes):
                    used = np.unique(np.concatenate([queries[i][1] for i in group]))
                    used = used[sizes[used] > 0]
                    if not len(used):
                        continue
                    part = np.concatenate([np.arange(starts[at[t]], starts[at[t] + 1]) for t in used])
                    term = np.repeat(used, sizes[used])
                    own, tf = docs[part].astype(np.int64), counts[part].astype(np.int64)
                    impacts = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length_part[own]))
                    postings = Postings((term.astype(np.int64) << 32) | own, impacts, int(sizes[used].max()))
                    for i in group:
                        number, terms, repeats = queries[i]
                        present = sizes[terms] > 0
                        if present.any():
                            found = best_documents(postings, terms[present], repeats[present], len(lengths), top)
                            out["query"] += [number] * len(found)
                            out["doc_id"] += [shard["doc_ids"][d] for _, d in found]
                            out["score"] += [s for s, _ in found]
                yield pa.RecordBatch.from_pydict(
                    {
                        "query": pa.array(out["query"], pa.int64()),
                        "doc_id": pa.array(out["doc_id"], pa.int64()),
                        "score": pa.array(out["score"], pa.int64()),
                    }
                )

    return run


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _best(found: DataFrame, keys: list, top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(
    spark: SparkSession, folder: str, queries: DataFrame, id_col: str = "item_id", text_col: str = "text", top: int = TOP
) -> DataFrame:
    """The ``top`` best documents of the index for each query: id, rank, doc_id, score."""
    index = spark.read.parquet(folder)
    size = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first()
    n, total = size["n"] or 0, size["total"] or 0
    out = scratch_path(spark, "found")
    id_type = queries.schema[id_col].dataType.simpleString()
    spark.createDataFrame([], f"query long, doc_id long, score long, item {id_type}").write.parquet(out)
    asked = queries.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).distinct()
    number = 0
    rows = ((r["item"], r["text"]) for r in asked.toLocalIterator())
    for block in blocks(rows) if n else ():
        words = sorted(set().union(*[terms for _, terms in block]))
        if not words:
            continue
        partial = index.select("terms", "words", "starts").mapInArrow(_frequency_task(words), "term int, df long")
        weights = np.zeros(len(words), dtype=np.int64)
        for r in partial.groupBy("term").agg(F.sum("df").alias("df")).collect():  # one row for each query term
            weights[r["term"]] = weight(n, r["df"])
        place = {w: i for i, w in enumerate(words)}
        coded = [
            (
                number + i,
                np.array([place[w] for w in terms], dtype=np.int64),
                np.array([terms[w] for w in terms], dtype=np.int64),
            )
            for i, (_, terms) in enumerate(block)
        ]
        names = spark.createDataFrame([(number + i, key) for i, (key, _) in enumerate(block)], f"query long, item {id_type}")
        task = _search_task(coded, words, weights, n, total, top)
        found = index.mapInArrow(task, "query long, doc_id long, score long")
        # Of many shards' lists, some are merged first; then one list of a few thousand rows for each query.
        some = _best(found.withColumn("_some", F.spark_partition_id() % 256), ["query", "_some"], top).drop("rank")
        some.join(names, "query").select("query", "doc_id", "score", "item").write.mode("append").parquet(out)
        number += len(block)
    return _best(spark.read.parquet(out), ["query"], top).select(F.col("item").alias(id_col), "rank", "doc_id", "score")


def search_documents(spark: SparkSession, documents: DataFrame, queries: DataFrame) -> DataFrame:
    """Index all documents in the shared folder and rank them for each query."""
    folder = scratch_path(spark, "index")
    build_index(documents, folder)
    return search(spark, folder, queries)


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    documents, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return search_documents(spark, documents, items)


SEPARATORS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms_sql(table: str, key: str) -> str:
    return f"""SELECT {key}, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWERED}'), '{SEPARATORS}')) AS term
               FROM {table}"""


ORACLE_SQL = f"""
WITH numbered AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
occurrences AS ({_terms_sql("numbered", "row")}),
counted AS (SELECT row, term, count(*) AS tf FROM occurrences GROUP BY ALL),
sized AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY row),
totals AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sized),
lengths AS (SELECT row, 25 + (75 * n * big_n) // big_l AS m FROM sized, totals),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
            FROM counted, totals GROUP BY term, big_n),
asked AS (SELECT item_id, term, count(*) AS repeats FROM ({_terms_sql("benchmark", "item_id")}) GROUP BY ALL),
scored AS (SELECT item_id, row, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (row)
           GROUP BY item_id, row),
ranked AS (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank
           FROM scored JOIN numbered USING (row) WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}"""
