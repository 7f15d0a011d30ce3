"""Language-model scoring: cross-entropy difference of two matched bigram models.

The target model counts the words of documents labelled as good (``quality`` 1), the
background model those of all documents. Both have the same vocabulary (every distinct
word of the corpus and the end of a document), the same order and the same smoothing: a
word's probability after another is its bigram count, with ``MASS`` counts more that are
dealt by the unigram model, which adds one to each count. A document's score is its mean
loss per token under the target model less that under the background model; low means
alike to the target. A document's own counts are taken off both models before it is
scored, so having been labelled doesn't favour it.

Counts don't go through one place. Documents are dealt to blocks of bounded size. A block
counts its own words and bigrams and sends the sorted keys in packed arrays, by ranges
of keys; a range adds up all blocks' counts and sends back to each block the sums for
that block's keys, in the same order. A word's key may thus occur in every block, but
comes once from each, however frequent it is.

Beyond ``FANOUT`` blocks the way to the ranges has several levels, so that no node sends
or receives more than ``FANOUT`` rows and their number follows the input: with D digits,
a node is a block's number whose first l digits have been replaced by those of a range.
It adds up what its ``FANOUT`` children sent it before it sends it on by the next digit,
and the sums come back the same way. Keys have 64 bits and counts are 64-bit sums.

Defined results: a text that is null or has no words has 0 words, no losses and no score,
and counts in neither model. Rows without an id are scored, with no label. Repeated rows
are counted and scored each. Several labels of one id count as good if any is. Without
any good document the target model is uniform. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.arrays import mix, slices, word_hashes
from starlens.session import scratch_path

BLOCK_BYTES = 8_000_000
MASS = 5.0
#: Parts of a block's key beside the id, so that copies of one id don't make a large block.
SALTS = 4
EDGE = np.uint64(0x5EED5EED5EED5EED)  # stands for the start and the end of a document
ONE = np.uint64(1)
SUMMARY = -1
#: Rows of packed counts that a node sends or receives at most. Each holds some kilobytes
#: at this number, so a further level, which stores all counts again, saves little before.
FANOUT = 4096
#: In packed counts, stands for a count that follows in 64 bits.
MANY = 255


def _sequence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts with an edge after each text that has words, and how many
    symbols lie before each text."""
    hashes, before = word_hashes(texts)
    counts = np.diff(before)
    some = counts > 0
    out = np.insert(hashes, before[1:][some], EDGE)
    return out, np.concatenate([[0], np.cumsum(counts + some)])


def _keys(symbols: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Odd keys of the symbols, and even keys of each symbol after the one before it."""
    previous = np.concatenate([[EDGE], symbols[:-1]]).astype(np.uint64)
    starts = before[:-1][np.diff(before) > 0]
    previous[starts] = EDGE
    single = mix(symbols) | ONE
    double = mix(mix(symbols) + mix(previous ^ np.uint64(0xC0FFEE)) * np.uint64(3)) & ~ONE
    return single, double


class Block:
    """The documents of one block with their symbols and keys."""

    def __init__(self, rows: pa.Table):
        kinds = np.array(rows.column("is_label").to_pylist(), dtype=bool)
        labels = rows.filter(pa.array(kinds))
        self.documents = rows.filter(pa.array(~kinds)).combine_chunks()
        good = set(labels.column("doc_id").to_pylist())
        ids = self.documents.column("doc_id").to_pylist()
        self.good = np.array([i is not None and i in good for i in ids], dtype=bool)
        symbols, counts = [], []
        batch = self.documents.select(["text"]).to_batches()
        for part in slices(batch, "text"):
            own, before = _sequence(part.column("text"))
            symbols.append(own)
            counts.append(np.diff(before))
        self.symbols = np.concatenate(symbols) if symbols else np.zeros(0, np.uint64)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.before = np.concatenate([[0], np.cumsum(self.counts)])
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)
        self.single, self.double = _keys(self.symbols, self.before)
        self.keys, at = np.unique(np.concatenate([self.single, self.double]), return_inverse=True)
        self.at_single, self.at_double = at[: len(self.single)], at[len(self.single) :]

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """Counts of each key in all documents and in the good ones."""
        both = np.concatenate([self.at_single, self.at_double])
        good = np.tile(self.good[self.owner], 2)
        n = len(self.keys)
        return np.bincount(both, minlength=n), np.bincount(both[good], minlength=n)

    def of_document(self, at: np.ndarray) -> np.ndarray:
        """For each occurrence of a key, how many its document has."""
        _, which, counts = np.unique(at * np.int64(len(self.counts)) + self.owner, return_inverse=True, return_counts=True)
        return counts[which]

    def earlier(self, values: np.ndarray) -> np.ndarray:
        """Of each symbol's predecessor; the start of a document has its end's value."""
        out = np.concatenate([values[:1], values[:-1]])
        some = self.counts > 0
        out[self.before[:-1][some]] = values[self.before[1:][some] - 1]
        return out


class Route:
    """How counts go from blocks to ranges of keys: ``levels`` digits to the base ``width``."""

    def __init__(self, blocks: int, fanout: int = FANOUT):
        self.levels = 1
        while fanout**self.levels < blocks:
            self.levels += 1
        self.width = 1
        while self.width**self.levels < blocks:
            self.width += 1

    def digits(self, keys: np.ndarray, level: int) -> np.ndarray:
        """The digit of each key's range that a node of a level sends it by."""
        ranges = ((keys >> np.uint64(32)) * np.uint64(self.width**self.levels)) >> np.uint64(32)
        return (ranges.astype(np.int64) // self._weight(level)) % self.width

    def receiver(self, node: int, level: int, digit: int) -> int:
        weight = self._weight(level)
        return node + (digit - node // weight % self.width) * weight

    def _weight(self, level: int) -> int:
        return self.width ** (self.levels - 1 - level)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct keys: the first one, then the gaps in as many bytes as the widest takes."""
    gaps = np.diff(keys)
    size = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    cut = np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size])
    return bytes([size]) + keys[:1].astype("<u8").tobytes() + cut.tobytes()


def unpacked_keys(held: bytes) -> np.ndarray:
    size = held[0]
    gaps = np.zeros(((len(held) - 9) // size, 8), dtype=np.uint8)
    gaps[:, :size] = np.frombuffer(held[9:], dtype=np.uint8).reshape(-1, size)
    return np.cumsum(np.concatenate([np.frombuffer(held[1:9], "<u8"), gaps.view("<u8").ravel()]), dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    """A byte for each count, and those of ``MANY`` or more in 64 bits behind."""
    return np.minimum(counts, MANY).astype(np.uint8).tobytes() + counts[counts >= MANY].astype("<i8").tobytes()


def unpacked_counts(held: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(held[:n], np.uint8).astype(np.int64)
    out[out == MANY] = np.frombuffer(held[n:], "<i8")
    return out


PACKED = "node long, child long, keys binary, everywhere binary, target binary"
PACKED_TYPES = pa.schema(
    [("node", pa.int64()), ("child", pa.int64()), ("keys", pa.binary()), ("everywhere", pa.binary()), ("target", pa.binary())]
)
SUMMED = "child long, node long, n long, everywhere binary, target binary, words long, tokens long, target_tokens long"
SUMMED_TYPES = pa.schema(
    [("child", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("everywhere", pa.binary()), ("target", pa.binary()),
     ("words", pa.int64()), ("tokens", pa.int64()), ("target_tokens", pa.int64())]
)


def _send(route: Route, level: int, node: int, keys: np.ndarray, everywhere: np.ndarray, target: np.ndarray) -> pa.Table:
    """Rows from a node of a level to the next one, by the digit of the keys' ranges."""
    edges = np.searchsorted(route.digits(keys, level), np.arange(route.width + 1))
    out = []
    for digit in np.flatnonzero(np.diff(edges)).tolist():
        s = slice(edges[digit], edges[digit + 1])
        out.append(
            {"node": route.receiver(node, level, digit), "child": node, "keys": packed_keys(keys[s]),
             "everywhere": packed_counts(everywhere[s]), "target": packed_counts(target[s])}
        )
    return pa.Table.from_pylist(out, PACKED_TYPES)


class Node:
    """What the children of a node sent it, with the distinct keys."""

    def __init__(self, rows: pa.Table):
        self.rows = rows
        self.number = rows.column("node")[0].as_py()
        self.children = rows.column("child").to_pylist()
        keys = [unpacked_keys(x) for x in rows.column("keys").to_pylist()]
        self.sizes = [len(k) for k in keys]
        self.keys, self.at = np.unique(np.concatenate(keys), return_inverse=True)

    def total(self, name: str) -> np.ndarray:
        parts = zip(self.rows.column(name).to_pylist(), self.sizes, strict=True)
        out = np.zeros(len(self.keys), dtype=np.int64)
        np.add.at(out, self.at, np.concatenate([unpacked_counts(x, n) for x, n in parts]))
        return out

    def answers(self, everywhere: np.ndarray, target: np.ndarray) -> list[dict]:
        """For each child the sums for its keys, in its order."""
        own = np.split(self.at, np.cumsum(self.sizes)[:-1])
        return [
            {"child": child, "node": self.number, "n": len(at), "everywhere": packed_counts(everywhere[at]), "target": packed_counts(target[at])}
            for child, at in zip(self.children, own, strict=True)
        ]


def _count(route: Route):
    def run(rows: pa.Table) -> pa.Table:
        block = Block(rows)
        return _send(route, 0, rows.column("block")[0].as_py(), block.keys, *block.totals())

    return run


def _forward(route: Route, level: int):
    def run(rows: pa.Table) -> pa.Table:
        node = Node(rows)
        return _send(route, level, node.number, node.keys, node.total("everywhere"), node.total("target"))

    return run


def _add(rows: pa.Table) -> pa.Table:
    node = Node(rows)
    everywhere, target = node.total("everywhere"), node.total("target")
    single = (node.keys & ONE) == ONE
    summary = {
        "child": SUMMARY, "node": node.number, "words": int(single.sum()), "tokens": int(everywhere[single].sum()),
        "target_tokens": int(target[single].sum()),
    }
    return pa.Table.from_pylist([*node.answers(everywhere, target), summary], SUMMED_TYPES)


def _joined(sums: pa.Table, name: str) -> np.ndarray:
    """Sums for a node's or block's keys in its order, from the nodes that it sent them to."""
    held, sizes = sums.column(name).to_pylist(), sums.column("n").to_pylist()
    parts = [unpacked_counts(held[i], sizes[i]) for i in np.argsort(sums.column("node").to_numpy())]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def _back(rows: pa.Table, sums: pa.Table) -> pa.Table:
    return pa.Table.from_pylist(Node(rows).answers(_joined(sums, "everywhere"), _joined(sums, "target")), SUMMED_TYPES)


def _losses(block: Block, counts: np.ndarray, own: bool | np.ndarray, words: int, tokens: int, mass: float) -> np.ndarray:
    """Loss of each symbol under one model, whose counts lack the symbol's own document.

    ``own`` tells whether the symbol's document is in the model.
    """
    single = counts[block.at_single] - own * block.of_document(block.at_single)
    double = counts[block.at_double] - own * block.of_document(block.at_double)
    rest = tokens - own * block.counts[block.owner]
    unigram = (single + 1.0) / (rest + words)
    return -np.log((double + mass * unigram) / (block.earlier(single) + mass))


SCORED = "doc_id long, n_words long, target_loss double, background_loss double, difference double"
SCORED_TYPES = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64()), ("difference", pa.float64())]
)


def _score(words: int, tokens: int, target_tokens: int, mass: float):
    def run(rows: pa.Table, sums: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return SCORED_TYPES.empty_table()
        block = Block(rows)
        n = block.counts
        some = n > 0
        mean = lambda loss: np.bincount(block.owner, weights=loss, minlength=len(n)) / np.maximum(n, 1)
        target = mean(_losses(block, _joined(sums, "target"), block.good[block.owner], words, target_tokens, mass))
        background = mean(_losses(block, _joined(sums, "everywhere"), True, words, tokens, mass))
        return pa.Table.from_arrays(
            [
                block.documents.column("doc_id"),
                pa.array(n - some, pa.int64()),
                pa.array(target, mask=~some),
                pa.array(background, mask=~some),
                pa.array(target - background, mask=~some),
            ],
            schema=SCORED_TYPES,
        )

    return run


def dealt(documents: DataFrame, labels: DataFrame, blocks: int) -> DataFrame:
    """Documents and the labels of good ones, with the block that holds both.

    Blocks are longs, as nodes are: groups of both meet only if their keys hash alike.
    """
    place = lambda doc_id, salt: F.pmod(F.xxhash64(doc_id, salt), F.lit(blocks)).cast("long")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
    # Rows without an id have no label, so they are dealt by their text, and rows without text count in no model, so they are dealt evenly.
    empty = F.coalesce(F.length("text"), F.lit(0)) == 0
    dealt_by = F.when(empty, F.monotonically_increasing_id()).otherwise(F.coalesce("doc_id", F.xxhash64("text")))
    texts = texts.select(place(dealt_by, F.col("salt")).alias("block"), "doc_id", "text", F.lit(False).alias("is_label"))
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    good = good.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    good = good.select(place(F.col("doc_id"), F.col("salt")).alias("block"), "doc_id", F.lit(None).cast("string").alias("text"), F.lit(True).alias("is_label"))
    return texts.unionByName(good)


def packed_levels(rows: DataFrame, route: Route, folder: str) -> list[DataFrame]:
    """Packed counts that the nodes of each level receive; all but the last are stored."""
    spark = rows.sparkSession
    found = [rows.groupBy("block").applyInArrow(_count(route), PACKED)]
    for level in range(1, route.levels):
        found[-1].write.parquet(f"{folder}/packed-{level}")
        found[-1] = spark.read.parquet(f"{folder}/packed-{level}")
        found.append(found[-1].groupBy("node").applyInArrow(_forward(route, level), PACKED))
    return found


def score_documents(
    documents: DataFrame, labels: DataFrame, block_bytes: int = BLOCK_BYTES, mass: float = MASS, fanout: int = FANOUT
) -> DataFrame:
    """Losses of every document under both models, and their difference."""
    spark = documents.sparkSession
    folder = scratch_path(spark, "cross-entropy")
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    route = Route(blocks, fanout)
    rows = dealt(documents, labels, blocks)
    packed = packed_levels(rows, route, folder)
    packed[-1].groupBy("node").applyInArrow(_add, SUMMED).write.parquet(f"{folder}/sums")
    sums = spark.read.parquet(f"{folder}/sums")
    whole = sums.where(F.col("child") == SUMMARY).agg(F.sum("words"), F.sum("tokens"), F.sum("target_tokens")).first()
    scorer = _score(*[x or 0 for x in whole], mass)
    answers = sums.where(F.col("child") != SUMMARY)
    for received in reversed(packed[:-1]):
        answers = received.groupBy("node").cogroup(answers.groupBy("child")).applyInArrow(_back, SUMMED)
    answers = answers.select("child", "node", "n", "everywhere", "target")
    return rows.groupBy("block").cogroup(answers.groupBy("child")).applyInArrow(scorer, SCORED)


def op1_cross_entropy(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
