"""Packing of whole documents into token sequences by exact complements.

Only the number of pieces of each length decides how sequences are filled, and a sequence
of ``SEQUENCE_TOKENS`` has as many lengths at most. So the plan is made from that histogram,
whatever the number of documents:

* sums of one, two and three available lengths are indexed by hash. From the longest length
  on, the gap beside it is looked up, and a combination found is consumed as often as its
  counts allow;
* what is left is packed by best fit: a gap takes the longest length that fits and is looked
  up again, until a combination fills it or nothing fits.

Each step uses up a length or a group of equal sequences, so the plan has a few thousand
rows at most: which ranks of a length go to which sequences, and where. A piece gets its
rank from its number among the pieces of its length in its file and the counts of the files
before; no pieces of one length are brought together.

Texts are encoded once. The pieces with their ids are a table in the shared folder
(``pieces``), ``place`` adds the sequence and offset to any frame of pieces, and
``sequences`` puts packed pieces together.

Defined results: a null or empty text has the end id only. Rows with the same id, or without
one, are documents of their own. Other columns are ignored. An empty table has no pieces.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlens.llm.arrays import slices
from starlens.llm.encode import tokenizer_path, word_encoder
from starlens.session import scratch_path

SEQUENCE_TOKENS = 1024
END_ID = 2

PIECE = "doc_id long, piece int, start long, length int, part int, nth long, ids binary"
PIECE_TYPES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
     ("part", pa.int32()), ("nth", pa.int64()), ("ids", pa.binary())]
)


# The plan


class Complements:
    """Available lengths, and the combinations of up to three of them by their sum.

    Of several pairs with one sum, the one of most equal lengths comes first, or the one
    that holds the longest length if not ``even``. ``most`` bounds the lengths of a combination.
    """

    def __init__(self, counts: dict[int, int], size: int, even: bool = True, most: int = 3):
        self.most = most
        self.left = {length: n for length, n in counts.items() if n}
        self.lengths = sorted(self.left, reverse=True)
        self.pairs: dict[int, list[tuple[int, int]]] = {}
        for i, a in enumerate(self.lengths):
            for b in self.lengths[i:]:
                if a + b <= size:
                    self.pairs.setdefault(a + b, []).append((a, b))
        if not even:
            for held in self.pairs.values():
                held.reverse()

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            self.lengths.remove(length)

    def take_all(self, lengths: tuple[int, ...], n: int) -> list[tuple[int, int]]:
        """Consume a combination so many times; its (length, repeats)."""
        held = list(Counter(lengths).items())
        for length, repeats in held:
            self.take(length, n * repeats)
        return held

    def times(self, lengths: tuple[int, ...]) -> int:
        """How often the combination is available."""
        return min(self.left.get(x, 0) // n for x, n in Counter(lengths).items())

    def pair(self, total: int) -> tuple[int, int] | None:
        """A pair of this sum. Pairs of lengths that are used up leave the index."""
        held = self.pairs.get(total, [])
        while held:
            if self.times(held[-1]):
                return held[-1]
            held.pop()
        return None

    def exact(self, total: int, also: tuple[int, ...] = ()) -> tuple[int, ...] | None:
        """One, two or three lengths of this sum, in that order, available beside ``also``."""
        if total in self.left and self.times((total, *also)):
            return (total,)
        found = self.pair(total) if self.most > 1 else None
        if found and self.times((*found, *also)):
            return found
        for first in self.lengths if self.most > 2 else ():
            if first < total:
                rest = self.pair(total - first)
                # A length that occurs twice or thrice in it needs as many pieces.
                if rest and self.times((first, *rest, *also)):
                    return (first, *rest)
        return None


def _exact_groups(available: Complements, size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences that a length and one to three others fill exactly, from the longest length on."""
    groups = []
    for first in list(available.lengths):
        while first in available.left:
            if first == size:
                found = ()
            else:
                found = available.exact(size - first, (first,))
                if not found:
                    break
            n = available.times((first, *found))
            groups.append((n, available.take_all((first, *found), n)))
    return groups


def _best_fit_groups(available: Complements, size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences of all that is left: the longest length that fits, or an exact combination."""
    groups = []
    while available.lengths:
        first = available.lengths[0]
        # No more sequences than all that is left must fill, unless no two of them fit together.
        tokens = sum(length * n for length, n in available.left.items())
        n = available.left[first]
        n = n if 2 * first > size else min(n, -(-tokens // size))
        available.take(first, n)
        # Sequences that are still open: how many, what they hold, the gap of each.
        open_groups = [(n, [(first, 1)], size - first)]
        while open_groups:
            n, held, gap = open_groups.pop()
            if not gap or not available.lengths or available.lengths[-1] > gap:
                groups.append((n, held))
                continue
            longest = next(x for x in available.lengths if x <= gap)
            exact = available.exact(gap) if 3 * longest >= gap else None
            if exact:
                k = min(n, available.times(exact))
                groups.append((k, held + available.take_all(exact, k)))
            else:
                # As many as leave a gap that three lengths could fill, one at least.
                wanted = max(1, -(-(gap - 3 * longest) // longest))
                each = min(wanted, available.left[longest] // n)
                k, each = (n, each) if each else (available.left[longest], 1)
                available.take(longest, k * each)
                open_groups.append((k, [*held, (longest, each)], gap - each * longest))
            if k < n:
                open_groups.append((n - k, held, gap))
    return groups


def plan(counts: dict[int, int], size: int = SEQUENCE_TOKENS) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups of equal sequences: how many, and the (length, repeats) of each of them.

    Exact combinations of whole sequences come first, then the residuals by best fit; or
    best fit from the start, which keeps more short lengths for the end. The plan with
    fewer sequences counts.
    """
    found = []
    for whole_first, even, most in ((True, True, 3), (True, False, 3), (False, True, 3), (False, False, 3), (False, True, 1)):
        available = Complements(counts, size, even, most)
        groups = _exact_groups(available, size) if whole_first else []
        found.append(groups + _best_fit_groups(available, size))
    return min(found, key=lambda groups: sum(n for n, _ in groups))


def places(groups: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first_rank, after_rank, sequence, repeats, offset): which ranks go where."""
    ranks, rows, sequence = Counter(), [], 0
    for n, held in groups:
        offset = 0
        for length, repeats in held:
            start = ranks[length]
            ranks[length] += n * repeats
            rows.append((length, start, ranks[length], sequence, repeats, offset))
            offset += length * repeats
        sequence += n
    return rows


# Pieces


def _to_pieces(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = word_encoder(path), TaskContext.get().partitionId(), Counter()
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in slices(batches, "text"):
            rows: dict[str, list] = {name: [] for name in PIECE_TYPES.names}
            encoded = encoder.batch(batch.column("text").to_pylist())
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                ids = np.frombuffer(own, dtype=encoder.kind).astype("<u4").tobytes() + end
                total = len(ids) // 4
                start, piece = 0, 0
                while start < total:
                    length = (total - start) % size or size
                    rows["doc_id"].append(doc_id)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(length)
                    rows["part"].append(part)
                    rows["nth"].append(seen[length])
                    rows["ids"].append(ids[4 * start : 4 * (start + length)])
                    seen[length] += 1
                    start, piece = start + length, piece + 1
            yield pa.RecordBatch.from_pydict(rows, PIECE_TYPES)

    return run


def pieces(documents: DataFrame, path: str | None = None, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """Encode all documents, cut longer ones, and store the pieces.

    ``ids`` are little-endian unsigned 32-bit ids, ``part`` is the writing task, and ``nth``
    numbers the pieces of one length within it.
    """
    spark = documents.sparkSession
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    folder = scratch_path(spark, "pieces")
    narrow.mapInArrow(_to_pieces(path or tokenizer_path(), size), PIECE).write.parquet(folder)
    return spark.read.parquet(folder)


def place(found: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces; their other columns are kept."""
    spark: SparkSession = found.sparkSession
    in_part = found.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    folder = scratch_path(spark, "lengths")
    in_part.write.parquet(folder)
    in_part = spark.read.parquet(folder)
    # One row for each length of a piece, so a sequence's tokens bound them.
    totals = in_part.groupBy("length").agg(F.sum("n").alias("n")).collect()
    planned = places(plan({r["length"]: r["n"] for r in totals}, size))
    ranges = spark.createDataFrame(
        planned, "length int, first_rank long, after_rank long, base long, repeats long, base_offset long"
    )
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = in_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base"))
    ranked = found.join(bases, ["part", "length"]).withColumn("_rank", F.col("nth") + F.col("_base"))
    # The ranges of a length are an array, so that each piece meets one row only.
    by_length = ranges.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("first_rank", "base", "repeats", "base_offset"))).alias("_ranges")
    )
    chosen = F.element_at("_ranges", F.size(F.filter("_ranges", lambda r: r["first_rank"] <= F.col("_rank"))))
    within = F.col("_rank") - F.col("_range.first_rank")
    return (
        ranked.join(F.broadcast(by_length), "length")
        .withColumn("_range", chosen)
        .withColumns(
            {
                "sequence_id": F.col("_range.base") + F.expr("(_rank - _range.first_rank) div _range.repeats"),
                "offset": F.col("_range.base_offset") + (within % F.col("_range.repeats")) * F.col("length"),
            }
        )
        .select(*found.columns, "sequence_id", "offset")
    )


def pack(documents: DataFrame, path: str | None = None) -> DataFrame:
    """All pieces with their ids, sequence and offset."""
    return place(pieces(documents, path))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets): each sequence's ids in a row.

    A sequence holds as many pieces as tokens at most, so its group is bounded.
    """
    ordered = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("held")).select(
        "sequence_id",
        F.aggregate("held.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
        F.col("held.doc_id").alias("doc_ids"),
        F.col("held.offset").alias("offsets"),
    )


def op11_packing(spark, sf_dir: str) -> DataFrame:
    found = pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    # The digest is taken before the pieces get their place, so that ids aren't shuffled.
    narrow = found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(narrow).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
