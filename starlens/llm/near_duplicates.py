"""Near duplicates: fast similarity sketches, banding, and verification on full sets.

A document's set holds the hashes of its distinct runs of ``words`` words, and two sets
are linked at a Jaccard similarity of ``percent`` or more; ``Limits`` holds both, and what
follows from them. Its sketch has ``COORDINATES`` coordinates: in each round, every element is thrown into one
bin with a random value, and a bin keeps its first round's smallest value; after as many
rounds as there are coordinates, round i looks at bin i alone. So every coordinate gets
filled whatever the set's size, two sets agree at a coordinate with a probability equal
to their Jaccard similarity, and the share of equal coordinates is concentrated about
it. Bands of coordinates bring likely pairs together: their rows and number are chosen so
that a pair at the limit meets in no band with a probability of ``MISSED`` at most (8 rows
and 48 bands for 85 %, 6 rows and 51 bands for 80 %).

Documents with equal sets form one class, found by a digest of 128 bits and numbered when
the classes are stored, so copies are never paired.
A band's classes are compared with one that leads it, whole set against whole set. The
classes of bands that still hold more than one component after that are compared too,
where their components differ and they share one of their rarest shingles, without which
sets can't be similar enough. A pair also has to pass two bounds on what its sets can
share: by the ranks of the shingle in both, and by the parities of the shingles in each
of ``64 * PARITY_WORDS`` cells, as cells that differ hold a shingle that isn't shared. So no link between bands' members is lost, no group is
capped, and documents that merely share a common passage aren't paired. Before sets are fetched, pairs are dropped whose sizes
rule out a link, or whose sketches agree in a share of the coordinates that is over
``DEVIATIONS`` standard deviations below the limit.

Defined results: words are split at white space of ASCII, A-Z are lowered. A text with
fewer words than a shingle is one shingle; null and empty texts and those without words have an
empty set, are linked with nothing, and are kept. A row without an id is kept too, with
no component. Repeated rows get the same result each. Rows with the same id but
different texts are told apart by their sets. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.llm.arrays import mix, slices, word_hashes
from starlens.llm.components import components
from starlens.llm.keys import text_key
from starlens.session import scratch_path

SHINGLE_WORDS = 3
PERCENT = 85
COORDINATES = 384
MISSED = 2.5e-7
DEVIATIONS = 8.25
PARITY_WORDS = 16


@dataclass(frozen=True)
class Limits:
    """Words of a shingle, the least similarity in percent, and what follows from it."""

    words: int = SHINGLE_WORDS
    percent: int = PERCENT

    def banding(self) -> tuple[int, int]:
        """Rows of a band and number of bands: as many rows as ``MISSED`` allows."""
        for rows in range(COORDINATES, 0, -1):
            together = (self.percent / 100) ** rows
            bands = math.ceil(math.log(MISSED) / math.log1p(-together)) if together < 1 else 1
            if rows * bands <= COORDINATES:
                return rows, bands
        raise ValueError(f"{COORDINATES} coordinates are too few for a similarity of {self.percent} %")

    def least_agreement(self) -> float:
        limit = self.percent / 100
        return limit - DEVIATIONS * math.sqrt(limit * (1 - limit) / COORDINATES)


def shingle_sets(hashes: np.ndarray, before: np.ndarray, words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, from the hashes of its words."""
    n = len(hashes)
    each = np.zeros(max(n - words + 1, 0), dtype=np.uint64)
    for k in range(words):
        each += mix(hashes[k : k + len(each)] + np.uint64(k + 1)) * np.uint64(2 * k + 3)
    each = mix(each)
    out = []
    for start, end in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if end - start >= words:
            out.append(np.unique(each[start : end - words + 1]))
        elif end > start:
            value = np.uint64(end - start)
            with np.errstate(over="ignore"):
                for h in hashes[start:end]:
                    value = mix(np.array([value * np.uint64(31) + h]))[0]
            out.append(np.array([value], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


_ROUNDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOW = np.uint64(0xFFFFFFFF)
_SHIFT = np.uint64(32)


def sketch(keys: np.ndarray) -> np.ndarray:
    """The fast similarity sketch of a set with at least one element."""
    t = COORDINATES
    out = np.full(t, np.iinfo(np.uint64).max, dtype=np.uint64)
    empty = out[0]
    # So many rounds at once fill all bins most of the time; more rounds change nothing.
    together = max(1, math.ceil(t * (math.log(t) + 2) / len(keys)))
    start = 0
    while start < t:
        rounds = np.arange(start, min(start + together, t))
        h = mix(keys[None, :] ^ _ROUNDS[rounds][:, None])
        bins = ((h >> _SHIFT) * np.uint64(t)) >> _SHIFT
        values = (rounds.astype(np.uint64) << _SHIFT)[:, None] | (h & _LOW)
        np.minimum.at(out, bins.ravel().astype(np.int64), values.ravel())
        if not np.any(out == empty):
            return out
        start += together
    for b in np.flatnonzero(out == empty):
        h = mix(keys ^ _ROUNDS[t + b])
        out[b] = (np.uint64(t + b) << _SHIFT) | (h & _LOW).min()
    return out


_BAND_SALT = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64))


def band_keys(sketched: np.ndarray, rows: int, bands: int) -> np.ndarray:
    at = np.arange(rows, dtype=np.uint64)
    mixed = mix(sketched[: rows * bands].reshape(bands, rows) + at * np.uint64(0x51ED27))
    odd = 2 * at + np.uint64(0x9E3779B1)
    return mix((mixed * odd).sum(axis=1, dtype=np.uint64) ^ _BAND_SALT[:bands])


SKETCHED = (
    "doc_id long, text_key binary, digest binary, n_shingles long, bands array<long>, small binary, parities array<long>"
)


def cell_parities(keys: np.ndarray) -> np.ndarray:
    """One bit for each cell: whether an odd number of the set's elements falls into it."""
    odd = np.bincount((keys >> _SHIFT) % np.uint64(64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _digest(keys: np.ndarray) -> bytes:
    return hashlib.blake2b(keys.tobytes(), digest_size=16).digest()


def _sketch_batches(batches, limits: Limits):
    rows, bands = limits.banding()
    for batch in slices(batches, "text"):
        sets = shingle_sets(*word_hashes(batch.column("text")), limits.words)
        sketches = [sketch(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "text_key": batch.column("text_key"),
                "digest": pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "bands": pa.array([None if s is None else band_keys(s, rows, bands).view(np.int64) for s in sketches], pa.list_(pa.int64())),
                "small": pa.array([None if s is None else (s & np.uint64(0xFF)).astype(np.uint8).tobytes() for s in sketches], pa.binary()),
                "parities": pa.array([cell_parities(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
            }
        )


def _set_batches(batches, words: int):
    for batch in slices(batches, "text"):
        sets = shingle_sets(*word_hashes(batch.column("text")), words)
        # Documents may share an id; only the text with the class's set counts.
        asked = zip(batch.column("class").to_pylist(), batch.column("digest").to_pylist(), sets, strict=True)
        own = [(c, s) for c, digest, s in asked if len(s) and _digest(s) == digest]
        yield pa.RecordBatch.from_pydict(
            {
                "class": pa.array([c for c, _ in own], pa.int64()),
                "items": pa.array([s.tobytes() for _, s in own], pa.binary()),
            }
        )


def _agree(batches, least: float):
    """Drop pairs whose sketches agree too little. A coordinate is one byte here, so
    different ones look equal once in 256 times, which drops no pair that should stay."""
    for batch in batches:
        if not batch.num_rows:
            continue
        one = np.frombuffer(b"".join(batch.column("small_a").to_pylist()), dtype=np.uint8)
        other = np.frombuffer(b"".join(batch.column("small_b").to_pylist()), dtype=np.uint8)
        equal = (one == other).reshape(-1, COORDINATES).mean(axis=1)
        yield batch.select(["a", "b"]).filter(pa.array(equal >= least))


def _linked(batches, percent: int):
    """Keep pairs whose full sets are similar enough."""
    for batch in batches:
        ones, others = batch.column("items_a").to_pylist(), batch.column("items_b").to_pylist()
        keep = []
        for x, y in zip(ones, others, strict=True):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * common >= percent * (len(p) + len(q) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


class NearDuplicates:
    """The steps over one table of documents; each result is kept in the shared folder."""

    def __init__(self, documents: DataFrame, limits: Limits):
        self.limits = limits
        self.spark = documents.sparkSession
        self.folder = scratch_path(self.spark, "near-duplicates")
        self.documents = documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), "text", text_key(F.col("text")).alias("text_key")
        )

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def find(self) -> DataFrame:
        """doc_id, n_shingles, component_id, kept and text_key of every document."""
        limits = self.limits
        sketched = self.documents.mapInArrow(lambda batches: _sketch_batches(batches, limits), SKETCHED)
        rows = self._kept(sketched, "sketches")
        held = rows.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
        # One row for each distinct set; its first document stands for all.
        self.classes = self._kept(
            held.groupBy("digest").agg(
                F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("small").alias("small"),
                F.first("bands").alias("bands"), F.first("parities").alias("parities"),
            ).withColumn("class", F.monotonically_increasing_id()),
            "classes",
        )
        members = self._members()
        # A class that meets most others leads its band: of near copies, likely the one they stem from.
        leaders = members.groupBy("band").agg(F.max(F.struct("degree", "class", "n")).alias("lead"))
        led = members.join(leaders, "band").where("class <> lead.class")
        pairs = led.select(
            F.col("lead.class").alias("a"), F.col("class").alias("b"), F.col("lead.n").alias("na"), F.col("n").alias("nb")
        )
        links = self._verified(pairs, "led")
        rest = self._verified(self._rare_pairs(self._open(members, components(links))), "rest")
        labels = components(links.unionByName(rest))
        return self._result(rows, labels)

    def _members(self) -> DataFrame:
        """band, class, n and degree of each class in each band with several classes."""
        bands = self.classes.select("class", "n", F.explode("bands").alias("band"))
        shared = bands.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
        members = self._kept(bands.join(shared, "band"), "shared-bands")
        degrees = members.groupBy("class").agg(F.sum("members").alias("degree"))
        return members.join(degrees, "class").select("band", "class", "n", "degree")

    def _open(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """class, n and label of the classes in bands that hold several components."""
        labelled = members.join(labels, members["class"] == labels["node"], "left")
        labelled = labelled.select("band", "class", "n", F.coalesce("label", "class").alias("label"))
        several = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        held = labelled.join(several.where("low <> high").select("band"), "band")
        return self._kept(held.select("class", "n", "label").distinct(), "open")

    def _rare_pairs(self, classes: DataFrame) -> DataFrame:
        """Pairs of different components that share one of their rarest shingles.

        With a least similarity of s, sets of n and m elements can't be similar enough unless they share one of the
        n - ceil(s n) + 1 rarest of the first and of as large a part of the second. At the
        rarest shingle that they share, they have no more in common than it and what comes
        after it in either; other shingles may drop the pair, as that one keeps it. Cells
        whose parities differ hold a shingle of one set only.
        """
        percent = self.limits.percent
        sets = self._sets(classes.select("class"))
        items = self._kept(sets.mapInArrow(_item_rows, "class long, item long"), "items")
        counts = items.groupBy("item").agg(F.count("*").alias("holders"))
        by_rarity = Window.partitionBy("class").orderBy("holders", "item")
        ranked = items.join(counts, "item").withColumn("rank", F.row_number().over(by_rarity))
        rare = ranked.join(classes, "class").where(f"rank <= n - ceil({percent} * n / 100) + 1 and holders > 1")
        rare = self._kept(rare.select("item", "class", "n", "label", "rank"), "rare-items")
        several = rare.groupBy("item").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        rare = rare.join(several.where("low <> high").select("item"), "item")
        rare = rare.join(self.classes.select("class", "parities"), "class")
        rare = rare.select("item", "class", "n", "label", "rank", "parities")
        one = rare.toDF("item", "a", "na", "la", "ra", "pa")
        other = rare.toDF("item", "b", "nb", "lb", "rb", "pb")
        later = "(least(na - ra, nb - rb) + 1)"
        by_rank = f"100 * {later} >= {percent} * (na + nb - {later})"
        apart = "(" + " + ".join(f"bit_count(pa[{k}] ^ pb[{k}])" for k in range(PARITY_WORDS)) + ")"
        by_cells = f"100 * (na + nb - {apart}) >= {percent} * (na + nb + {apart})"
        return one.join(other, "item").where(f"la < lb and {by_rank} and {by_cells}").select("a", "b", "na", "nb")

    def _verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Distinct pairs of classes whose full sets are similar enough."""
        percent, least = self.limits.percent, self.limits.least_agreement()
        pairs = pairs.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        small = self.classes.select("class", "small")
        pairs = pairs.join(small.toDF("a", "small_a"), "a").join(small.toDF("b", "small_b"), "b")
        likely = self._kept(pairs.mapInArrow(lambda batches: _agree(batches, least), "a long, b long"), f"{name}-likely")
        needed = likely.select(F.col("a").alias("class")).union(likely.select(F.col("b").alias("class"))).distinct()
        sets = self._sets(needed)
        both = likely.join(sets.toDF("a", "items_a"), "a").join(sets.toDF("b", "items_b"), "b")
        return self._kept(both.mapInArrow(lambda batches: _linked(batches, percent), "a long, b long"), f"{name}-links")

    def _sets(self, needed: DataFrame) -> DataFrame:
        """Full sets of some classes, made anew from one text of each."""
        chosen = needed.join(self.classes.select("class", "digest", "doc_id"), "class")
        texts = self.documents.join(chosen, "doc_id").select("class", "digest", "text")
        words = self.limits.words
        return texts.mapInArrow(lambda batches: _set_batches(batches, words), "class long, items binary").dropDuplicates(["class"])

    def _result(self, rows: DataFrame, labels: DataFrame) -> DataFrame:
        grouped = self.classes.select("class", "doc_id").join(labels, F.col("class") == F.col("node"), "left")
        grouped = grouped.select("class", "doc_id", F.coalesce("label", "class").alias("label"))
        least = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
        digests = self.classes.select("class", "digest")
        of_class = self._kept(grouped.join(least, "label").join(digests, "class").select("digest", "component_id"), "components")
        component = F.when(F.col("digest").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
        found = rows.join(of_class, "digest", "left").select("doc_id", "n_shingles", component.alias("component_id"), "text_key")
        kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
        return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_key")


def _item_rows(batches):
    for batch in batches:
        for one, held in zip(batch.column("class").to_pylist(), batch.column("items").to_pylist(), strict=True):
            items = np.frombuffer(held, np.int64)
            yield pa.RecordBatch.from_pydict({"class": pa.array(np.full(len(items), one)), "item": pa.array(items)})


def near_duplicates(documents: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    return NearDuplicates(documents, Limits(words, percent)).find()


def one_of_each(documents: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents with one row of each component: that of its smallest id.

    Of several texts of that id, the one with the smallest key stays; of repeated rows (equal
    id and text) any one. Rows are told by id and text, so a text stays that only shares its
    id with one that goes. Rows without an id and texts without words all stay.
    """
    spark = documents.sparkSession
    folder = scratch_path(spark, "near-duplicates-found")
    near_duplicates(documents, words, percent).where("doc_id is not null and n_shingles > 0").write.parquet(f"{folder}/rows")
    # Rows of one id and text count as one from here on; a key is repeated if there were several.
    grouped = spark.read.parquet(f"{folder}/rows").groupBy("component_id", "doc_id", "text_key", "kept")
    grouped.agg(F.count("*").alias("n")).write.parquet(f"{folder}/keys")
    keys = spark.read.parquet(f"{folder}/keys")
    first = keys.where("kept").groupBy("component_id").agg(F.min("text_key").alias("stays"), F.max("text_key").alias("last"))
    twins = keys.where("kept").join(first.where("stays <> last"), "component_id").where("text_key <> stays")
    gone = keys.where("not kept").select("doc_id", "text_key").union(twins.select("doc_id", "text_key"))
    repeats = keys.where("kept and n > 1").select("doc_id", "text_key")

    def same(others: DataFrame) -> Column:
        own = documents["doc_id"].cast("long") == others["doc_id"]
        return own & (text_key(documents["text"]) == others["text_key"])

    if repeats.isEmpty():
        return documents.join(gone, same(gone), "left_anti")
    left = gone.union(repeats)
    single = documents.join(left, same(left), "left_anti")
    again = repeats.join(twins, ["doc_id", "text_key"], "left_anti")
    several = documents.join(again, same(again), "left_semi")
    row = several.groupBy(F.col("doc_id").alias("_id"), text_key(F.col("text")).alias("_key")).agg(
        F.first(F.struct(*documents.columns)).alias("_row")
    )
    return single.unionByName(row.select("_row.*"))


def op6_near_duplicates(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), SHINGLE_WORDS, PERCENT)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
