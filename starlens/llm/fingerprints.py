"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraph parts.

A text's paragraphs are its lines; each is cut into parts of ``PART_WORDS`` words, and a
part's digest is a hash of its bytes and of how many equal parts came before. Each digest
is added to one cell of each of three tables, which hold a count, a sum of digests and a
sum of checks (modulo 2**64). Subtracting the cells of two versions cancels what both
have. Peeling then takes digests from cells that hold a single one until nothing is left,
which gives the digests that differ. If cells are left over, both sketches are built
anew with twice as many cells.

The fingerprint is the smallest sketch, in base64. Likeness is twice the number of
common parts over the number of parts of both (Dice), from the recovered difference:
``near_edited`` follows from ``n_parts``, ``edited_parts`` and the recovered digests,
``removed`` (in the text only) and ``added`` (in the edited one only), in ascending order.

Defined results: a null text counts as empty; texts without words have an empty sketch,
and two such texts have likeness 1. The next document is the one with the next larger
id; rows without an id come first, and rows with equal ids follow each other by their
text. The last one is followed by the first, so a single row follows itself. Repeated
rows are kept. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.arrays import SPACE, Spans, mix, runs, text_bytes

TABLES = 3
PART_WORDS = 4
#: Cells of each table of the fingerprint and of the first try at a difference.
LEAST_CELLS = 8
#: Bytes of text in a range of ids, and of the texts that are looked at together.
RANGE_BYTES = 4_000_000
#: Ranges at most, as their bounds and first ids pass through the driver. Rows of a range are
#: sorted by Spark, which spills, and looked at in steps, so larger ranges need no more memory.
MOST_RANGES = 20_000
STEP_BYTES = 1_000_000
FIRST_ID = -(2**63)


@dataclass
class Sketches:
    """Cells of many texts in a row; text i has TABLES tables of ``cells[i]`` cells."""

    cells: np.ndarray
    count: np.ndarray
    digests: np.ndarray
    checks: np.ndarray

    def minus(self, other: Sketches) -> Sketches:
        return Sketches(
            self.cells, self.count - other.count, self.digests - other.digests, self.checks - other.checks
        )


def _check(digests: np.ndarray) -> np.ndarray:
    return mix(digests ^ np.uint64(0xA5A5A5A5A5A5A5A5))


def _places(digests: np.ndarray, owner: np.ndarray, cells: np.ndarray, base: np.ndarray, table: int) -> np.ndarray:
    high = mix(digests + np.uint64(table + 1)) >> np.uint64(32)
    within = (high * cells[owner].astype(np.uint64)) >> np.uint64(32)
    return base[owner] + table * cells[owner] + within.astype(np.int64)


def _bases(cells: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(TABLES * cells)])


def sketch(digests: np.ndarray, owner: np.ndarray, cells: np.ndarray) -> Sketches:
    """Sketches of len(cells) texts from all their digests."""
    base = _bases(cells)
    out = Sketches(cells, np.zeros(base[-1], np.int64), np.zeros(base[-1], np.uint64), np.zeros(base[-1], np.uint64))
    checks = _check(digests)
    for table in range(TABLES):
        at = _places(digests, owner, cells, base, table)
        np.add.at(out.count, at, 1)
        np.add.at(out.digests, at, digests)
        np.add.at(out.checks, at, checks)
    return out


def peel(difference: Sketches) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digests that differ, the text and side (+1, -1) of each, and which texts failed."""
    cells, base = difference.cells, _bases(difference.cells)
    count, digests, checks = difference.count.copy(), difference.digests.copy(), difference.checks.copy()
    text_of = np.repeat(np.arange(len(cells)), TABLES * cells)
    look = np.flatnonzero(np.abs(count) == 1)
    found, owners, sides = [], [], []
    while len(look):
        side = count[look]
        one = np.abs(side) == 1
        look, side = look[one], side[one]
        value = np.where(side > 0, digests[look], np.uint64(0) - digests[look])
        pure = checks[look] == np.where(side > 0, _check(value), np.uint64(0) - _check(value))
        look, side, value, owner = look[pure], side[pure], value[pure], text_of[look[pure]]
        if not len(look):
            break
        _, first = np.unique(mix(value) + owner.astype(np.uint64), return_index=True)
        side, value, owner = side[first], value[first], owner[first]
        found.append(value)
        owners.append(owner)
        sides.append(side)
        signed = np.where(side > 0, value, np.uint64(0) - value)
        signed_check = np.where(side > 0, _check(value), np.uint64(0) - _check(value))
        touched = []
        for table in range(TABLES):
            at = _places(value, owner, cells, base, table)
            np.add.at(count, at, -side)
            np.subtract.at(digests, at, signed)
            np.subtract.at(checks, at, signed_check)
            touched.append(at)
        look = np.unique(np.concatenate(touched))
    rest = (count != 0) | (digests != 0) | (checks != 0)
    failed = np.bincount(text_of[rest], minlength=len(cells)) > 0
    none = np.zeros(0, np.int64)
    join = lambda x, kind: np.concatenate(x) if x else none.astype(kind)
    return join(found, np.uint64), join(owners, np.int64), join(sides, np.int64), failed


class Parts:
    """Digests of the parts of many texts, in the order of the texts."""

    def __init__(self, texts: list[str]):
        data, offsets = text_bytes(pa.array(texts, pa.large_string()))
        starts, ends, owner = runs(~SPACE[data], offsets)
        line = np.cumsum(data == 10)
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (line[starts[1:]] != line[starts[:-1]])
        heads = np.flatnonzero(new)
        number = np.arange(len(starts)) - heads[np.cumsum(new) - 1] if len(starts) else starts
        first = np.flatnonzero(number % PART_WORDS == 0)
        last = np.append(first[1:], len(starts))[: len(first)] - 1
        digests, owner = Spans(data).hash(starts[first], ends[last]), owner[first]
        # Equal parts of a text are told apart by how many came before.
        order = np.lexsort((digests, owner))
        d, o = digests[order], owner[order]
        same = np.zeros(len(d), dtype=bool)
        same[1:] = (d[1:] == d[:-1]) & (o[1:] == o[:-1])
        at = np.arange(len(d))
        earlier = at - np.maximum.accumulate(np.where(same, 0, at)) if len(d) else at
        digests = digests.copy()
        digests[order] = mix(d + earlier.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.digests, self.owner = digests, owner
        self.counts = np.bincount(owner, minlength=len(texts))
        self.before = np.concatenate([[0], np.cumsum(self.counts)])

    def of(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Digests of some texts, and which of them each belongs to."""
        counts = self.counts[texts]
        owner = np.repeat(np.arange(len(texts)), counts)
        at = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner] + self.before[texts][owner]
        return self.digests[at], owner


def difference(parts: Parts, one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests that text one[i] and text other[i] don't share, with i and the side (+1, -1), by peeling."""
    found = []
    left, cells = np.arange(len(one)), LEAST_CELLS
    while len(left):
        sizes = np.full(len(left), cells)
        a, b = sketch(*parts.of(one[left]), sizes), sketch(*parts.of(other[left]), sizes)
        digests, owner, sides, failed = peel(a.minus(b))
        whole = ~failed[owner]
        found.append((digests[whole], left[owner[whole]], sides[whole]))
        left, cells = left[failed], cells * 2
    digests, owner, sides = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((digests, owner))
    return digests[order], owner[order], sides[order]


def fingerprints(parts: Parts, texts: np.ndarray) -> list[str]:
    held = sketch(*parts.of(texts), np.full(len(texts), LEAST_CELLS))
    size = TABLES * LEAST_CELLS
    cell = np.dtype([("count", "<i4"), ("digests", "<u8"), ("checks", "<u4")])
    rows = np.zeros((len(texts), size), dtype=cell)
    rows["count"] = held.count.reshape(-1, size)
    rows["digests"] = held.digests.reshape(-1, size)
    rows["checks"] = (held.checks & np.uint64(0xFFFFFFFF)).reshape(-1, size)
    return [base64.b64encode(row.tobytes()).decode() for row in rows]


def likeness(parts: Parts, one: np.ndarray, other: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Dice likeness, from the owners of the digests that aren't shared."""
    both = parts.counts[one] + parts.counts[other]
    return np.where(both == 0, 1.0, (both - np.bincount(owner, minlength=len(one))) / np.maximum(both, 1))


def _lists(digests: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, digests.view(np.int64))


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    n = len(texts)
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    parts = Parts(texts + changed + following)
    own = np.arange(n)
    digests, owner, sides = difference(parts, own, own + n)
    _, next_owner, _ = difference(parts, own, own + 2 * n)
    prints = fingerprints(parts, np.arange(2 * n))
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            "fingerprint": pa.array(prints[:n]),
            "edited_fingerprint": pa.array(prints[n:]),
            "near_edited": pa.array(likeness(parts, own, own + n, owner)),
            "near_next": pa.array(likeness(parts, own, own + 2 * n, next_owner)),
            "n_parts": pa.array(parts.counts[own]),
            "edited_parts": pa.array(parts.counts[own + n]),
            "removed": _lists(digests[sides > 0], owner[sides > 0], n),
            "added": _lists(digests[sides < 0], owner[sides < 0], n),
        }
    )


def _in_order(batches):
    """Rows come by range and id; a range's last row is followed by the next range's first."""
    ids, texts, following, held = [], [], [], 0
    pending = None  # the row whose successor is still to come
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("part", "lead", "doc_id", "text"))
        for part, lead, doc_id, text in zip(*columns, strict=True):
            text = text or ""
            if pending is not None and pending[0] == part:
                ids.append(pending[1])
                texts.append(pending[2])
                following.append(text)
                held += len(pending[2]) + len(text)
                if held >= STEP_BYTES:
                    yield _compare(ids, texts, following)
                    ids, texts, following, held = [], [], [], 0
            pending = None if lead else (part, doc_id, text)
    if ids:
        yield _compare(ids, texts, following)


OUTPUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_parts long, edited_parts long, removed array<long>, added array<long>"
)


def fingerprint_versions(documents: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness.

    Texts are shuffled once, into ranges of ids of about ``range_bytes`` each, or larger ones
    beyond ``MOST_RANGES``. The first row of each range is also sent to the range before it.
    """
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    narrow = narrow.withColumn("place", F.coalesce("doc_id", F.lit(FIRST_ID)))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(max(1, -(-total // range_bytes)), MOST_RANGES)
    steps = [i / ranges for i in range(1, ranges)] or [0.5]
    bounds = narrow.agg(F.percentile_approx("place", steps, 100_000)).first()[0] or []
    bounds = np.unique(np.array(bounds, dtype=np.int64))

    @F.pandas_udf("int")
    def part_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, place.to_numpy(), side="left").astype(np.int32))

    firsts = narrow.select(part_of("place").alias("part"), "place").groupBy("part").agg(F.min("place").alias("place"))
    firsts = sorted((r["part"], r["place"]) for r in firsts.collect())  # one row for each range
    before = {place: firsts[i - 1][0] for i, (_, place) in enumerate(firsts)}

    @F.pandas_udf("array<struct<part:int,lead:boolean>>")
    def routes(place: pd.Series) -> pd.Series:
        parts = np.searchsorted(bounds, place.to_numpy(), side="left")
        return pd.Series(
            [
                [{"part": int(p), "lead": False}] + ([{"part": before[x], "lead": True}] if x in before else [])
                for p, x in zip(parts, place, strict=True)
            ]
        )

    routed = narrow.select("doc_id", "text", "place", F.explode(routes("place")).alias("route"))
    routed = routed.select("route.part", "route.lead", "place", "doc_id", "text")
    ordered = routed.repartition("part").sortWithinPartitions("part", "lead", "place", F.col("text").asc_nulls_first())
    return ordered.drop("place").mapInArrow(_in_order, OUTPUT)


def op2_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_versions(spark.read.parquet(f"{sf_dir}/documents.parquet"))
