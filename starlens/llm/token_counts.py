"""Token counts of whole texts; huge ones are encoded in overlapping chunks and spliced.

Chunks are encoded with offsets. Two neighbours are joined at a boundary inside their
overlap that is proven stable: the text has a space before a character which isn't white
space there, no token of either chunk crosses it, and both chunks have the same tokens
from it to the next such place. The pattern of byte-level tokenizers always starts a
piece there, so what comes before can't change what comes after. If no boundary of the
overlap is stable, the overlap is doubled; when it reaches the last proven boundary, the
chunk itself grows. A text without any such place is thus encoded whole.

Defined results: null and empty texts have 0 bytes and 0 tokens. Rows are counted one by
one, repeated or not, and without regard to their id; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.arrays import slices
from starlens.llm.encode import PIECE_START, tokenizer_path, word_encoder

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
TOKEN_LIMIT = 512

#: Ids, start and end offsets of the tokens of one piece of text.
Encoded = tuple[np.ndarray, np.ndarray, np.ndarray]


def library_encode(library, text: str) -> Encoded:
    found = library.encode(text, add_special_tokens=False)
    at = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)
    return np.array(found.ids, dtype=np.int64), at[:, 0], at[:, 1]


def _between(found: Encoded, base: int, start: int, end: int) -> np.ndarray | None:
    """Ids of the tokens from start to end, or None if a token crosses either."""
    ids, first, last = found
    for place in (start, end):
        if np.any((first + base < place) & (last + base > place)):
            return None
    return ids[(first + base >= start) & (last + base <= end)]


def stable_boundary(text: str, left: Encoded, left_at: int, right: Encoded, right_at: int, end: int) -> int | None:
    """A place in text[right_at:end] at which both encodings may be spliced."""
    places = [right_at + m.start() for m in PIECE_START.finditer(text[right_at : end + 1])]
    places = [p for p in places if right_at < p < end]
    middle = (right_at + end) // 2
    for place, following in sorted(zip(places, places[1:], strict=False), key=lambda x: abs(x[0] - middle)):
        one, other = _between(left, left_at, place, following), _between(right, right_at, place, following)
        if one is not None and other is not None and len(one) and np.array_equal(one, other):
            return place
    return None


def count_in_chunks(
    text: str, encode: Callable[[str], Encoded], chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> tuple[int, int]:
    """Tokens of the text, and how many times an overlap, or with it the chunk, had to be widened."""
    total = widened = 0
    proven = at = 0  # tokens before ``proven`` are counted; the chunk starts at ``at``
    end = min(len(text), chunk)
    left = encode(text[:end])
    while end < len(text):
        # A boundary can only be at a space, so the overlap reaches beyond the last one.
        last = text.rfind(" ", proven + 1, end)
        width = max(overlap, end - last + overlap // 2)
        while True:
            start = max(end - width, proven)
            if start == proven or last < 0:  # no stable boundary: a chunk twice as long
                at, end = proven, min(len(text), proven + max(chunk, 2 * (end - proven)))
                left = encode(text[at:end])
                widened += 1
                break
            until = min(len(text), end + chunk)
            right = encode(text[start:until])
            place = stable_boundary(text, left, at, right, start, end)
            if place is not None:
                total += int(np.sum((left[1] + at >= proven) & (left[2] + at <= place)))
                proven, at, end, left = place, start, until, right
                break
            width *= 2
            widened += 1
    total += int(np.sum(left[1] + at >= proven))
    return total, widened


def count_tokens(
    documents: DataFrame,
    path: str | None = None,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """doc_id, n_bytes and n_tokens of each document, as the tokenizer's library counts."""
    path = path or tokenizer_path()

    def run(batches):
        encoder = word_encoder(path)
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            # A special string may lie across a place that looks like a boundary: whole text.
            huge = [len(t) > chunk_chars and not any(s in t for s in encoder.special) for t in texts]
            short = encoder.batch(["" if h else t for t, h in zip(texts, huge, strict=True)])
            counts = [
                count_in_chunks(t, lambda x: library_encode(encoder.library, x), chunk_chars, overlap_chars)[0]
                if h
                else len(ids) // encoder.kind.itemsize
                for t, h, ids in zip(texts, huge, short, strict=True)
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                }
            )

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    counted = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
