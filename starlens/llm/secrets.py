"""Secret scans: base patterns, and a battery of randomness tests over long tokens.

Base patterns (assignments, access keys, long hex runs) are taken as they are. Besides,
runs of ``TOKEN`` characters are cut into candidates of ``LEAST_LENGTH`` or more: "=" is
padding at a run's end and cuts it elsewhere, as in NAME=value. Of what no alphabet holds,
the parts between "_" and "-" are candidates, and those between "/" and "+"; where both
cuts find something, spans may overlap. The smallest
alphabet that holds a candidate's characters is its inferred encoding. Three tests ask whether its
characters look uniform and independent over that alphabet: chi-squared of their counts,
the number of runs above and below the middle, and serial correlation at lag one. Their
p-values are combined by Fisher's method; candidates that fail are dropped.

What passes may still be an ordinary word. Its p-value as ordinary text is bounded by the
likelihood ratio of corpus character frequencies to uniform ones (Markov's inequality), so
longer tokens bring more evidence. Within each class of lengths, the Benjamini-Hochberg
step-up rule over all candidates of the corpus keeps the share of false discoveries at
``FALSE_DISCOVERIES`` or below.

Defined results: a null or empty text has no spans. Rows are scanned one by one, repeated
or not, and without regard to their id. Other columns are not looked at. In a corpus
without candidates nothing is added.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.arrays import LOWER, runs, slices, text_bytes
from starlens.session import scratch_path

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Every assignment holds one of these in lower case.
HINTS = (b"passw", b"secret", b"token", b"api")

LEAST_LENGTH = 20
UNIFORM_LEVEL = 1e-3
FALSE_DISCOVERIES = 1e-3
DECIMAL, LOWERS, UPPERS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TOKEN = LOWERS + UPPERS + DECIMAL + "+/_-="
ENCODINGS = {
    "decimal": DECIMAL,
    "hex": DECIMAL + "abcdef",
    "hex_upper": DECIMAL + "ABCDEF",
    "base32": UPPERS + "234567",
    "lower": DECIMAL + LOWERS,
    "upper": DECIMAL + UPPERS,
    "base62": DECIMAL + UPPERS + LOWERS,
    "base64": UPPERS + LOWERS + DECIMAL + "+/",
    "base64url": UPPERS + LOWERS + DECIMAL + "-_",
}


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in characters]] = True
    return out


IN_TOKEN, IN_HEX = _table(TOKEN), _table(ENCODINGS["hex"])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, by start and then kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return in_order(found)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


@cache
def _symbols(encoding: str) -> dict[str, int]:
    return {c: i for i, c in enumerate(ENCODINGS[encoding])}


def infer_encoding(token: str) -> str | None:
    """The smallest alphabet that holds the token (without padding)."""
    held = set(token.rstrip("="))
    return next((name for name, characters in ENCODINGS.items() if held and held <= set(characters)), None)


#: A value of a run with its padding, and the cuts of values that mix alphabets.
VALUE = re.compile(r"[^=]+(?:=+\Z)?")
CUTS = (re.compile(r"[^_-]+"), re.compile(r"[^/+]+"))


def pieces(run: str) -> list[tuple[int, int]]:
    """Spans of the candidates in a run of token characters, by start and end."""
    found = set()
    for value in VALUE.finditer(run):
        if len(value[0]) < LEAST_LENGTH:
            continue
        if infer_encoding(value[0]) is not None:
            found.add(value.span())
            continue
        for cut in CUTS:
            found.update(m.span() for m in cut.finditer(run, *value.span()) if len(m[0]) >= LEAST_LENGTH)
    return sorted(found)


def _normal_tail(z: float) -> float:
    """Two-sided p-value of a standard normal."""
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_tail(x: float, degrees: int) -> float:
    """Upper p-value of chi-squared, by the Wilson-Hilferty cube root."""
    scale = 2 / (9 * degrees)
    return 0.5 * math.erfc(((max(x, 0) / degrees) ** (1 / 3) - (1 - scale)) / math.sqrt(2 * scale))


def uniformity(token: str) -> float:
    """Combined p-value of the battery: small if the token doesn't look uniform."""
    encoding = infer_encoding(token)
    if encoding is None:
        return 0.0
    size = len(ENCODINGS[encoding])
    x = np.array([_symbols(encoding)[c] for c in token.rstrip("=")], dtype=float)
    n = len(x)
    counts = np.bincount(x.astype(int), minlength=size)
    chi = float(((counts - n / size) ** 2).sum() / (n / size))
    tails = [_chi_tail(chi, size - 1)]
    above = x >= size / 2
    a = int(above.sum())
    if 0 < a < n:
        number = 1 + int((above[1:] != above[:-1]).sum())
        mean = 1 + 2 * a * (n - a) / n
        spread = (mean - 1) * (mean - 2) / max(n - 1, 1)
        tails.append(_normal_tail((number - mean) / math.sqrt(spread)) if spread > 0 else 1.0)
    else:
        tails.append(min(1.0, 2.0 ** (1 - n)))
    centred = x - x.mean()
    power = float((centred**2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / power if power else 1.0
    tails.append(_normal_tail(serial * math.sqrt(n)))
    total = -2 * sum(math.log(max(t, 1e-300)) for t in tails)
    half = total / 2  # chi-squared with six degrees of freedom has a closed form
    return math.exp(-half) * (1 + half + half * half / 2)


@dataclass(frozen=True)
class Rule:
    """Log frequencies of characters in the corpus, and the largest log p-value per class."""

    logs: np.ndarray
    largest: dict[int, float]

    def ordinary(self, token: str) -> float:
        """Log of the p-value as ordinary text (0 if the battery already rejects it)."""
        encoding = infer_encoding(token)
        if encoding is None or uniformity(token) < UNIFORM_LEVEL:
            return 0.0
        codes = np.frombuffer(token.rstrip("=").encode("ascii"), dtype=np.uint8)
        return min(0.0, float(self.logs[codes].sum() + len(codes) * math.log(len(ENCODINGS[encoding]))))

    def keeps(self, token: str) -> bool:
        return self.ordinary(token) <= self.largest.get(length_class(token), -math.inf)


def length_class(token: str) -> int:
    return len(token).bit_length()


def _flagged(data: np.ndarray, offsets: np.ndarray) -> tuple[set[int], dict[int, list[tuple[int, int]]]]:
    """Texts that may hold a base span, and byte spans of long runs of token characters by text."""
    lower = LOWER[data].tobytes()
    hits = []
    for hint in HINTS:
        at = lower.find(hint)
        while at >= 0:
            hits.append(at)
            at = lower.find(hint, at + 1)
    plain, at = data.tobytes(), -1
    while (at := plain.find(b"AKIA", at + 1)) >= 0:
        hits.append(at)
    texts = set((np.searchsorted(offsets, np.array(hits, dtype=np.int64), side="right") - 1).tolist())
    starts, ends, owner = runs(IN_HEX[data], offsets)
    texts.update(owner[ends - starts >= 24].tolist())
    starts, ends, owner = runs(IN_TOKEN[data], offsets)
    long = ends - starts >= LEAST_LENGTH
    spans: dict[int, list[tuple[int, int]]] = {}
    for s, e, o in zip(starts[long].tolist(), ends[long].tolist(), owner[long].tolist(), strict=True):
        spans.setdefault(o, []).append((s, e))
    return texts, spans


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
CANDIDATE = pa.struct([("token", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
FOUND = (
    "is_doc boolean, doc_id long, spans array<struct<kind:string,start:long,end:long>>, "
    "candidates array<struct<token:string,start:long,end:long>>, characters array<long>"
)


def _rows(ids, spans, candidates, characters=None) -> pa.RecordBatch:
    n = len(spans)
    return pa.RecordBatch.from_pydict(
        {
            "is_doc": pa.array([characters is None] * n),
            "doc_id": ids if ids is not None else pa.nulls(n, pa.int64()),
            "spans": pa.array(spans, pa.list_(SPAN)),
            "candidates": pa.array(candidates, pa.list_(CANDIDATE)),
            "characters": pa.array([characters] * n, pa.list_(pa.int64())),
        }
    )


def _scan(batches):
    characters = np.zeros(256, dtype=np.int64)
    for batch in slices(batches, "text"):
        texts = batch.column("text")
        data, offsets = text_bytes(texts)
        characters += np.bincount(data, minlength=256)
        flagged, held = _flagged(data, offsets)
        spans, candidates = [[] for _ in range(len(texts))], [[] for _ in range(len(texts))]
        for i in flagged | held.keys():
            text = texts[i].as_py() or ""
            if i in flagged:
                spans[i] = [{"kind": k, "start": s, "end": e} for k, s, e in base_spans(text)]
            if i in held:
                own = data[offsets[i] : offsets[i + 1]]
                points = np.cumsum((own & 0xC0) != 0x80)  # code points up to each byte
                for s, e in held[i]:
                    first = int(points[s - offsets[i]]) - 1
                    for a, b in pieces(text[first : first + e - s]):
                        start, end = first + a, first + b
                        candidates[i].append({"token": text[start:end], "start": start, "end": end})
        yield _rows(batch.column("doc_id"), spans, candidates)
    yield _rows(None, [[]], [[]], characters.tolist())


def scan(documents: DataFrame) -> DataFrame:
    """Base spans and candidates of each document, and character counts of each task."""
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(_scan, FOUND)


def character_logs(found: DataFrame) -> np.ndarray:
    """Log frequencies of all characters of tokens over the whole corpus."""
    each = found.where(~F.col("is_doc")).select(F.posexplode("characters").alias("code", "n"))
    counts = np.ones(256)
    for row in each.groupBy("code").agg(F.sum("n").alias("n")).collect():  # 256 rows at most
        counts[row["code"]] += row["n"]
    return np.log(counts / counts[IN_TOKEN].sum())


def false_discovery_rule(found: DataFrame, logs: np.ndarray, level: float = FALSE_DISCOVERIES) -> Rule:
    """Step-up thresholds per class of lengths, over all candidates of the corpus.

    P-values are counted in steps of a tenth of their natural logarithm, each rounded up.
    """
    bare = Rule(logs, {})

    def steps(batches):
        for batch in batches:
            tokens = batch.column("token").to_pylist()
            step = [max(-600, math.ceil(bare.ordinary(t) * 10)) for t in tokens]
            yield pa.RecordBatch.from_pydict(
                {
                    "length": pa.array([length_class(t) for t in tokens], pa.int32()),
                    "step": pa.array(step, pa.int32()),
                }
            )

    tokens = found.where("is_doc").select(F.explode("candidates.token").alias("token"))
    counts = tokens.mapInArrow(steps, "length int, step int").groupBy("length", "step").agg(F.count("*").alias("n"))
    by_length: dict[int, dict[int, int]] = {}
    for row in counts.collect():  # a bounded number of classes and steps
        by_length.setdefault(row["length"], {})[row["step"]] = row["n"]
    largest = {}
    for length, own in by_length.items():
        tests, seen = sum(own.values()), 0
        for step in sorted(own):
            seen += own[step]
            if math.exp(step / 10) * tests <= level * seen:
                largest[length] = step / 10
    return Rule(logs, largest)


def merge(base: list[tuple[str, int, int]], more: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Base spans and those added ones that don't lie within another one of either."""
    # By start, the longest first: what holds a span comes before it. Base spans come before equal ones.
    ordered = sorted([(b, -f, 0) for _, b, f in base] + [(b, -f, 1) for b, f in set(more)])
    furthest, within = -1, set()
    for start, end, kind in ordered:
        if kind and -end <= furthest:
            within.add((start, -end))
        furthest = max(furthest, -end)
    return in_order(base + [("random", *span) for span in more if span not in within])


def scan_secrets(documents: DataFrame) -> DataFrame:
    """Base counts and digest and all spans of every document, from one pass over the texts."""
    spark = documents.sparkSession
    folder = scratch_path(spark, "secrets")
    scan(documents).write.parquet(folder)
    found = spark.read.parquet(folder)
    rule = false_discovery_rule(found, character_logs(found))

    def decide(batches):
        for batch in batches:
            rows = batch.to_pylist()
            base = [[(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in rows]
            every = [
                merge(b, [(c["start"], c["end"]) for c in r["candidates"] if rule.keeps(c["token"])])
                for b, r in zip(base, rows, strict=True)
            ]
            count = lambda kind: pa.array([sum(s[0] == kind for s in b) for b in base], pa.int64())  # noqa: E731, B023
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_assign": count("assign"),
                    "n_access": count("access"),
                    "n_hex": count("hex"),
                    "base_sha256": pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base]),
                    "spans": pa.array([joined(e) for e in every]),
                }
            )

    rows = found.where("is_doc").select("doc_id", "spans", "candidates")
    return rows.mapInArrow(
        decide, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
