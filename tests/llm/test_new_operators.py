"""Packing, lexical search and whitening against brute force and their contracts."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
from checks.compare import connect
from starlens.llm import decontamination, encode, lexical_search, packing, secrets, token_counts, whitening
from starlens.llm.queries import ready

LONG = "alpha beta gamma delta " * 4000
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One two"), (6, LONG), (7, LONG), (8, "same words here again"),
    (8, "same words here again"), (None, "no id at all but some words"), (None, None), (9, "Zwölf Boxkämpfer 北京"),
]
CLASHING = "doc_id long, text string, length int, part int, nth int, _base int, _rank int, sequence_id int, n int, v int"


@pytest.fixture(scope="module")
def odd(spark):
    ready(spark)
    return spark.createDataFrame([(i, t, 0, 0, 0, 0, 0, 0, 0, 0) for i, t in ODD], CLASHING)


# Packing


def tokens(texts):
    library = Tokenizer.from_file(encode.tokenizer_path())
    found = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*f.ids, packing.END_ID] for f in found]


def check_packing(rows, documents):
    """Every token of every document once, in its place, in sequences without holes."""
    expected = Counter()
    for (doc_id, _), ids in zip(documents, tokens(t for _, t in documents), strict=True):
        start = 0
        for piece in range(-(-len(ids) // 1024)):
            end = len(ids) - 1024 * (-(-len(ids) // 1024) - 1 - piece)
            own = np.array(ids[start:end], dtype="<u4").tobytes()
            expected[(doc_id, piece, start, end - start, zlib.crc32(own))] += 1
            start = end
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in held.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    return held


def test_packing_of_the_small_table(spark, small):
    rows = driver.queries()["op11_packing"](spark, small).collect()
    documents = duckdb.sql(f"select doc_id, text from '{small}/documents.parquet'").fetchall()
    held = check_packing(rows, documents)
    assert len(held) <= 1.02 * sum(r["length"] for r in rows) / 1024 + 1


def test_packing_of_odd_rows_and_real_sequences(spark, odd, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    rows = packing.op11_packing(spark, str(tmp_path)).collect()
    held = check_packing(rows, ODD)
    packed = packing.pack(odd)
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    assert len(whole) == len(held)
    for r in packed.collect():
        ids = whole[r["sequence_id"]]["ids"]
        assert ids[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == r["ids"]
    assert packing.place(packing.pieces(odd.limit(0))).count() == 0


def best_fit_decreasing(counts):
    gaps, used = Counter(), 0
    for item in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fits = [g for g, n in gaps.items() if n and g >= item]
        gap = min(fits, default=1024)
        if fits:
            gaps[gap] -= 1
        else:
            used += 1
        gaps[gap - item] += 1
    return used


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_each_length_as_often_as_it_occurs(seed):
    rng = np.random.default_rng(seed)
    drawn = [
        np.minimum(1024, rng.lognormal(5, 1.2, 1500)), rng.integers(1, 30, 3000), rng.integers(300, 1025, 800),
        np.full(900, 511),
    ][seed]
    counts = Counter(int(x) or 1 for x in drawn)
    groups = packing.plan(counts)
    used = Counter()
    for n, held in groups:
        assert n > 0 and sum(length * repeats for length, repeats in held) <= 1024
        for length, repeats in held:
            used[length] += n * repeats
    assert used == counts
    assert sum(n for n, _ in groups) <= best_fit_decreasing(counts)


def test_exact_combinations_beat_best_fit():
    # Best fit puts the longest length into each gap; only these triples fill them.
    counts = {500: 10, 310: 10, 204: 10, 10: 10}
    assert sum(n for n, _ in packing.plan(counts)) == 10
    assert packing.Complements({400: 1, 200: 1}, 1024).exact(600) == (400, 200)
    assert packing.Complements({200: 2}, 1024).exact(600) is None
    assert packing.Complements({200: 3}, 1024).exact(600) == (200, 200, 200)
    assert packing.plan({}) == []
    # A plan doesn't depend on how many documents there are, only on their lengths.
    assert len(packing.plan({x: 10**9 + x * x for x in range(1, 1025, 7)})) < 1024


# Lexical search


def brute_search(documents, items, top=10):
    def terms(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)

    held = [(doc_id, Counter(terms(t))) for doc_id, t in documents]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for key, text in items:
        scored = []
        for doc_id, counts in held:
            m = 25 + (75 * sum(counts.values()) * n) // total
            score = sum(
                k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t, k in Counter(terms(text)).items()
                if counts[t]
            )
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(key, rank, doc_id, -s) for rank, (s, _, doc_id) in enumerate(scored[:top], 1)]
    return sorted(out, key=str)


def ranked(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_lexical_search_against_sql(spark, small):
    found = driver.queries()["op12_lexical_search"](spark, small)
    expected = connect(small).execute(driver.oracle_sql()["op12_lexical_search"])
    names = [d[0] for d in expected.description]
    assert ranked(found) == sorted(
        ((r[names.index("item_id")], r[names.index("rank")], r[names.index("doc_id")], r[names.index("score")])
         for r in expected.fetchall()), key=str)


def test_lexical_search_of_odd_rows(spark, odd, tmp_path):
    items = [(1, "one TWO words"), (2, None), (3, ""), (4, "nothing-holds-this"), (5, "北京 Zwölf"), (6, LONG), (7, "again again")]
    queries = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, score int")
    assert ranked(lexical_search.search_documents(spark, odd, queries)) == brute_search(ODD, items)
    assert lexical_search.search_documents(spark, odd.limit(0), queries).count() == 0
    assert lexical_search.search_documents(spark, odd, queries.limit(0)).count() == 0


def test_lexical_search_over_many_shards_blocks_and_tables(spark, monkeypatch, tmp_path):
    """Ties, long intervals, several shards in a task and several blocks of queries."""
    ready(spark)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    share = 1 / np.arange(1, 61)
    share /= share.sum()
    documents = [(i, " ".join(rng.choice(words, int(rng.integers(1, 30)), p=share))) for i in range(700)]
    documents += [(700 + i, "w1 w2 w3 w59") for i in range(40)]
    items = [(i, " ".join(rng.choice(words, 12))) for i in range(25)] + [(99, "w59 w3")]
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    queries = spark.createDataFrame(items, "item_id long, text string")
    expected = brute_search(documents, items)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 60)
    for shard_bytes in (2_000, 10**9):
        lexical_search.build_index(frame, f"{tmp_path}/{shard_bytes}", shard_bytes)
        assert ranked(lexical_search.search(spark, f"{tmp_path}/{shard_bytes}", queries)) == expected


def test_blocks_are_bounded():
    asked = [(i, " ".join(f"t{i}x{j}" for j in range(50))) for i in range(20)]
    found = list(lexical_search.blocks(iter(asked), 120))
    assert [len(b) for b in found] == [2] * 10


def test_range_maxima():
    rng = np.random.default_rng(4)
    impacts = rng.integers(0, 9, 200)
    postings = lexical_search.Postings(np.arange(200), impacts, 200)
    start = rng.integers(0, 200, 500)
    end = np.minimum(200, start + rng.integers(0, 60, 500))
    found = postings.largest(start, end)
    for a, b, at in zip(start, end, found, strict=True):
        assert at == (a + int(impacts[a:b].argmax()) if b > a else -1)


# Whitening


def exact_polynomial(matrix):
    """Coefficients of det(x - matrix) by traces of powers, lowest power first."""
    d = len(matrix)
    m = np.array([[Fraction(x) for x in row] for row in matrix])
    power, coefficients = np.array([[Fraction(0)] * d] * d), [Fraction(1)]
    for k in range(1, d + 1):
        power = m @ (power + np.diag([coefficients[-1]] * d))
        coefficients.append(-sum(power[i, i] for i in range(d)) / k)
    return [int(c) for c in reversed(coefficients)]


def scatter(rows):
    y = np.array(rows, dtype=object)
    return (len(y) * (y.T @ y) - np.outer(y.sum(axis=0), y.sum(axis=0))).tolist()


@pytest.mark.parametrize("kind", ["full", "rank", "zeros", "equal", "single"])
def test_polynomial_is_exact(spark, kind):
    ready(spark)
    rng = np.random.default_rng(5)
    rows = rng.integers(-500, 500, (40, 7))
    if kind == "rank":
        rows[:, 3:] = rows[:, :4] * 2
    if kind == "zeros":  # Hessenberg reduction has to look for pivots
        rows = np.zeros((14, 7), dtype=int)
        for i in range(7):
            rows[2 * i, i], rows[2 * i, (i + 3) % 7] = i + 1, 2
    if kind == "equal":
        rows = np.vstack([np.eye(7, dtype=int) * 10, -np.eye(7, dtype=int) * 10])
    matrix = [[5]] if kind == "single" else scatter(rows)
    assert whitening.characteristic_polynomial(spark, matrix) == exact_polynomial(matrix)


def test_roots_and_components_of_repeated_and_close_roots(spark):
    ready(spark)
    rng = np.random.default_rng(6)
    base = rng.integers(-9, 9, (6, 6))
    rotated = (base @ base.T).astype(object)
    for matrix in (
        np.diag([7, 7, 7, 3, 0, 0]).astype(object),
        rotated,
        np.diag([10**18, 10**18 - 1, 10**18 - 1, 5, 1, 0]).astype(object),
    ):
        polynomial = whitening.characteristic_polynomial(spark, matrix.tolist())
        roots, s = whitening.largest_roots(polynomial, sum(matrix[i, i] for i in range(6)), 8)
        rank = np.linalg.matrix_rank(matrix.astype(float)) if matrix is rotated else int((np.diag(matrix) != 0).sum())
        assert len(roots) == rank and roots == sorted(roots, reverse=True)
        found = whitening.components(matrix.tolist(), roots, s)
        assert np.abs(found @ found.T - np.eye(rank)).max() < 1e-14
        values = [r / (1 << s) for r in roots]
        error = matrix.astype(float) @ found.T - found.T * values
        assert np.abs(error).max() <= 1e-14 * values[0]


def expected_whitening(rows):
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64).astype(object) + 100_000
    n, sums = len(x), x.sum(axis=0)
    deviation = [int(sum((n * a - b) ** 2 for a, b in zip(row, sums, strict=True))) for row in x]
    values, vectors = np.linalg.eigh(np.array(scatter(x), dtype=float) / n**2)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    return deviation, (x - sums / n).astype(float) @ vectors / np.sqrt(values), values


def test_whitening_of_the_small_table(spark, small):
    rows = duckdb.sql(f"select vec_id, embedding from '{small}/embeddings.parquet' order by vec_id").fetchall()
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    found = driver.queries()["op13_whitening"](spark, small).orderBy("vec_id", "component").collect()
    deviation, white, values = expected_whitening(rows)
    assert [(r["vec_id"], r["component"]) for r in found] == [(i, k) for i, _ in rows for k in range(1, 9)]
    assert [r["deviation"] for r in found[::8]] == deviation
    assert {r["n"] for r in found} == {len(rows)}
    assert np.abs(np.abs([r["whitened"] for r in found]) - np.abs(white).ravel()).max() < 1e-9
    assert {r["identity_error"] for r in found}.pop() < 1e-9
    trace = sum(np.var(np.floor(1024 * np.array([v for _, v in rows])), axis=0))
    assert np.allclose([r["explained"] for r in found[:8]], values / trace, rtol=1e-9)


def test_whitening_drops_unusable_rows_and_takes_any_width(spark):
    ready(spark)
    schema = "vec_id long, embedding array<double>, n int, id int, v int, component string"
    rows = [
        (1, [0.5, 1.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (6, [1e300, 0.0]),
        (7, []), (None, [2.0]), (1, [0.5, 1.0]), (8, [-1.0, 3.0]),
    ]
    frame = spark.createDataFrame([(i, v, 0, 0, 0, "") for i, v in rows], schema)
    found = whitening.whiten(frame).collect()
    kept = [(1, [0.5, 1.0]), (7, [0.0, 0.0]), (None, [2.0, 0.0]), (1, [0.5, 1.0]), (8, [-1.0, 3.0])]
    deviation, white, _ = expected_whitening(kept)
    assert Counter((r["vec_id"], r["deviation"], int(r["deviation_decimal"])) for r in found if r["component"] == 1) == Counter(
        (i, d, d) for (i, _), d in zip(kept, deviation, strict=True)
    )
    assert sorted(round(abs(r["whitened"]), 9) for r in found) == sorted(np.abs(white).round(9).ravel())
    assert max(r["identity_error"] for r in found) < 1e-12
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.whiten(frame.where("vec_id = 1")).count() == 0  # equal vectors have no variance
    # Large entries: exact sums in limbs, a deviation beyond a long.
    large = spark.createDataFrame([(i, [i * 1e15, -i * 7e14, float(i % 3)]) for i in range(6)], "vec_id long, embedding array<double>")
    expected, _, _ = expected_whitening([(i, [i * 1e15, -i * 7e14, float(i % 3)]) for i in range(6)])
    rows = whitening.whiten(large).where("component = 1").orderBy("vec_id").collect()
    assert [r["deviation"] for r in rows] == [None] * 6
    assert [r["deviation_decimal"] is None or int(r["deviation_decimal"]) == e for r, e in zip(rows, expected, strict=True)] == [True] * 6


def test_products_are_exact_for_any_size():
    rng = np.random.default_rng(7)
    for largest in (3, 2**20 - 1, 2**40, 2**62):
        y = rng.integers(-largest, largest, (50, 4))
        assert (whitening.products(y) == y.astype(object).T @ y.astype(object)).all()


# Earlier operators: cases that were missed


def test_items_that_are_short_unspaced_or_oddly_spaced_are_found(spark):
    ready(spark)
    item = "A baker sells twelve loaves at three dollars each; how much money does the baker earn in total today"
    bench = spark.createDataFrame(
        [(1, "Name the largest planet"), (2, "光合作用把二氧化碳变成什么物质"), (3, item), (4, "Yes"), (5, "Who was Ada Lovelace")],
        "item_id long, text string",
    )
    rows = [
        (1, "Quiz night. Name the largest planet! Then we went home."),
        (2, "题目:光合作用把二氧化碳变成什么物质?请回答。"),
        (3, "x " + item.replace(" ", " ") + " y"),
        (4, "x " + item.replace(" ", " ") + " y"),
        (5, item.replace("each; how", "each – how")),
        (6, "Yes, we name the planets and largest moons, yes."),
        (7, "So who was Ada Lovelace, they asked."),
        (8, "So who was Alan Turing, they asked."),
        (9, "光合作用很重要,但是物质很多"),
    ]
    found = decontamination.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (2, 2), (3, 3), (4, 3), (5, 3), (7, 5)}


def test_chunks_of_unspaced_texts_are_encoded_a_few_times_only():
    library = Tokenizer.from_file(encode.tokenizer_path())
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghij"))
    spaced_out = "".join(rng.choice(letters, 30_000)) + " some words in between " * 300 + "".join(rng.choice(letters, 20_000))
    for text in ("".join(rng.choice(letters, 60_000)), spaced_out, "word " * 9000):
        sizes = []

        def counted(part, sizes=sizes):
            sizes.append(len(part))
            return token_counts.library_encode(library, part)

        total, _ = token_counts.count_in_chunks(text, counted, 2_000, 200)
        assert total == len(library.encode(text, add_special_tokens=False).ids)
        assert sum(sizes) <= 4 * len(text)


def test_merged_spans_equal_a_comparison_of_all_pairs():
    rng = np.random.default_rng(9)
    for _ in range(200):
        base = [("hex", int(a), int(a + n)) for a, n in zip(rng.integers(0, 40, 4), rng.integers(1, 9, 4), strict=True)]
        more = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 40, 9), rng.integers(1, 9, 9), strict=True)]
        held = [(b, f) for _, b, f in base]
        kept = [
            (s, e) for s, e in more
            if not any(b <= s and e <= f for b, f in held) and not any(b <= s and e <= f and (b, f) != (s, e) for b, f in more)
        ]
        assert [x[1:] for x in secrets.merge(base, more) if x[0] == "random"] == sorted(kept)
    many = [(20 * i, 20 * i + 30) for i in range(100_000)]
    assert len(secrets.merge([], many)) == 100_000
