"""Rows told by id and text in the pipeline, and learnt models against plain loops."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from starlens.llm import decontamination, languages, mixing, near_duplicates, toxicity
from starlens.llm.keys import free_name
from starlens.llm.queries import ready

CLASHING = "_toxicity string, _mixing_key string, _mixing_copies long, _mixing_copy int, _row string, _id long, text_key string, digest string, class string"
VALUES = ("t", "k", 7, 8, "r", 9, "x", "d", "c")


def wordy(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), 7)) for _ in range(n))


def table(spark, rows):
    """Documents with columns named as helper columns are."""
    full = [(i, t, "en", "s", None, *VALUES) for i, t in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


def kept(frame):
    assert all(tuple(r)[5:] == VALUES for r in frame.collect())
    return Counter((r["doc_id"], r["text"]) for r in frame.collect())


def test_near_duplicate_stage_tells_rows_by_id_and_text(spark, small):
    ready(spark)
    base, clean, other = wordy(1, 60), wordy(2, 60), wordy(3, 50)
    rows = [
        (1, base), (2, base), (2, clean), (3, base + " more"),  # a clean text under a copy's id
        (4, other), (4, other), (4, other),  # repeated rows
        (5, clean + " end"),  # near the clean text of id 2
        (6, wordy(4, 40)), (6, wordy(4, 40) + " tail"),  # near copies under one id
        (7, ""), (7, ""), (8, None), (None, base), (None, base),
    ]
    found = kept(corpus_pipeline.drop_near_duplicates(spark, table(spark, rows), small))
    sixes = [t for (i, t) in found if i == 6]
    assert len(sixes) == 1 and found[(6, sixes[0])] == 1
    del found[(6, sixes[0])]
    assert found == Counter({(1, base): 1, (2, clean): 1, (4, other): 1, (7, ""): 2, (8, None): 1, (None, base): 2})
    assert near_duplicates.one_of_each(table(spark, []), 5, 80).collect() == []


def test_leak_stage_tells_rows_by_id_and_text(spark, tmp_path):
    ready(spark)
    item, clean = wordy(5, 30), wordy(6, 80)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"{clean} {item} {clean}"), (1, clean), (1, clean), (2, clean), (3, None), (None, item), (4, "")]
    found = kept(corpus_pipeline.drop_leaks(spark, table(spark, rows), str(tmp_path)))
    assert found == Counter({(1, clean): 2, (2, clean): 1, (3, None): 1, (None, item): 1, (4, ""): 1})
    assert decontamination.without_leaks(table(spark, []), spark.read.parquet(f"{tmp_path}/benchmark.parquet")).collect() == []


def test_toxicity_and_mixing_stages_pass_clashing_columns(spark, tmp_path):
    ready(spark)
    rows = [(i, wordy(i, 20) + " awful" * (i % 3 == 0)) for i in range(60)] + [(61, None), (None, "")]
    label = lambda i: (i, 0, int(i % 3 == 0))
    spark.createDataFrame(map(label, range(60)), "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = kept(corpus_pipeline.drop_toxic(spark, table(spark, rows), str(tmp_path)))
    clean = Counter(r for r in rows if "awful" not in (r[1] or ""))
    assert not clean - found and sum((found - clean).values()) <= 4  # of 20
    assert set(kept(mixing.repeated(table(spark, rows)))) == set(rows)
    assert free_name(["A", "a_"], "a") == "a__"


def test_classes_of_equal_sets_have_128_bits(spark):
    ready(spark)
    assert len(near_duplicates._digest(np.arange(3, dtype=np.uint64))) == 16
    rows = [(9, "a b c d"), (4, "A b  c d"), (5, "a b c e"), (3, "x y"), (2, "x y z")]
    found = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {9: (4, False), 4: (4, True), 5: (5, True), 3: (3, True), 2: (2, True)}


# Toxicity


def test_toxicity_forward_pass_against_a_plain_loop():
    rng = np.random.default_rng(3)
    network = toxicity.Network(2)
    p, s = network.p, toxicity.STATE
    vectors = rng.standard_normal((9, toxicity.WIDTH)).astype(np.float32)
    index, mask = rng.integers(0, 9, (5, 7)), np.ones((5, 7), np.float32)
    mask[1, 4:], mask[3, 1:] = 0, 0
    sigmoid = lambda x: 1 / (1 + math.exp(-x))

    def side(k, steps, row):
        h, out = [0.0] * s, {}
        for t in steps:
            x = vectors[index[row, t]].astype(float) @ p[f"in{k}"] + p[f"bias{k}"]
            u = np.array(h) @ p[f"back{k}"]
            z = [sigmoid(x[j] + u[j]) for j in range(s)]
            r = [sigmoid(x[s + j] + u[s + j]) for j in range(s)]
            new = [math.tanh(x[2 * s + j] + r[j] * u[2 * s + j]) for j in range(s)]
            h = [z[j] * h[j] + (1 - z[j]) * new[j] for j in range(s)]
            out[t] = h
        return out

    logits = network.forward(vectors, index, mask)[0]
    for row in range(5):
        steps = [t for t in range(7) if mask[row, t]]
        one, two = side(0, steps, row), side(1, steps[::-1], row)
        states = [np.array(one[t] + two[t]) for t in steps]
        weights = np.array([math.exp(float(np.tanh(h @ p["attend"]) @ p["weigh"])) for h in states])
        pooled = sum(w * h for w, h in zip(weights / weights.sum(), states, strict=True))
        assert abs(float(pooled @ p["out"]) + float(p["shift"][0]) - logits[row]) < 1e-4


def test_toxicity_shift_on_labels_that_cannot_be_learnt():
    logit, toxic = np.array([4.0, 3, 2, 1, 0, -1]), np.array([0, 0, 0, 0, 1, 1.0])
    assert not (logit + toxicity._shift(logit, toxic) > math.log(0.3 / 0.7)).any()
    assert (logit + toxicity._shift(logit, 1 - toxic) > math.log(0.3 / 0.7)).tolist() == [True] * 4 + [False] * 2
    assert toxicity._shift(np.array([np.nan, -np.inf]), np.array([1.0, 1])) == 0


def test_toxicity_of_a_text_is_that_of_its_worst_window():
    network = toxicity.Network(4)
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdef"), 5)) for _ in range(100)]
    starts = [*range(0, 100 - toxicity.WINDOW, toxicity.STRIDE)]
    starts.append(starts[-1] + toxicity.STRIDE)
    each = [toxicity._worst(network, [" ".join(words[a : a + toxicity.WINDOW])])[0] for a in starts]
    assert starts[-1] + toxicity.WINDOW >= 100
    assert abs(toxicity._worst(network, [" ".join(words)])[0] - max(each)) < 1e-5


def test_toxicity_learns_from_few_labels():
    """37 toxic texts to learn from; the German ones among the held-out texts have but two."""
    folder = "/root/testdata/sf0.01"
    rows = duckdb.sql(
        f"select doc_id, text, max(toxic) from '{folder}/documents.parquet' join '{folder}/labels.parquet' using (doc_id) "
        "where toxic in (0, 1) and text is not null group by all order by 1"
    ).fetchall()
    held = [zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows]
    learn, test = ([r for r, h in zip(rows, held, strict=True) if h == want] for want in (False, True))
    model = toxicity.train([r[1] for r in learn], np.array([r[2] for r in learn]))
    score, toxic = model.scores([r[1] for r in test]), np.array([r[2] for r in test]) == 1
    assert (score[toxic][:, None] > score[~toxic][None, :]).mean() > 0.85
    assert (score[toxic] >= toxicity.THRESHOLD).mean() > 0.6
    assert (score[~toxic] >= toxicity.THRESHOLD).mean() < 0.15


# Languages


def plain_counts(rows):
    """Words and n-grams by length (0: whole words) and language, those seen twice."""
    counts = [defaultdict(Counter) for _ in range(languages.LONGEST + 1)]
    for lang, text in rows:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            counts[0][word][lang] += 1
            for n in range(1, languages.LONGEST + 1):
                for i in range(len(word) - n + 1):
                    counts[n][word[i : i + n]][lang] += 1
    least = languages.LEAST_COUNT
    return [{k: {x: c for x, c in v.items() if c >= least} for k, v in t.items() if max(v.values()) >= least} for t in counts]


def plain_language(counts, names, text):
    totals = [{x: languages.SMOOTHING * len(t) + sum(v.get(x, 0) for v in t.values()) for x in names} for t in counts]
    log = lambda n, key, x: math.log((counts[n][key].get(x, 0) + languages.SMOOTHING) / totals[n][x])
    sums = dict.fromkeys(names, 0.0)
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        if word in counts[0]:
            parts, n = [word], 0
        else:
            for n in range(languages.LONGEST, 0, -1):
                parts = [word[i : i + n] for i in range(len(word) - n + 1) if word[i : i + n] in counts[n]]
                if parts:
                    break
        for x in names if parts else ():
            sums[x] += sum(log(n, k, x) for k in parts) / len(parts)
    best = max(sums.values())
    shares = {x: math.exp(v - best) for x, v in sums.items()}
    name = min(x for x in names if sums[x] == best)
    return name, shares[name] / sum(shares.values())


@pytest.mark.parametrize("seed", [0, 1])
def test_language_backoff_against_a_plain_loop(spark, seed):
    ready(spark)
    rng = np.random.default_rng(seed)
    letters = {"aa": "abcde", "bb": "cdefg", "cc": "efgha"}
    draw = lambda x: "".join(rng.choice(list(letters[x]), rng.integers(1, 9)))
    rows = [(i, " ".join(draw(x) for _ in range(6)), x) for i, x in enumerate(rng.choice(list(letters), 60).tolist())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = [(x, t) for i, t, x in rows if zlib.crc32(str(i).encode()) % 5]
    counts = plain_counts(known)
    found = {r["doc_id"]: r for r in languages.identify(docs, languages.fit(docs)).collect()}
    tried = Counter()
    for i, text, _ in rows:
        name, score = plain_language(counts, sorted(letters), text)
        assert found[i]["lang_pred"] == name and abs(found[i]["score"] - score) < 1e-9
        tried["seen" if set(text.split()) & set(counts[0]) else "unseen"] += 1
    assert tried["seen"] > 5 and tried["unseen"] > 5
    odd = spark.createDataFrame([(1, "qqq"), (2, "12 .")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in languages.identify(odd, languages.fit(docs)).collect()} == {1: "aa", 2: "und"}
