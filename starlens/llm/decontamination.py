"""Benchmark decontamination: typed templates, hashed windows, and slot consistency.

A text's words (runs of letters, marks and digits; an apostrophe within a word and a point or
comma within a number don't end it, letters of scripts without spaces are words of their
own, and words are cut between a digit and a letter after it, but for ordinals) become a
template: digits and ordinals are numbers, a unit after a number is a unit, and words of
two characters or more with a capital are names; each type has a placeholder, other words
are lowered. Windows of ``WINDOW`` template words are hashed and joined with those of the
benchmark items that have at least ``LEAST_LITERAL`` literal words. An item of fewer words
than that, but ``LEAST_WORDS``, is one window of its own length. Windows of fewer literal
words are taken from items that have no others, and count only with the item's own slots.

Words in capitals or with inner ones may be names (NASA, McDonald) or just be written so.
So windows are also taken with plain names only (one capital, then small letters), of
documents where that differs. An item's windows are taken in both ways and without typing
names, so texts in capitals or small letters match too.

A window that matches at some distance between document and item is part of an
alignment. Within an alignment, each slot value of the item should have one counterpart in
the document: a question with other names or numbers passes, a chance likeness of
sentence shapes with mixed-up slots doesn't. Windows that hold a value with several
counterparts don't count, unless all their slots are as in the item; the alignment's other
windows do. A document leaks an item if the windows that count are at least ``COVERAGE``
of the item's windows.

Only DataFrame operations are used. The items' windows are broadcast if there are at most
``BROADCAST_WINDOWS``, else they are joined by a shuffle.

Defined results: null and empty texts match nothing, and items with fewer than ``LEAST_WORDS``
words are not searched: almost every text holds them. Composed and decomposed accents are
different letters. Rows without an id are not searched. Rows with the same id count
as one document in ``leaks``, by their texts in ``without_leaks``. Items with equal text are reported each. Repeated rows of the benchmark
change nothing. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm.keys import text_key
from starlens.session import scratch_path

WINDOW = 6
LEAST_LITERAL = 3
LEAST_WORDS = 3
COVERAGE = 0.5
BROADCAST_WINDOWS = 500_000
BROADCAST_IDS = 500_000
UNITS = (
    "mm", "cm", "m", "km", "mg", "g", "kg", "ml", "l", "s", "min", "h", "percent", "dollars", "euros", "miles",
    "feet", "inches", "meters", "metres", "hours", "minutes", "seconds", "days", "weeks", "years",
)

# Each word stands between two spaces of its own, so neighbours can match one after the other.
JOINED = r"['’](?<=\p{L}.)(?=\p{L})|[.,](?<=\p{N}.)(?=\p{N})|\p{Cf}"
APART = r"[^\p{L}\p{M}\p{N}]+"
# Thai, Lao, Myanmar, Khmer, kana, ideographs; few texts have any character as high as these.
UNSPACED = (
    r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]"
)
HIGH = r"[^\x00-\u0DFF]"
NAME = r" (?=\S{2})\p{L}*\p{Lu}[\p{L}\p{N}]* "
PLAIN_NAME = r" \p{Lu}\p{Ll}+ "
ORDINAL = "(?i:st|nd|rd|th)"
NUMBER = rf" \p{{N}}+{ORDINAL}? "
ATTACHED = rf"(\p{{N}})(?!{ORDINAL} )(\p{{L}})"
UNIT = f" ¤d  (?i:{'|'.join(UNITS)}) "


def spaced(text: Column) -> Column:
    """The text's words without punctuation, with two spaces between them."""
    cut = F.when(text.rlike(HIGH), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)
    bare = F.regexp_replace(cut, JOINED, "")
    apart = F.concat(F.lit("  "), F.regexp_replace(bare, APART, "  "), F.lit("  "))
    return F.regexp_replace(apart, ATTACHED, "$1  $2")


def split_words(words: Column) -> Column:
    return F.filter(F.split(words, " +"), lambda w: w != "")


def template(words: Column, names: str | None = NAME) -> Column:
    """Spaced words with placeholders for numbers, units and what the pattern takes for names."""
    numbered = F.regexp_replace(F.regexp_replace(words, NUMBER, " ¤d "), UNIT, " ¤d  ¤u ")
    return F.lower(F.regexp_replace(numbered, names, " ¤n ") if names else numbered)


def window_hashes(words: Column, window: Column | int = WINDOW) -> Column:
    """A hash of each window of an array of words; none if there are too few."""
    last = F.size(words) - window + 1
    hashes = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, window)))
    return F.when(last >= 1, hashes)


def other_windows(words: Column, other: Column) -> Column:
    """Position and hash of each window of the second array that differs from the first's."""
    last = F.size(words) - WINDOW + 1
    apart = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.element_at(words, i) != F.element_at(other, i))
    held = F.transform(apart, lambda i: F.sequence(F.greatest(i - WINDOW + 1, F.lit(1)), F.least(i, last)))
    each = F.transform(
        F.array_distinct(F.flatten(held)),
        lambda i: F.struct((i - 1).alias("doc_pos"), F.xxhash64(F.slice(other, i, WINDOW)).alias("hash")),
    )
    return F.when((last >= 1) & (words != other), each)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, item_pos, hash, words, shape and whether it is exact of each item's windows, once."""
    text = F.col("text")
    # The capital of the first word may be that of a sentence only.
    inner = F.concat(F.lower(F.substring(text, 1, 1)), F.substring(text, 2, 1 << 30))
    shapes = [(text, NAME), (text, PLAIN_NAME), (text, None), (inner, NAME)]
    items = benchmark.where("item_id is not null and text is not null").select(
        "item_id", split_words(F.lower(spaced(text))).alias("raw"),
        F.array(*(split_words(template(spaced(t), names)) for t, names in shapes)).alias("shapes"),
    )
    each = items.select("item_id", "raw", F.explode("shapes").alias("shape")).where(F.size("raw") >= LEAST_WORDS)
    window = F.least(F.size("shape"), F.lit(WINDOW))
    hashes = window_hashes(F.col("shape"), window)
    placed = each.select("item_id", "raw", "shape", window.alias("window"), F.posexplode(hashes).alias("at", "hash"))
    cut = placed.select(
        "item_id",
        F.col("at").alias("item_pos"),
        "hash",
        F.slice("raw", F.col("at") + 1, F.col("window")).alias("item_words"),
        F.slice("shape", F.col("at") + 1, F.col("window")).alias("shape"),
    )
    literal = F.size(F.filter("shape", lambda w: ~w.startswith("¤")))
    cut = cut.withColumn("exact", literal < LEAST_LITERAL)
    # Windows that say little stand in for an item that has no others, or no more than one.
    told = cut.where(~F.col("exact") & (F.size("shape") == WINDOW)).select("item_id").distinct().withColumn("told", F.lit(True))
    return cut.join(told, "item_id", "left").where("not exact or told is null").drop("told").distinct()


def matched_windows(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, item_id, item_pos, doc_pos and hash of each pair of equal template windows."""
    texts = documents.where("doc_id is not null and text is not null")
    bare = texts.select("doc_id", spaced(F.col("text")).alias("words"))
    shapes = bare.select(
        "doc_id", split_words(template(F.col("words"))).alias("shape"),
        split_words(template(F.col("words"), PLAIN_NAME)).alias("plain"),
    )
    hashed = F.transform(
        window_hashes(F.col("shape")), lambda h, i: F.struct(i.alias("doc_pos"), h.alias("hash"))
    )
    others = F.coalesce(other_windows(F.col("shape"), F.col("plain")), F.array().cast("array<struct<doc_pos:int,hash:bigint>>"))
    none = F.array().cast("array<struct<doc_pos:int,hash:bigint>>")
    # Short items are looked for by their own lengths, of which there are few.
    sizes = sorted(r["n"] for r in windows.select(F.size("shape").alias("n")).distinct().collect())
    every = [F.coalesce(hashed, none), others]
    for size in [n for n in sizes if n < WINDOW]:
        for own in (F.col("shape"), F.col("plain")):
            short = F.transform(window_hashes(own, size), lambda h, i: F.struct(i.alias("doc_pos"), h.alias("hash")))
            every.append(F.coalesce(short, none))
    held = F.concat(*every) if len(every) == 2 else F.array_distinct(F.concat(*every))
    placed = shapes.select("doc_id", F.inline(held))
    keys = windows.select("hash", "item_id", "item_pos")
    if windows.count() <= BROADCAST_WINDOWS:
        keys = F.broadcast(keys)
    return placed.join(keys, "hash").select("doc_id", "item_id", "item_pos", "doc_pos", "hash")


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched and all windows, coverage, and whether slots were changed."""
    return _leaks(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item. Rows are told by id and text, so a text that shares
    its id with a leaking one is judged, and stays, on its own."""
    key = F.struct(F.col("doc_id").cast("long").alias("id"), text_key(F.col("text")).alias("text_key"))
    rows = documents.where("doc_id is not null and text is not null").select(key.alias("doc_id"), "text")
    found = _leaks(rows, benchmark).select("doc_id.*").distinct()
    same = (documents["doc_id"].cast("long") == found["id"]) & (text_key(documents["text"]) == found["text_key"])
    return documents.join(found, same, "left_anti")


def _leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Leaks of texts that are told by doc_id, which may be of any type."""
    spark = documents.sparkSession
    folder = scratch_path(spark, "decontamination")
    item_windows(benchmark).write.parquet(f"{folder}/windows")
    windows = spark.read.parquet(f"{folder}/windows")
    matched_windows(documents, windows).write.parquet(f"{folder}/matches")
    matches = spark.read.parquet(f"{folder}/matches")
    has_slot = F.exists("shape", lambda w: w.startswith("¤"))
    # Original words are fetched for documents with a match only.
    ids = matches.select("doc_id").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = documents.where("text is not null").join(ids, "doc_id", "left_semi")
    raw = texts.select("doc_id", split_words(F.lower(spaced(F.col("text")))).alias("raw"))
    slotted = matches.join(windows.where(has_slot), ["item_id", "item_pos", "hash"]).join(raw, "doc_id")
    words = F.arrays_zip("shape", F.col("item_words").alias("asked"), F.slice("raw", F.col("doc_pos") + 1, F.size("shape")).alias("given"))
    slots = F.transform(
        F.filter(words, lambda w: w["shape"].startswith("¤")),
        lambda w: F.struct(w["asked"].alias("asked"), w["given"].alias("given")),
    )
    slotted = slotted.select(
        "doc_id", "item_id", "item_pos", (F.col("doc_pos") - F.col("item_pos")).alias("distance"), "exact", slots.alias("slots")
    )
    pairs = slotted.select("doc_id", "item_id", "distance", F.explode("slots").alias("slot"))
    values = pairs.groupBy("doc_id", "item_id", "distance", F.col("slot.asked").alias("asked")).agg(
        F.min("slot.given").alias("low"), F.max("slot.given").alias("high")
    )
    torn = values.where("low <> high").groupBy("doc_id", "item_id", "distance").agg(F.collect_set("asked").alias("torn"))
    changed = F.exists("slots", lambda w: w["asked"] != w["given"])
    mixed = F.coalesce(F.arrays_overlap(F.col("slots.asked"), "torn"), F.lit(False))
    # A window that doesn't count has no position, but tells that slots were changed.
    judged = slotted.join(torn, ["doc_id", "item_id", "distance"], "left").select(
        "doc_id", "item_id", F.when(~(changed & (mixed | F.col("exact"))), F.col("item_pos")).alias("item_pos"), changed.cast("int").alias("changed")
    )
    plain = matches.join(windows.where(~has_slot), ["item_id", "item_pos", "hash"])
    counted = judged.unionByName(plain.select("doc_id", "item_id", "item_pos", F.lit(0).alias("changed")))
    sizes = windows.groupBy("item_id").agg(F.countDistinct("item_pos").alias("item_windows"))
    found = counted.groupBy("doc_id", "item_id").agg(
        F.countDistinct("item_pos").alias("matched_windows"), F.max("changed").alias("changed")
    )
    share = F.col("matched_windows") / F.col("item_windows")
    return found.join(sizes, "item_id").where(share >= COVERAGE).select(
        "doc_id", "item_id", "matched_windows", "item_windows", share.alias("coverage"), "changed"
    )


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
