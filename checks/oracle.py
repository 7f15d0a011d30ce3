"""SQL for DuckDB over the same tables, one statement per registered query."""

from __future__ import annotations

from checks.portable import portable_sql

# Every character Python's str.strip() removes (fixed values).
BLANKS = "||".join(
    f"chr({c})"
    for c in (
        0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0,
        0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
        0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def safe_int(x: str) -> str:
    cell = strip(x)
    return (
        f"CASE WHEN regexp_full_match({cell}, '{NUMBER}')"
        f" THEN CAST(trunc(CAST({cell} AS DOUBLE)) AS BIGINT) END"
    )


def mean4(total: str, n: str) -> str:
    """Half-up rounding to four digits in whole numbers; NULL without rows."""
    s = f"CAST({total} AS BIGINT)"
    return (
        f"CASE WHEN {n} > 0 THEN sign({s}) * ((20000*abs({s})+{n})//(2*{n}))/10000.0::DOUBLE END"
    )


def share4(hits: str, n: str) -> str:
    """Half-up rounding to five digits, then to four."""
    return f"((((200000*CAST({hits} AS BIGINT)+{n})//(2*{n}))+5)//10)/10000.0::DOUBLE"


def ratio6(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} > 0 THEN"
        f" ((2000000*CAST({part} AS BIGINT)+{whole})//(2*{whole}))/1000000.0::DOUBLE ELSE 0.0 END"
    )


PARENT = "CASE WHEN l.l_partkey % 10 = 9 THEN 'none-' ELSE '' END || CAST(l.l_partkey AS VARCHAR)"


def facts(copies: bool = False) -> str:
    again = "UNION ALL SELECT *, 1 AS copy FROM lineitem WHERE l_orderkey % 50 = 0" if copies else ""
    return f"""
    line_copies AS (SELECT *, 0 AS copy FROM lineitem {again}),
    facts AS (
      SELECT CAST(o.o_custkey AS VARCHAR) AS user_id,
             {PARENT} AS parent_asin,
             CAST(l.l_suppkey AS VARCHAR) AS asin,
             CAST(l.l_quantity AS INT) % 6 AS rating,
             CAST((CAST(l.l_quantity AS INT) % 11) / 2.0 AS DOUBLE) AS half_rating,
             o.o_orderpriority || CASE WHEN copy = 1 THEN ' again' ELSE '' END AS review_title,
             x.text AS review_text,
             epoch_ms(l.l_shipdate) AS millis,
             CASE WHEN l.l_linenumber % 2 = 0 THEN epoch_ms(l.l_shipdate)
                  ELSE epoch_ms(l.l_shipdate) // 1000 END AS epoch,
             CASE WHEN l.l_discount = 0 THEN NULL
                  ELSE CAST(ROUND(l.l_tax*100) AS INT) - 1 + copy END AS helpful_vote,
             CASE l.l_returnflag WHEN 'N' THEN TRUE WHEN 'A' THEN FALSE END AS verified_purchase,
             CASE WHEN l.l_linestatus = 'O'
                  THEN '["img/' || CAST(l.l_suppkey AS VARCHAR) || '"]' END AS images_json,
             l.l_linenumber AS line, l.l_discount AS discount, l.l_tax AS tax,
             CAST(l.l_quantity AS INT) AS quantity,
             sha256(concat(CAST(o.o_custkey AS VARCHAR), '|', {PARENT}, '|',
                           CAST(epoch_ms(l.l_shipdate) AS VARCHAR), '|',
                           CAST(l.l_suppkey AS VARCHAR))) AS review_id
      FROM line_copies l
      LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
      LEFT JOIN documents x ON l.l_orderkey % (SELECT count(*) FROM documents) = x.doc_id),
    reviews AS (
      SELECT *, make_timestamp_ms(millis) AS review_timestamp,
             CAST(year(make_timestamp_ms(millis)) AS INT) AS review_year,
             CAST(month(make_timestamp_ms(millis)) AS INT) AS review_month
      FROM facts)"""


PRODUCTS = """
    landing AS (
      SELECT CAST(p_partkey AS VARCHAR) AS parent_asin,
             CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS main_category,
             p_name AS title, CAST(p_size/10.0 AS DOUBLE) AS average_rating,
             p_size*10 AS rating_number,
             CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN ''
                  ELSE '$' || CAST(CAST(ROUND((p_retailprice-900)*4,2) AS DECIMAL(12,2)) AS VARCHAR)
             END AS price_raw,
             CASE WHEN p_partkey % 17 = 0 THEN '  ' ELSE p_brand END AS store,
             '["' || p_brand || '"]' AS features_text, CAST(NULL AS VARCHAR) AS description_text,
             '["' || p_type || '"]' AS categories_json, CAST(NULL AS VARCHAR) AS details_json
      FROM part),
    metadata AS (
      SELECT parent_asin, main_category, title, average_rating, rating_number,
             CASE WHEN price_raw IS NULL OR trim(price_raw) = '' THEN NULL
                  ELSE TRY_CAST(regexp_replace(price_raw, '[^0-9.-]', '', 'g') AS DECIMAL(12,2))
             END AS price,
             store, features_text, description_text, categories_json, details_json
      FROM landing)"""


def base(select: str, copies: bool = False, *more: str) -> str:
    return "WITH " + ",".join([facts(copies), PRODUCTS, *more]) + "\n" + select


LOW = "CASE WHEN r.rating <= 2 THEN 1 ELSE 0 END"
AVG_RATING = mean4("SUM(r.rating)", "COUNT(r.rating)") + " AS avg_rating"
AVG_VOTES = mean4("SUM(r.helpful_vote)", "COUNT(r.helpful_vote)") + " AS avg_helpful_vote"
LOW_SHARE = share4(f"SUM({LOW})", "COUNT(*)") + " AS low_rating_share"
VERIFIED = (
    share4("SUM(CASE WHEN r.verified_purchase THEN 1 ELSE 0 END)", "COUNT(*)")
    + " AS verified_purchase_ratio"
)
JOINED = "FROM reviews r LEFT JOIN metadata m ON r.parent_asin = m.parent_asin"

Q1 = f"""SELECT COALESCE(m.main_category,'unknown') AS main_category,
    CASE WHEN r.verified_purchase THEN 'verified' ELSE 'not_verified' END AS purchase_type,
    COUNT(*) AS review_count, {AVG_RATING}, {AVG_VOTES}, {LOW_SHARE}
    {JOINED} GROUP BY 1, 2 HAVING COUNT(*) >= 500"""
Q2 = f"""SELECT review_year, review_month, COUNT(*) AS review_count, {AVG_RATING}, {LOW_SHARE},
    {VERIFIED}, {AVG_VOTES} FROM reviews r GROUP BY 1, 2"""
Q3 = f"""SELECT COALESCE(m.store,'unknown') AS store, COUNT(*) AS review_count, {AVG_RATING},
    {LOW_SHARE}, {AVG_VOTES}, {VERIFIED} {JOINED} GROUP BY 1 HAVING COUNT(*) >= 200
    ORDER BY low_rating_share DESC, avg_rating, review_count DESC, store LIMIT 20"""
Q4 = f"""SELECT CASE WHEN m.price IS NULL THEN 'unknown' WHEN m.price < 25 THEN '0_25'
      WHEN m.price < 75 THEN '25_75' WHEN m.price < 150 THEN '75_150'
      WHEN m.price < 300 THEN '150_300' ELSE '300_plus' END AS price_band,
    COUNT(*) AS review_count, {AVG_RATING}, {LOW_SHARE}, {AVG_VOTES} {JOINED} GROUP BY 1"""
Q5 = f"""SELECT COALESCE(m.main_category,'unknown') AS main_category, COUNT(*) AS review_count,
    CAST(SUM({LOW}) AS BIGINT) AS low_rating_count, {LOW_SHARE},
    CAST(SUM(CASE WHEN r.rating <= 2 THEN r.helpful_vote ELSE 0 END) AS BIGINT)
      AS low_rating_helpful_votes,
    {mean4("SUM(CASE WHEN r.rating <= 2 THEN r.helpful_vote END)",
           "COUNT(CASE WHEN r.rating <= 2 THEN r.helpful_vote END)")} AS avg_helpful_on_low_ratings
    {JOINED} GROUP BY 1 HAVING COUNT(*) >= 500
    ORDER BY low_rating_helpful_votes DESC, low_rating_share DESC, review_count DESC, main_category
    LIMIT 20"""

STAGED = """SELECT review_id, parent_asin, user_id, asin, {rating} AS rating, review_title,
    {ts} AS review_timestamp, helpful_vote, {verified} AS verified_purchase, images_json,
    md5({text}) AS text_md5 FROM {source}"""
# Reviews as they come out of the JSON lines, where some cells are left out.
LINES = """lines AS (
      SELECT * REPLACE (
        CASE WHEN tax = 0 THEN NULL ELSE asin END AS asin,
        CAST(round_even(half_rating, 0) AS INT) AS rating,
        coalesce(verified_purchase, false) AS verified_purchase,
        sha256(concat(user_id, '|', parent_asin, '|', CAST(millis AS VARCHAR), '|',
               CASE WHEN tax <> 0 THEN asin WHEN line = 3 THEN 'None' ELSE '' END)) AS review_id)
      FROM reviews)"""


def staged(source: str, ts: str = "review_timestamp", text: str = "review_text") -> str:
    return STAGED.format(
        rating="rating", ts=ts, verified="verified_purchase", text=text, source=source
    )


VALID = """rating BETWEEN 1 AND 5 AND trim(review_id) <> '' AND trim(parent_asin) <> ''
    AND trim(user_id) <> '' AND length(trim(review_text)) BETWEEN 5 AND 5000"""
FEATURES = f"""features AS (
      SELECT r.review_id, r.parent_asin, r.user_id, r.asin, r.rating AS label, r.review_title,
             trim(r.review_text) AS review_text,
             greatest(coalesce(r.helpful_vote, 0), 0) AS helpful_vote, r.verified_purchase,
             m.main_category, m.store, m.price, m.average_rating, m.rating_number,
             r.review_year, r.review_month
      FROM (SELECT * FROM reviews WHERE {VALID}) r
      LEFT JOIN metadata m ON r.parent_asin = m.parent_asin)"""


def fraction(key: str, seed: int) -> str:
    return (
        f"CAST('0x' || substr(sha256('{seed}:' || {key}), 1, 12) AS BIGINT)"
        f" / 281474976710655.0::DOUBLE"
    )


# --- text-typed rows, profile, funnel -------------------------------------------------

TEXT_ROWS = """text_rows AS (
      SELECT review_id, parent_asin || ' ' AS parent_asin,
             CASE WHEN CAST(user_id AS BIGINT) % 97 = 0 THEN ' ' || chr(9) ELSE user_id END
               AS user_id,
             asin,
             CASE WHEN quantity = 50 THEN 'n/a' WHEN quantity = 49 THEN 'nan'
                  WHEN line = 7 THEN CAST(rating AS VARCHAR) || '.7'
                  ELSE CAST(rating AS VARCHAR) END AS rating,
             review_title,
             coalesce(CASE WHEN tax + discount > 0.17 THEN NULL
                  WHEN line = 1 THEN chr(9) || review_text || ' ' || chr(10)
                  ELSE review_text END, '') AS review_text,
             CAST(millis AS VARCHAR) AS review_timestamp,
             coalesce(CAST(helpful_vote AS VARCHAR), '') AS helpful_vote,
             CASE WHEN verified_purchase THEN ' True ' WHEN NOT verified_purchase THEN 'no'
                  ELSE '' END AS verified_purchase,
             coalesce(images_json, '') AS images_json
      FROM facts)"""
TEXT_COLUMNS = (
    "review_id", "parent_asin", "user_id", "asin", "rating", "review_title", "review_text",
    "review_timestamp", "helpful_vote", "verified_purchase", "images_json",
)
MEASURED = f"""measured AS MATERIALIZED (
      SELECT *, length({strip("review_text")}) AS text_length FROM text_rows)"""
KEY = f"{strip('parent_asin')} || '|' || {strip('review_id')}"
MISSING = " OR ".join(
    f"{strip(c)} = ''"
    for c in ("review_id", "parent_asin", "user_id", "rating", "review_text", "review_timestamp")
)
FUNNEL = f"""flagged AS (SELECT *, {KEY} AS key, ({MISSING}) AS missing FROM text_rows),
    ranked AS (
      SELECT *, length({strip("review_text")}) AS text_length, {safe_int("rating")} AS stars,
             row_number() OVER (PARTITION BY missing, key ORDER BY review_timestamp, user_id, asin,
               rating, review_title, helpful_vote, verified_purchase, md5(review_text)) AS place
      FROM flagged),
    reasoned AS (
      SELECT *, CASE WHEN missing THEN 'missing_required'
                     WHEN place > 1 THEN 'duplicate_review_key'
                     WHEN stars IS NULL THEN 'invalid_rating'
                     WHEN stars NOT BETWEEN 1 AND 5 THEN 'rating_out_of_range'
                     WHEN text_length < 5 THEN 'review_text_too_short'
                     WHEN text_length > 5000 THEN 'review_text_too_long' END AS drop_reason,
             CASE WHEN {fraction("key", 34)} < 0.8 THEN 'train' ELSE 'test' END AS split
      FROM ranked),
    kept AS (SELECT * FROM reasoned WHERE drop_reason IS NULL)"""


def cleaned(select: str, *more: str) -> str:
    return base(select, True, TEXT_ROWS, FUNNEL, *more)


def _long(section: str, metric: str, field: str, value: str, source: str = "") -> str:
    return (
        f"SELECT {section} AS section, {metric} AS metric, {field} AS field,"
        f" CAST({value} AS DOUBLE) AS value {source}"
    )


def _before() -> str:
    filled = "CASE WHEN text_length > 0 THEN text_length END"
    avg = (
        f"((20000*CAST(coalesce(SUM({filled}),0) AS BIGINT)+COUNT({filled}))"
        f"//(2*greatest(COUNT({filled}),1)))/10000.0::DOUBLE"
    )
    parts = [
        _long("'global'", "'total_rows'", "''", "COUNT(*)", "FROM measured"),
        _long("'global'", "'duplicate_rows'", "'review_key'", f"COUNT(*) - COUNT(DISTINCT {KEY})",
              "FROM measured"),
        _long("'text'", "'nonempty_count'", "'review_text'", f"COUNT({filled})", "FROM measured"),
        _long("'text'", "'min_len'", "'review_text'", f"coalesce(MIN({filled}),0)", "FROM measured"),
        _long("'text'", "'max_len'", "'review_text'", f"coalesce(MAX({filled}),0)", "FROM measured"),
        _long("'text'", "'avg_len'", "'review_text'", avg, "FROM measured"),
        _long("'rating_distribution'", "'count'",
              f"coalesce(CAST({safe_int('rating')} AS VARCHAR), 'invalid')", "COUNT(*)",
              "FROM measured GROUP BY 3"),
    ]
    for c in TEXT_COLUMNS:
        empty = f"COUNT(*) FILTER (WHERE {strip(c)} = '')"
        parts.append(_long("'nulls'", "'count'", f"'{c}'", empty, f"FROM measured HAVING {empty} > 0"))
        parts.append(
            _long("'nulls'", "'ratio'", f"'{c}'", ratio6(empty, "COUNT(*)"),
                  f"FROM measured HAVING {empty} > 0")
        )
    return " UNION ALL ".join(parts)


def _after() -> str:
    kept = "COUNT(*) FILTER (WHERE drop_reason IS NULL)"

    def part(name: str) -> str:
        return f"COUNT(*) FILTER (WHERE drop_reason IS NULL AND split = '{name}')"

    source = "FROM reasoned"
    return " UNION ALL ".join(
        [
            _long("'global'", "'kept_rows'", "''", kept, source),
            _long("'global'", "'train_rows'", "''", part("train"), source),
            _long("'global'", "'test_rows'", "''", part("test"), source),
            _long("'global'", "'train_ratio'", "''", ratio6(part("train"), kept), source),
            _long("'global'", "'test_ratio'", "''", ratio6(part("test"), kept), source),
            _long("'drop_reasons'", "'count'", "drop_reason", "COUNT(*)",
                  source + " WHERE drop_reason IS NOT NULL GROUP BY 3"),
            _long("'class_balance_' || split", "'count'", "CAST(stars AS VARCHAR)", "COUNT(*)",
                  "FROM kept GROUP BY split, stars"),
        ]
    )


QUALITY = """items(position, item) AS (VALUES
      (1,'total_before'),(2,'kept_rows'),(3,'dropped_rows'),(4,'train_rows'),(5,'test_rows'),
      (6,'allowed_ratings'),(7,'text_len_constraints'),(8,'drop_reasons.duplicate_review_key'),
      (9,'drop_reasons.invalid_rating'),(10,'drop_reasons.missing_required'),
      (11,'drop_reasons.rating_out_of_range'),(12,'drop_reasons.review_text_too_long'),
      (13,'drop_reasons.review_text_too_short')),
    numbers AS (
      SELECT 'total_before' AS item, COUNT(*) AS n FROM reasoned
      UNION ALL SELECT 'kept_rows', COUNT(*) FROM kept
      UNION ALL SELECT 'dropped_rows', COUNT(*) FROM reasoned WHERE drop_reason IS NOT NULL
      UNION ALL SELECT 'train_rows', COUNT(*) FROM kept WHERE split = 'train'
      UNION ALL SELECT 'test_rows', COUNT(*) FROM kept WHERE split = 'test'
      UNION ALL SELECT 'drop_reasons.' || drop_reason, COUNT(*) FROM reasoned
                WHERE drop_reason IS NOT NULL GROUP BY 1)"""

# --- feature encoding and Naive Bayes in closed form ----------------------------------


def label_or_unknown(c: str) -> str:
    return f"CASE WHEN length(trim(coalesce({c},''))) > 0 THEN trim({c}) ELSE 'unknown' END"


ENCODED = f"""named AS (
      SELECT *, {label_or_unknown("main_category")} AS category,
             {label_or_unknown("store")} AS store_clean,
             CASE WHEN verified_purchase THEN 1 ELSE 0 END AS flag
      FROM features),
    top_stores AS (
      SELECT store_clean AS name FROM named GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 10),
    bucketed AS (
      SELECT *, CASE WHEN store_clean IN (SELECT name FROM top_stores) THEN store_clean
                     ELSE 'other' END AS store_bucketed FROM named),
    categories AS (
      SELECT category AS name, row_number() OVER (ORDER BY COUNT(*) DESC, category) - 1 AS idx
      FROM bucketed GROUP BY category),
    stores AS (
      SELECT store_bucketed AS name,
             row_number() OVER (ORDER BY COUNT(*) DESC, store_bucketed) - 1 AS idx
      FROM bucketed GROUP BY store_bucketed),
    encoded AS (
      SELECT b.*, c.idx AS category_idx, s.idx AS store_idx
      FROM bucketed b JOIN categories c ON b.category = c.name
      JOIN stores s ON b.store_bucketed = s.name),
    nb_slots AS (
      SELECT 0 AS idx, 'verified_purchase_num' AS name, 'flag' AS kind
      UNION ALL SELECT 1 + idx, 'main_category=' || name, 'category' FROM categories
      UNION ALL SELECT 1 + (SELECT COUNT(*) FROM categories), 'main_category=__unknown', 'constant'
      UNION ALL SELECT 2 + (SELECT COUNT(*) FROM categories) + idx, 'store=' || name, 'store'
                FROM stores
      UNION ALL SELECT 2 + (SELECT COUNT(*) FROM categories) + (SELECT COUNT(*) FROM stores),
                'store=__unknown', 'constant'),
    slots AS (
      SELECT * FROM (VALUES (0,'helpful_vote','number'),(1,'price','number'),
        (2,'average_rating','number'),(3,'rating_number','number'),(4,'review_year','number'),
        (5,'review_month','number')) v(idx, name, kind)
      UNION ALL SELECT 6 + idx, name, kind FROM nb_slots)"""

NUMBERS = (
    "helpful_vote", "price", "average_rating", "rating_number", "review_year", "review_month",
)


def discrete(first: int) -> list[str]:
    """Slot and value of the flag and the two one-hot parts, from slot ``first`` on."""
    return [
        f"{first} AS idx, CAST(flag AS DOUBLE) AS v",
        f"{first + 1} + category_idx, 1.0",
        f"{first + 2} + (SELECT COUNT(*) FROM categories) + store_idx, 1.0",
    ]


def cells(vector: str, slots: list[str]) -> str:
    """Non-zero slots by row; a missing number is shown as -1."""
    long = " UNION ALL ".join(f"SELECT review_id, label, {s} FROM encoded" for s in slots)
    return f"""SELECT review_id, CAST(label AS DOUBLE) AS label, '{vector}' AS vector,
        CAST(idx AS INT) AS idx, coalesce(round(v, 2), -1.0)::DOUBLE AS value
        FROM (SELECT * FROM ({long}) t(review_id, label, idx, v)) WHERE v IS NULL OR v <> 0"""


FULL = [f"{i}, CAST({c} AS DOUBLE)" for i, c in enumerate(NUMBERS)] + discrete(6)
# The first value is spoilt by label. Odd months keep eight slots; the others have one too many.
SPOILT = [
    "0, CASE WHEN label IN (1, 2) THEN 0.0 ELSE CAST(helpful_vote AS DOUBLE) END",
    *[f"{i}, coalesce(CAST({c} AS DOUBLE), 0.0)" for i, c in enumerate(NUMBERS) if i],
    "6, CAST(flag AS DOUBLE)",
    "7 + category_idx, CASE WHEN review_month % 2 = 1 AND category_idx > 0 THEN 0.0 ELSE 1.0 END",
    "8 + (SELECT COUNT(*) FROM categories) + store_idx,"
    " CASE WHEN review_month % 2 = 1 THEN 0.0 ELSE 1.0 END",
]


def vector_text(names: list[str]) -> str:
    """The whole vector as the digest of its numbers with two digits."""
    n = "(SELECT COUNT(*) FROM {})"
    slots = [
        *[f"printf('%.2f', coalesce(CAST({c} AS DOUBLE), 0.0))" for c in names],
        "printf('%.2f', CAST(flag AS DOUBLE))",
        f"repeat('0.00,', category_idx) || '1.00,' || repeat('0.00,', {n.format('categories')}"
        " - category_idx - 1) || '0.00'",
        f"repeat('0.00,', store_idx) || '1.00,' || repeat('0.00,', {n.format('stores')}"
        " - store_idx - 1) || '0.00'",
    ]
    return "md5(concat_ws(',', " + ", ".join(slots) + "))"


KEY_TEXT = "parent_asin || '|' || review_id"
BAYES = f"""parts AS (SELECT *, {fraction(KEY_TEXT, 42)} < 0.7 AS in_train FROM encoded),
    train AS (SELECT * FROM parts WHERE in_train),
    test AS (SELECT * FROM parts WHERE NOT in_train),
    classes AS (
      SELECT label, row_number() OVER (ORDER BY label) - 1 AS class_index, COUNT(*) AS n
      FROM train GROUP BY label),
    priors AS (
      SELECT class_index, CAST(label AS DOUBLE) AS label_value,
             ln(n + 1.0) - ln((SELECT SUM(n) FROM classes) + (SELECT COUNT(*) FROM classes)*1.0)
               AS log_prior
      FROM classes),
    sums AS (
      SELECT label, 0 AS idx, SUM(flag) AS x FROM train GROUP BY label
      UNION ALL SELECT label, 1 + category_idx, COUNT(*) FROM train GROUP BY ALL
      UNION ALL SELECT label, 2 + (SELECT COUNT(*) FROM categories) + store_idx, COUNT(*)
                FROM train GROUP BY ALL),
    filled AS (
      SELECT c.label, c.class_index, s.idx, s.name, s.kind,
             CASE WHEN s.kind = 'constant' THEN 0.5 * c.n ELSE coalesce(u.x, 0) END AS x
      FROM classes c CROSS JOIN nb_slots s LEFT JOIN sums u ON u.label = c.label AND u.idx = s.idx),
    theta AS (
      SELECT class_index, CAST(label AS DOUBLE) AS label_value, idx AS feature_index,
             name AS feature_name, kind,
             ln(x + 1.0) - ln(SUM(x) OVER (PARTITION BY label)
                              + COUNT(*) OVER (PARTITION BY label) * 1.0) AS weight
      FROM filled)"""
PREDICTED = """constants AS (
      SELECT class_index, 0.5 * SUM(weight) AS w FROM theta WHERE kind = 'constant' GROUP BY 1),
    scores AS (
      SELECT d.flag, d.category, d.store_bucketed, p.label_value,
             p.log_prior + k.w + d.flag * f.weight + c.weight + s.weight AS score
      FROM (SELECT DISTINCT flag, category, store_bucketed FROM test) d
      CROSS JOIN priors p
      JOIN constants k ON k.class_index = p.class_index
      JOIN theta f ON f.class_index = p.class_index AND f.kind = 'flag'
      JOIN theta c ON c.class_index = p.class_index AND c.feature_name = 'main_category=' || d.category
      JOIN theta s ON s.class_index = p.class_index AND s.feature_name = 'store=' || d.store_bucketed),
    best AS (
      SELECT flag, category, store_bucketed, arg_max(label_value, score) AS prediction
      FROM scores GROUP BY ALL),
    predictions AS (
      SELECT CAST(t.label AS DOUBLE) AS label, b.prediction
      FROM test t JOIN best b USING (flag, category, store_bucketed))"""


NB_ENTRIES = """
      SELECT id, fold, label, 0 AS idx, flag AS v FROM folded WHERE flag <> 0
      UNION ALL SELECT id, fold, label, 1 + category_idx, 1 FROM folded
      UNION ALL SELECT id, fold, label, 2 + (SELECT COUNT(*) FROM categories) + store_idx, 1 FROM folded"""
FOLD_SCORES = f"""folded AS (
      SELECT row_number() OVER () AS id, label, flag, category_idx, store_idx,
             least(CAST(floor({fraction(KEY_TEXT, 43)} * 3) AS INT), 2) AS fold FROM train),
    held(h) AS (VALUES (0),(1),(2)),
    grid(point, smooth) AS (VALUES (0, 0.25::DOUBLE), (1, 0.5), (2, 1.0), (3, 2.0)),
    entries AS ({NB_ENTRIES}),
    fold_classes AS (SELECT h, label, COUNT(*) AS n FROM folded, held WHERE fold <> h GROUP BY ALL),
    fold_totals AS (SELECT h, SUM(n) AS nn, COUNT(*) AS c FROM fold_classes GROUP BY h),
    fold_sums AS (SELECT h, label, idx, SUM(v) AS s FROM entries, held WHERE fold <> h GROUP BY ALL),
    fold_slots AS (SELECT h, idx, SUM(s) AS filled FROM fold_sums GROUP BY ALL),
    fold_x AS (
      SELECT c.h, c.label, s.idx, c.n, t.nn, t.c,
             coalesce(f.filled, 0) IN (0, t.nn) AS fixed,
             CASE WHEN coalesce(f.filled, 0) IN (0, t.nn) THEN 0.5 * c.n
                  ELSE coalesce(u.s, 0) END::DOUBLE AS x
      FROM fold_classes c JOIN fold_totals t ON t.h = c.h CROSS JOIN nb_slots s
      LEFT JOIN fold_slots f ON f.h = c.h AND f.idx = s.idx
      LEFT JOIN fold_sums u ON u.h = c.h AND u.label = c.label AND u.idx = s.idx),
    fold_theta AS (
      SELECT *, ln(x + smooth) - ln(SUM(x) OVER w + smooth * COUNT(*) OVER w) AS theta
      FROM fold_x, grid WINDOW w AS (PARTITION BY h, label, point)),
    fold_starts AS (
      SELECT h, label, point, any_value(ln(n + smooth) - ln(nn + smooth * c))
             + SUM(CASE WHEN fixed THEN 0.5 * theta ELSE 0 END) AS start
      FROM fold_theta GROUP BY h, label, point),
    fold_terms AS (
      SELECT e.id, t.point, t.label, SUM(e.v * t.theta) AS term
      FROM entries e JOIN fold_theta t ON t.h = e.fold AND t.idx = e.idx AND NOT t.fixed
      GROUP BY e.id, t.point, t.label),
    fold_best AS (
      SELECT d.id, d.fold, d.label AS truth, s.point,
             arg_max(s.label, (round(s.start + coalesce(t.term, 0), 9), -s.label)) AS prediction
      FROM folded d JOIN fold_starts s ON s.h = d.fold
      LEFT JOIN fold_terms t ON t.id = d.id AND t.point = s.point AND t.label = s.label
      GROUP BY d.id, d.fold, d.label, s.point),
    fold_sides AS (
      SELECT point, fold, truth AS class, 1 AS support, 0 AS predicted,
             CASE WHEN truth = prediction THEN 1 ELSE 0 END AS hits FROM fold_best
      UNION ALL SELECT point, fold, prediction, 0, 1, 0 FROM fold_best),
    fold_rates AS (
      SELECT point, fold, class, SUM(support) AS support,
             2.0 * SUM(hits) / (SUM(support) + SUM(predicted)) AS f
      FROM fold_sides GROUP BY ALL),
    fold_f1 AS (SELECT point, fold, SUM(f * support) / SUM(support) AS f1 FROM fold_rates GROUP BY ALL)"""
# The impurity of both sides of each slot that some rows have and others lack.
FIRST_SPLIT = """sides_of AS (
      SELECT c.label, s.idx, c.n, s.name, coalesce(u.x, 0) AS inside, c.n - coalesce(u.x, 0) AS outside
      FROM classes c CROSS JOIN nb_slots s LEFT JOIN sums u ON u.label = c.label AND u.idx = s.idx),
    impurity AS (
      SELECT idx, SUM(inside) - SUM(inside * inside) / SUM(inside)
                  + SUM(outside) - SUM(outside * outside) / SUM(outside) AS loss
      FROM sides_of GROUP BY idx HAVING SUM(inside) > 0 AND SUM(outside) > 0)"""


def encoded(select: str, *more: str) -> str:
    return base(select, False, FEATURES, ENCODED, *more)


def scores(source: str) -> str:
    return f"""pairs AS (SELECT label, prediction, COUNT(*) AS n FROM {source} GROUP BY ALL),
    sides AS (
      SELECT label AS class, n AS support, 0 AS predicted,
             CASE WHEN label = prediction THEN n ELSE 0 END AS hits FROM pairs
      UNION ALL SELECT prediction, 0, n, 0 FROM pairs),
    class_sums AS (
      SELECT class, SUM(support) AS support, SUM(predicted) AS predicted, SUM(hits) AS hits
      FROM sides GROUP BY class),
    rates AS (
      SELECT *, CASE WHEN predicted > 0 THEN CAST(hits AS DOUBLE)/predicted ELSE 0 END AS p,
             CASE WHEN support > 0 THEN CAST(hits AS DOUBLE)/support ELSE 0 END AS r
      FROM class_sums),
    class_scores AS (
      SELECT *, CASE WHEN p + r > 0 THEN 2*p*r/(p+r) ELSE 0 END AS f FROM rates)"""


EVALUATION = """round(SUM(f*support)/SUM(support), 8) AS f1,
    round(CAST(SUM(hits) AS DOUBLE)/SUM(support), 8) AS accuracy,
    round(SUM(p*support)/SUM(support), 8) AS weighted_precision,
    round(SUM(r*support)/SUM(support), 8) AS weighted_recall FROM class_scores"""
CATALOGUE = """guesses AS (
      SELECT label, CAST(coalesce(greatest(least(round_even(average_rating, 0), 5), 1), 3) AS INT)
        AS prediction FROM features)"""
CONFUSION = """ratings(v) AS (VALUES (1),(2),(3),(4),(5)),
    confusion AS (
      SELECT a.v AS actual, b.v AS predicted, COUNT(g.label) AS count
      FROM ratings a CROSS JOIN ratings b
      LEFT JOIN guesses g ON g.label = a.v AND g.prediction = b.v GROUP BY 1, 2)"""
MAJORITY = """majority AS (
      SELECT CAST(stars AS INT) AS label, COUNT(*) AS count FROM kept WHERE split = 'train'
      GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1),
    baseline AS (
      SELECT CAST(stars AS INT) AS label, (SELECT label FROM majority) AS prediction
      FROM kept WHERE split = 'test')"""


def _baseline() -> str:
    parts = [
        "SELECT CAST(class AS VARCHAR) AS label, 'precision' AS metric, round(p, 6) AS value"
        " FROM class_scores",
        "SELECT CAST(class AS VARCHAR), 'recall', round(r, 6) FROM class_scores",
        "SELECT CAST(class AS VARCHAR), 'f1', round(f, 6) FROM class_scores",
        "SELECT CAST(class AS VARCHAR), 'support', CAST(support AS DOUBLE) FROM class_scores",
        "SELECT 'all', 'total_test_rows', CAST(SUM(support) AS DOUBLE) FROM class_scores",
        "SELECT 'all', 'correct_predictions', CAST(SUM(hits) AS DOUBLE) FROM class_scores",
        "SELECT 'all', 'accuracy', round(CAST(SUM(hits) AS DOUBLE)/SUM(support), 6) FROM class_scores",
        "SELECT 'all', 'macro_f1', round(AVG(f), 6) FROM class_scores",
    ]
    return " UNION ALL ".join(parts)


META_LINES = """lines AS (
      SELECT CASE WHEN p_partkey % 31 = 0 THEN '' WHEN p_partkey % 29 <> 0
                  THEN CAST(p_partkey AS VARCHAR) END AS parent_asin,
             CASE WHEN p_partkey % 13 <> 0 THEN p_type END AS main_category, p_name AS title,
             CAST(p_size/10.0 AS DOUBLE) AS average_rating, p_size*10 AS rating_number,
             CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_retailprice AS VARCHAR) END AS price,
             p_brand AS store,
             CASE WHEN p_partkey % 7 <> 0 THEN '["' || p_brand || '","' || p_type || '"]' END
               AS features_text,
             CASE WHEN p_size % 2 = 0 THEN '["' || p_name || '"]' ELSE '[]' END AS description_text,
             '["' || p_type || '","say \\"hi\\""]' AS categories_json,
             CASE WHEN p_partkey % 5 <> 0 THEN '{"Größe":"' || p_brand || ' é","Size":'
                  || CAST(p_size AS VARCHAR) || ',"Price":' || CAST(p_retailprice AS VARCHAR)
                  || ',"Note":null}' END AS details_json
      FROM part),
    stored AS (SELECT * FROM lines WHERE parent_asin <> '')"""


def _missing_keys() -> str:
    def rows(subject: str, missing: dict[str, str], source: str) -> list[str]:
        parts = [
            f"SELECT 'unreadable' AS \"check\", '{subject}' AS subject, CAST(0 AS BIGINT) AS value,"
            " TRUE AS ok"
        ]
        for key, condition in missing.items():
            n = f"COUNT(*) FILTER (WHERE {condition})"
            parts.append(f"SELECT 'missing_key', '{subject}.{key}', {n}, {n} = 0 FROM {source}")
        return parts

    reviews = dict.fromkeys(
        ("rating", "title", "text", "asin", "parent_asin", "user_id", "timestamp"), "FALSE"
    )
    reviews |= {"asin": "tax = 0 AND line <> 3", "text": "review_text IS NULL AND line <> 3"}
    products = dict.fromkeys(("parent_asin", "title"), "FALSE")
    return " UNION ALL ".join(
        rows("reviews", reviews, "facts") + rows("metadata", products, "part")
    )


def _constraints() -> str:
    counts = [
        ("not_null", f"reviews.{c}", f"COUNT(*) FILTER (WHERE {c} IS NULL)", "facts")
        for c in ("review_id", "parent_asin", "user_id", "rating")
    ]
    counts.append(("not_null", "reviews.review_timestamp", "COUNT(*) - COUNT(millis)", "facts"))
    for c, longest in {"review_id": 64, "parent_asin": 32, "user_id": 128, "asin": 32}.items():
        n = f"COUNT(*) FILTER (WHERE length({c}) > {longest})"
        counts.append(("max_length", f"reviews.{c}", n, "facts"))
    n = "COUNT(*) FILTER (WHERE parent_asin IS NULL)"
    counts.append(("not_null", "metadata.parent_asin", n, "metadata"))
    n = "COUNT(*) FILTER (WHERE length(parent_asin) > 32)"
    counts.append(("max_length", "metadata.parent_asin", n, "metadata"))
    n = "COUNT(*) - COUNT(DISTINCT parent_asin)"
    counts.append(("primary_key", "metadata", n, "metadata"))
    n = "COUNT(*) - COUNT(DISTINCT (parent_asin, review_id))"
    counts.append(("primary_key", "reviews", n, "facts"))
    n = "COUNT(*) FILTER (WHERE parent_asin NOT IN (SELECT parent_asin FROM metadata))"
    counts.append(("foreign_key", "reviews.parent_asin", n, "facts"))
    return " UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", '{subject}' AS subject, {n} AS value, {n} = 0 AS ok FROM {t}"
        for check, subject, n, t in counts
    )


DEDUPED = """deduped AS (
      SELECT * FROM reviews QUALIFY row_number() OVER (
        PARTITION BY parent_asin, review_id
        ORDER BY epoch NULLS FIRST, helpful_vote NULLS FIRST, review_title NULLS FIRST,
          user_id, asin, rating, review_text, verified_purchase NULLS FIRST,
          images_json NULLS FIRST) = 1)"""

LANDING_REVIEWS = staged("reviews", ts="epoch")
META_COLUMNS = """parent_asin, main_category, title, average_rating, rating_number, price, store,
    features_text, description_text, categories_json, details_json"""
COMMERCE = "parent_asin, rating, helpful_vote, verified_purchase"

WHOLE_SPLIT = """COUNT(*) AS source_rows, CAST(0 AS BIGINT) AS strange_rows, TRUE AS fair_share,
    CAST(0 AS BIGINT) AS lost_rows"""

STATEMENTS: dict[str, str] = {
    "q1_category_purchase": base(Q1),
    "q2_monthly_trend": base(Q2),
    "q3_risky_stores": base(Q3),
    "q4_price_band": base(Q4),
    "q5_negative_helpfulness": base(Q5),
    "q_table_counts": base(
        "SELECT 'metadata' AS table_name, COUNT(*) AS row_count FROM metadata"
        " UNION ALL SELECT 'reviews', COUNT(*) FROM reviews"
    ),
    "q_preview": base(
        """(SELECT 'metadata' AS table_name, parent_asin, NULL AS review_id FROM metadata
            ORDER BY parent_asin LIMIT 5)
           UNION ALL (SELECT 'reviews', parent_asin, review_id FROM reviews
                      ORDER BY parent_asin, review_id LIMIT 5)"""
    ),
    "ft_sample": base(
        """SELECT COUNT(*) AS source_rows, CAST(0 AS BIGINT) AS strange_rows, TRUE AS fair_share FROM reviews"""
    ),
    "lg_rand_split": base(f"SELECT {WHOLE_SPLIT} FROM reviews"),
    "ft_random_split": base(f"SELECT {WHOLE_SPLIT} FROM features", False, FEATURES),
    "q_left_join_fact_dim": base(
        "SELECT r.parent_asin, r.rating, r.helpful_vote, r.review_timestamp, m.main_category,"
        f" m.store, m.price {JOINED}"
    ),
    "nb_category_heatmap": base(
        """SELECT main_category,
             max(CASE WHEN purchase_type = 'verified' THEN avg_rating END) AS verified_avg_rating,
             max(CASE WHEN purchase_type = 'verified' THEN low_rating_share END)
               AS verified_low_rating_share,
             max(CASE WHEN purchase_type = 'not_verified' THEN avg_rating END)
               AS not_verified_avg_rating,
             max(CASE WHEN purchase_type = 'not_verified' THEN low_rating_share END)
               AS not_verified_low_rating_share
           FROM cells GROUP BY 1""",
        False,
        f"q1 AS ({Q1})",
        """cells AS (SELECT * FROM q1 WHERE main_category <> 'unknown'
             ORDER BY review_count DESC, main_category, purchase_type LIMIT 12)""",
    ),
    "nb_month_series": base(
        """SELECT make_date(review_year, review_month, 1) AS review_date, review_count, avg_rating,
             low_rating_share, verified_purchase_ratio FROM q2""",
        False,
        f"q2 AS ({Q2})",
    ),
    "nb_top15_stores": base(
        """SELECT store, review_count, avg_rating, low_rating_share, avg_helpful_vote FROM q3
           ORDER BY low_rating_share DESC, avg_rating, review_count DESC, store LIMIT 15""",
        False,
        f"q3 AS ({Q3})",
    ),
    "nb_price_order": base(
        """SELECT *, CAST(list_position(['0_25','25_75','75_150','150_300','300_plus','unknown'],
             price_band) AS INT) AS band_position FROM q4""",
        False,
        f"q4 AS ({Q4})",
    ),
    "nb_top20_categories": base(
        "SELECT * FROM q5 ORDER BY review_count DESC, main_category LIMIT 20",
        False,
        f"q5 AS ({Q5})",
    ),
    # Sources and sinks: what was written must come back.
    "src_jsonl": base(staged("lines"), False, LINES),
    "snk_csv": base(
        staged("lines", text="CASE WHEN review_text <> '' THEN review_text END"), False, LINES
    ),
    "snk_parquet_overwrite": base(LANDING_REVIEWS),
    "src_ext_parquet": base(
        """SELECT s.*, l.price_raw AS price FROM staged s
           LEFT JOIN landing l ON s.parent_asin = l.parent_asin""",
        False,
        f"staged AS ({LANDING_REVIEWS})",
    ),
    "snk_ctas": base(Q1),
    "snk_single_csv": base(Q2),
    "src_qualified_csv": base(Q1),
    "src_table_fallback": base(f"SELECT {META_COLUMNS} FROM metadata"),
    "src_table_catalog": base(f"SELECT {META_COLUMNS} FROM metadata"),
    # Staging.
    "stg_review_id": base("SELECT review_id, user_id, parent_asin, asin FROM lines", False, LINES),
    "stg_review_map": base(staged("lines"), False, LINES),
    "stg_rating_round": base(
        "SELECT half_rating, CAST(round_even(half_rating, 0) AS INT) AS rating FROM facts"
    ),
    "stg_ts_ms": base(
        """SELECT ms AS millis, make_timestamp_ms(ms) AS ts,
             strftime(make_timestamp_ms(ms), '%Y-%m-%dT%H:%M:%S')
             || CASE WHEN ms % 1000 = 0 THEN '' ELSE strftime(make_timestamp_ms(ms), '.%f') END
             || '+00:00' AS iso
           FROM (SELECT millis + quantity * (line % 3) AS ms FROM facts)"""
    ),
    "stg_json_cells": f"""WITH {META_LINES}
        SELECT parent_asin AS id, features_text, description_text, categories_json, details_json
        FROM stored
        UNION ALL SELECT 'event ' || event_id, NULL, NULL, NULL, CAST(json(props) AS VARCHAR)
        FROM events""",
    "stg_meta_map": f"WITH {META_LINES} SELECT * FROM stored",
    "wh_ts_normalize": base(
        """SELECT parent_asin, epoch AS review_timestamp,
             CASE WHEN epoch > 32503680000 THEN make_timestamp(epoch // 1000 * 1000000)
                  ELSE make_timestamp(epoch * 1000000) END AS ts FROM facts"""
    ),
    "wh_price_clean": base(
        """SELECT l.parent_asin, l.price_raw AS raw, m.price
           FROM landing l JOIN metadata m ON l.parent_asin = m.parent_asin"""
    ),
    "wh_year_month": base(
        "SELECT parent_asin, review_timestamp, review_year, review_month FROM reviews"
    ),
    "ft_vote_clamp": base(
        """SELECT parent_asin, helpful_vote, CASE WHEN helpful_vote IS NULL THEN 0
             WHEN helpful_vote < 0 THEN 0 ELSE helpful_vote END AS votes FROM facts"""
    ),
    "ft_bool_default": base(
        """SELECT parent_asin, coalesce(verified_purchase, FALSE) AS filled,
             coalesce(verified_purchase, FALSE) AS from_text,
             CASE WHEN verified_purchase THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS as_number
           FROM facts"""
    ),
    "ft_category_clean": base(
        f"""SELECT r.parent_asin, {label_or_unknown("m.main_category")} AS main_category_clean,
             {label_or_unknown("m.store")} AS store_clean {JOINED}"""
    ),
    "lg_strip": f"""SELECT doc_id, md5({strip("padded")}) AS stripped_md5,
             CAST(length({strip("padded")}) AS INT) AS stripped_length,
             CAST(length(trim(padded, ' ')) AS INT) AS trimmed_length
           FROM (SELECT doc_id,
                   chr(9) || '  ' || text || ' ' || chr(13) || chr(10) || chr(12288) AS padded
                 FROM documents)""",
    "lg_safe_int": f"""SELECT cell, {safe_int("cell")} AS parsed,
             coalesce({safe_int("cell")}, 0) AS parsed_or_zero
           FROM (SELECT CASE l_linenumber WHEN 1 THEN 'nan' WHEN 2 THEN '' WHEN 3 THEN 'x' || c
                        ELSE c END AS cell
                 FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || ' ' AS c
                       FROM lineitem))""",
    # Filters and duplicates.
    "stg_semi_join": base(
        """SELECT review_id, parent_asin, user_id, asin, rating, review_title,
             epoch AS review_timestamp, helpful_vote, verified_purchase, images_json,
             md5(review_text) AS text_md5
           FROM reviews WHERE parent_asin IN (SELECT parent_asin FROM metadata)"""
    ),
    "stg_dedupe": base(staged("deduped", ts="epoch"), True, DEDUPED),
    "stg_linked_reviews": base(
        staged("deduped", ts="epoch")
        + " WHERE parent_asin IN (SELECT parent_asin FROM metadata)",
        True,
        DEDUPED,
    ),
    "stg_load_counts": base(
        """SELECT COUNT(DISTINCT (parent_asin, review_id)) FILTER (WHERE known) AS written,
             COUNT(*) FILTER (WHERE NOT known) AS skipped_missing_meta,
             COUNT(*) FILTER (WHERE known)
               - COUNT(DISTINCT (parent_asin, review_id)) FILTER (WHERE known) AS deduped
           FROM (SELECT *, parent_asin IN (SELECT parent_asin FROM metadata) AS known FROM reviews)""",
        True,
    ),
    "ft_validity_filter": base(
        f"""SELECT review_id, parent_asin, user_id, asin, rating, review_title, review_timestamp,
             helpful_vote, verified_purchase, images_json, review_year, review_month,
             md5(review_text) AS text_md5 FROM reviews WHERE {VALID}"""
    ),
    # Warehouse and audits.
    "wh_reviews_optimized": base(
        """SELECT review_id, parent_asin, user_id, asin, rating, review_title, review_timestamp,
             helpful_vote, verified_purchase, images_json, review_year, review_month,
             md5(review_text) AS text_md5 FROM reviews"""
    ),
    "wh_reviews_bucketed": base(
        """SELECT review_id, parent_asin, user_id, asin, rating, review_title, review_timestamp,
             helpful_vote, verified_purchase, images_json, review_year, review_month,
             md5(review_text) AS text_md5 FROM reviews"""
    ),
    "wh_metadata_bucketed": base(f"SELECT {META_COLUMNS} FROM metadata"),
    "ft_ml_features": base(
        "SELECT * EXCLUDE (review_text), md5(review_text) AS text_md5 FROM features", False, FEATURES
    ),
    "dq_required_keys": base(_missing_keys()),
    "dq_min_rows": base(
        """SELECT 'min_rows' AS "check", 'reviews' AS subject, COUNT(*) AS value,
             COUNT(*) >= 2000000 AS ok FROM reviews
           UNION ALL SELECT 'min_rows', 'metadata', COUNT(*), COUNT(*) >= 10000 FROM metadata"""
    ),
    "dq_constraints": base(_constraints(), True),
    "dq_reconcile_counts": base(
        """SELECT 'source_rows' AS "check", 'reviews' AS subject, s AS value, s = t AS ok FROM n
           UNION ALL SELECT 'loaded_rows', 'reviews', t, s = t FROM n
           UNION ALL SELECT 'source_rows', 'metadata', (SELECT COUNT(*) FROM landing), TRUE
           UNION ALL SELECT 'loaded_rows', 'metadata', (SELECT COUNT(*) FROM metadata), TRUE""",
        False,
        """n AS (SELECT COUNT(*) AS s, COUNT(*) FILTER (
             WHERE parent_asin IN (SELECT parent_asin FROM metadata)) AS t FROM reviews)""",
    ),
    # Profiling and cleaning.
    "lg_profile_before": base(_before(), True, TEXT_ROWS, MEASURED),
    "lg_drop_reasons": cleaned(
        """SELECT coalesce(drop_reason, 'kept') AS drop_reason, COUNT(*) AS row_count
           FROM reasoned GROUP BY 1"""
    ),
    "lg_clean_records": cleaned(
        f"""SELECT {", ".join(f"{strip(c)} AS {c}" for c in ("review_id", "parent_asin", "user_id",
                                                            "asin", "review_title",
                                                            "review_timestamp"))},
             CAST(greatest(coalesce({safe_int("helpful_vote")}, 0), 0) AS INT) AS helpful_vote,
             CASE WHEN lower({strip("verified_purchase")}) IN ('1','true','yes','y') THEN 'true'
                  ELSE 'false' END AS verified_purchase,
             CAST(stars AS INT) AS label, md5({strip("review_text")}) AS text_md5 FROM kept"""
    ),
    "snk_json_split": cleaned(
        f"""SELECT {", ".join(f"{strip(c)} AS {c}" for c in ("review_id", "parent_asin", "user_id",
                                                            "asin", "review_title",
                                                            "review_timestamp"))},
             CAST(greatest(coalesce({safe_int("helpful_vote")}, 0), 0) AS INT) AS helpful_vote,
             CASE WHEN lower({strip("verified_purchase")}) IN ('1','true','yes','y') THEN 'true'
                  ELSE 'false' END AS verified_purchase,
             CAST(stars AS INT) AS label, split, md5({strip("review_text")}) AS text_md5
           FROM kept"""
    ),
    "lg_hash_split": base(
        f"""SELECT parent_asin, review_id,
             CASE WHEN f < 0.8 THEN 'train' ELSE 'test' END AS split, round(f, 9) AS fraction
           FROM (SELECT *, {fraction(KEY_TEXT, 34)} AS f FROM reviews)"""
    ),
    "lg_profile_after": cleaned(_after()),
    "lg_quality_report": cleaned(
        """SELECT position, item,
             CASE item WHEN 'allowed_ratings' THEN '1,2,3,4,5'
                       WHEN 'text_len_constraints' THEN '[5,5000]'
                       ELSE CAST(n AS VARCHAR) END AS value
           FROM items LEFT JOIN numbers USING (item)
           WHERE n IS NOT NULL OR position IN (6, 7)""",
        QUALITY,
    ),
    "lg_class_balance": base(
        """SELECT split, label, COUNT(*) AS count FROM parts GROUP BY 1, 2
           UNION ALL SELECT 'all', label, COUNT(*) FROM parts GROUP BY 2""",
        False,
        FEATURES,
        f"""parts AS (SELECT *, CASE WHEN {fraction(KEY_TEXT, 34)} < 0.8 THEN 'train' ELSE 'test'
             END AS split FROM features)""",
    ),
    "lg_split_summary": base(
        f"""SELECT 'source_rows' AS metric, CAST(s AS DOUBLE) AS value FROM n
           UNION ALL SELECT 'cleaned_rows', CAST(c AS DOUBLE) FROM n
           UNION ALL SELECT 'dropped_rows', CAST(s - c AS DOUBLE) FROM n
           UNION ALL SELECT 'train_rows', CAST(t AS DOUBLE) FROM n
           UNION ALL SELECT 'test_rows', CAST(c - t AS DOUBLE) FROM n
           UNION ALL SELECT 'train_ratio_target', 0.8::DOUBLE
           UNION ALL SELECT 'train_ratio_actual', {ratio6("t", "c")} FROM n
           UNION ALL SELECT 'test_ratio_actual', {ratio6("(c - t)", "c")} FROM n""",
        False,
        FEATURES,
        f"""n AS (SELECT (SELECT COUNT(*) FROM reviews) AS s, COUNT(*) AS c,
             COUNT(*) FILTER (WHERE {fraction(KEY_TEXT, 34)} < 0.8) AS t FROM features)""",
    ),
    # Features.
    "ft_contract": base(
        "SELECT review_year, COUNT(label) AS labelled FROM features GROUP BY 1", False, FEATURES
    ),
    "ft_top_k_store": encoded("SELECT review_id, store_clean, store_bucketed FROM bucketed"),
    "ft_top_k_store_200": encoded(
        "SELECT review_id, store_clean, store_bucketed FROM bucketed"
    ).replace("LIMIT 10)", "LIMIT 200)"),
    "ft_label_index": base(
        """SELECT f.review_id, f.main_category, CAST(i.label AS DOUBLE) AS label
           FROM features f JOIN ids i ON f.main_category = i.main_category""",
        False,
        FEATURES,
        """ids AS (SELECT main_category,
             row_number() OVER (ORDER BY COUNT(*) DESC, main_category) - 1 AS label
           FROM features WHERE main_category IS NOT NULL GROUP BY 1)""",
    ),
    "ft_string_index": encoded(
        """SELECT review_id, CAST(category_idx AS DOUBLE) AS main_category_clean_idx,
             CAST(store_idx AS DOUBLE) AS store_bucketed_idx FROM encoded"""
    ),
    "ft_one_hot": encoded(
        cells("main_category_clean_ohe", ["category_idx, 1.0"])
        + " UNION ALL "
        + cells("store_bucketed_ohe", ["store_idx, 1.0"])
    ),
    "ft_assemble": encoded(
        cells("features", FULL) + " UNION ALL " + cells("features_nb", discrete(0))
    ),
    "ft_sanitize_vectors": encoded(cells("features", SPOILT)),
    "ft_vector_normalize": encoded(
        f"""SELECT CAST(label AS DOUBLE) AS label, {vector_text(list(NUMBERS))} AS features,
             {vector_text([])} AS features_nb, COUNT(*) AS n FROM encoded GROUP BY 1, 2, 3"""
    ),
    "ft_manifest": encoded(
        """SELECT 'features' AS vector, CAST(idx AS INT) AS idx, name FROM slots
           UNION ALL SELECT 'features_nb', CAST(idx AS INT), name FROM nb_slots"""
    ),
    # Models and evaluation.
    "ml_naive_bayes": encoded(
        f"SELECT 'model2' AS model, 'naive_bayes' AS model_type, {EVALUATION}",
        BAYES, PREDICTED, scores("predictions"),
    ),
    "ml_cross_validate": encoded(
        """SELECT CAST(point AS INT) AS grid_point, any_value(smooth) AS smoothing, round(AVG(f1), 8) AS f1
           FROM fold_f1 JOIN grid USING (point) GROUP BY point""",
        BAYES, FOLD_SCORES,
    ),
    "ml_forest_facts": encoded(
        """SELECT 'grid_points' AS fact, 4.0::DOUBLE AS value UNION ALL SELECT 'least_trees', 40
           UNION ALL SELECT 'largest_depth', 14 UNION ALL SELECT 'best_is_kept', 1
           UNION ALL SELECT 'scores_from_0_to_1', 4 UNION ALL SELECT 'test_rows', COUNT(*) FROM test
           UNION ALL SELECT 'slots', COUNT(*) FROM slots UNION ALL SELECT 'last_rank', COUNT(*) FROM slots
           UNION ALL SELECT 'ranks_in_order', COUNT(*) FROM slots UNION ALL SELECT 'importance_sum', 1
           UNION ALL SELECT 'top_rows', least(15, COUNT(*)) FROM slots
           UNION ALL SELECT 'first_split', arg_min(idx, (loss, idx)) FROM impurity
           UNION ALL SELECT 'first_split_importance', 1""",
        BAYES, FIRST_SPLIT,
    ),
    "ml_predict": encoded("SELECT label, prediction FROM predictions", BAYES, PREDICTED),
    "ml_model_io": encoded("SELECT label, prediction FROM predictions", BAYES, PREDICTED),
    "ml_nb_theta": encoded(
        """SELECT CAST(class_index AS INT) AS class_index, label_value,
             CAST(feature_index AS INT) AS feature_index, feature_name,
             round(weight, 8) AS log_conditional_probability FROM theta""",
        BAYES,
    ),
    "ml_nb_priors": encoded(
        """SELECT CAST(class_index AS INT) AS class_index, label_value,
             round(log_prior, 8) AS log_prior FROM priors""",
        BAYES,
    ),
    "ml_prior_probs": encoded(
        """SELECT label_value, round(exp(log_prior) / SUM(exp(log_prior)) OVER (), 8) AS prior
           FROM priors""",
        BAYES,
    ),
    "ml_theta_pivot": encoded(
        "SELECT feature_name, "
        + ", ".join(
            f"round(max(CASE WHEN label_value = {v} THEN weight END), 8) AS label_{v}"
            for v in range(1, 6)
        )
        + " FROM theta GROUP BY feature_name",
        BAYES,
    ),
    "ml_evaluation": base(f"SELECT {EVALUATION}", False, FEATURES, CATALOGUE, scores("guesses")),
    "ml_majority_baseline": cleaned("SELECT label, count FROM majority", MAJORITY),
    "ml_baseline_metrics": cleaned(_baseline(), MAJORITY, scores("baseline")),
    "ml_confusion": base(
        "SELECT actual, predicted, count FROM confusion", False, FEATURES, CATALOGUE, CONFUSION
    ),
    "ml_confusion_pairs": base(
        "SELECT actual, predicted, count FROM confusion WHERE count > 0",
        False, FEATURES, CATALOGUE, CONFUSION,
    ),
    "ml_confusion_norm": base(
        f"""SELECT actual, predicted, count, {ratio6("count", "total")} AS share
           FROM (SELECT *, CAST(SUM(count) OVER (PARTITION BY actual) AS BIGINT) AS total
                 FROM confusion)""",
        False, FEATURES, CATALOGUE, CONFUSION,
    ),
    "ml_train_labels": base(
        "SELECT DISTINCT CAST(label AS DOUBLE) AS label FROM features", False, FEATURES
    ),
}

ORACLE = {name: portable_sql(name, sql) for name, sql in STATEMENTS.items()}
