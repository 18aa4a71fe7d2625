"""The same results as plain SQL for another engine, on the same tables.

A mart is put together from one small query per column, each with the key, so that no column depends on how another
one is computed, nor on the single aggregate of the Spark plans.
"""

from __future__ import annotations

from plaudit.contracts import FOREIGN_KEYS, GOLD, MERGE, METADATA, PRIMARY_KEYS, REVIEWS
from plaudit.plans.registry import _MART_KEYS, _MART_VALUES, LOADED_AT, STREAMS
from plaudit.sources import starschema as s


def _select(expressions: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{name}"' for name, e in expressions.items())


def _quoted(names, prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{name}"' for name in names)


_SALES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
_ITEM_FIELDS = [n for n in METADATA.fieldNames() if n != "parent_product_id"]


def _uuid7(millis: str, digest: str) -> str:
    time = f"lpad(lower(to_hex({millis})), 12, '0')"
    return (f"substr({time}, 1, 8) || '-' || substr({time}, 9, 4) || '-7' || substr({digest}, 1, 3) || '-' || "
            f"translate(substr({digest}, 4, 1), '0123456789abcdef', '89ab89ab89ab89ab') || "
            f"substr({digest}, 5, 3) || '-' || substr({digest}, 8, 12)")


def _name_id(kind: str, name: str) -> str:
    digest = f"md5('{kind}:' || {name})"
    return (f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-3' || substr({digest}, 14, 3) || '-' || "
            f"translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || "
            f"substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)")


def _content() -> str:
    parts = []
    for name in MERGE.fieldNames():
        text = f"""CAST({'epoch_ms("timestamp")' if name == "timestamp" else f'"{name}"'} AS VARCHAR)"""
        parts.append(f"coalesce(length({text}) || ':' || {text}, '-')")
    return f"md5({' || '.join(parts)})"


_MERGE = f"""
r AS (SELECT {_select(s.REVIEW_COLUMNS)} FROM {_SALES}),
m AS (SELECT {_select(s.ITEM_COLUMNS)} FROM part),
merged AS (SELECT {_quoted(REVIEWS.fieldNames(), 'r.')}, {_quoted(_ITEM_FIELDS, 'm.')}
           FROM r JOIN m ON r.parent_product_id = m.parent_product_id)"""

_IDS = f"""{_MERGE},
digested AS (SELECT *, {_content()} AS _digest FROM merged),
merge_data AS (SELECT {_uuid7('epoch_ms("timestamp")', '_digest')} AS review_id,
    {_uuid7('epoch_ms("timestamp")', "md5('time:' || _digest)")} AS time_id,
    {_name_id('store', 'store')} AS store_id, {_name_id('category', 'category')} AS category_id,
    {_quoted(MERGE.fieldNames())} FROM digested)"""

# Raw lines: the faults and values that the line rules produce.
_LINE_REASON = """CASE WHEN l_discount = 0 THEN 'corrupt_json'
    WHEN l_linenumber = 7 THEN 'bad_type:rating'
    WHEN l_tax = 0 THEN 'missing_required:review_title'
    WHEN l_discount IN (0.08, 0.09) THEN 'bad_type:timestamp'
    WHEN l_tax = 0.08 THEN 'bad_type:helpful_vote' END"""
_ITEM_REASON = """CASE WHEN p_size = 4 THEN 'missing_required:category'
    WHEN p_size IN (3, 7) THEN 'bad_type:price' END"""
_LINE_REVIEWS = {
    **s.REVIEW_COLUMNS,
    "timestamp": f"CASE WHEN l_discount <> 0.1 THEN {s.REVIEW_COLUMNS['timestamp']} END",
}
_LINE_ITEMS = {
    **s.ITEM_COLUMNS,
    "price": f"CASE WHEN p_size <> 5 THEN {s.ITEM_COLUMNS['price']} END",
    "brand": "CASE WHEN p_size <> 2 THEN p_brand END",
    "material": "CAST(NULL AS VARCHAR)",
    "color": "CASE WHEN p_size <> 2 THEN split_part(p_name, ' ', 1) END",
}
_LINES = f"""
r AS (SELECT {_select(_LINE_REVIEWS)} FROM {_SALES} WHERE ({_LINE_REASON}) IS NULL),
m AS (SELECT {_select(_LINE_ITEMS)} FROM part WHERE ({_ITEM_REASON}) IS NULL),
merged AS (SELECT {_quoted(REVIEWS.fieldNames(), 'r.')}, {_quoted(_ITEM_FIELDS, 'm.')}
           FROM r JOIN m ON r.parent_product_id = m.parent_product_id)"""

_PRODUCT = "concat(CAST(l_partkey AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR))"
_RAW_REVIEWS = f"""
SELECT '{LOADED_AT}' AS created, CAST({s.REVIEW_COLUMNS['rating']} AS DOUBLE) AS rating,
    CASE WHEN l_tax <> 0 THEN o_orderpriority END AS title, {s.REVIEW_COLUMNS['review_text']} AS text,
    CASE WHEN l_linenumber = 1 THEN '' ELSE concat('s/', {_PRODUCT}, ' s2/', {_PRODUCT}) END AS small_image_urls,
    CASE WHEN l_linenumber = 1 THEN '' ELSE concat('m/', {_PRODUCT}) END AS medium_image_urls,
    CASE WHEN l_linenumber = 1 THEN '' ELSE concat('l/', {_PRODUCT}) END AS large_image_urls,
    {_PRODUCT} AS asin, CAST(l_partkey AS VARCHAR) AS parent_asin, CAST(o_custkey AS VARCHAR) AS user_id,
    CASE WHEN l_discount = 0.1 THEN NULL WHEN l_discount = 0.09 THEN '9223372036854775807'
         WHEN l_discount = 0.08 THEN '1000000000000000' WHEN l_discount = 0.05 THEN CAST(epoch_ms(l_shipdate) AS VARCHAR)
         ELSE CAST(epoch_ms(l_shipdate) + 789 AS VARCHAR) END AS "timestamp",
    CASE WHEN l_tax = 0.08 THEN 3000000000 ELSE CAST(l_linenumber AS BIGINT) END AS helpful_vote,
    l_returnflag <> 'R' AS verified_purchase
FROM {_SALES} WHERE l_discount <> 0 AND l_linenumber <> 7"""
_RAW_ITEMS = f"""
SELECT '{LOADED_AT}' AS created, CASE WHEN p_size <> 4 THEN p_type END AS main_category, p_name AS title,
    CASE WHEN p_size = 6 THEN floor(p_retailprice) + 0.125 WHEN p_size <> 5 THEN p_retailprice END AS price,
    CASE WHEN p_size % 5 = 0 THEN '' ELSE concat('h/', CAST(p_partkey AS VARCHAR)) END AS hi_res_images,
    concat('l/', CAST(p_partkey AS VARCHAR), ' l2/', CAST(p_partkey AS VARCHAR)) AS large_images,
    concat('t/', CAST(p_partkey AS VARCHAR)) AS thumb_images,
    CASE WHEN p_size % 10 <> 0 THEN p_brand END AS store,
    CASE WHEN p_size <> 2 THEN p_brand END AS brand, CAST(NULL AS VARCHAR) AS material,
    CAST(NULL AS VARCHAR) AS style, CASE WHEN p_size <> 2 THEN split_part(p_name, ' ', 1) END AS color,
    CAST(p_partkey AS VARCHAR) AS parent_asin
FROM part WHERE p_size NOT IN (3, 7)"""


def _by_column(mart: str, key: str, columns: dict[str, str], rows: str = "merged") -> str:
    """A mart of one row per key; each column is an expression over that key's rows, in a query of its own."""
    parts = [f"SELECT DISTINCT {key} FROM {rows} WHERE {key} IS NOT NULL"]
    parts += [f"SELECT {key}, {expression} AS {name} FROM {rows} GROUP BY {key}" for name, expression in columns.items()]
    joined = " ".join(f"LEFT JOIN ({part}) c{k} USING ({key})" for k, part in enumerate(parts) if k)
    return f"{mart} AS (SELECT {key}, {', '.join(columns)} FROM ({parts[0]}) c0 {joined})"


_N = "COUNT(*)"
_BOUGHT = "COUNT(*) FILTER (verified_purchase)"
_VOTES = "CAST(SUM(helpful_vote) AS BIGINT)"
_STARS = "ROUND(AVG(rating))"
_PRODUCTS = "COUNT(DISTINCT parent_product_id)"
# Prices are added up as they are written.
_REVENUE = "CAST(COALESCE(SUM(CAST(CAST(price AS VARCHAR) AS DECIMAL(38, 12))), 0) AS DOUBLE)"


def _store_mart(rows: str = "merged") -> str:
    per_store = _by_column("per_store", "store", {
        "total_reviews": _N, "avg_rating": _STARS, "total_sell_products": _PRODUCTS, "total_revenue": _REVENUE}, rows)
    return f"""{per_store},
mart_store_performance AS (
    SELECT {_name_id('store', 'store')} AS store_id, * RENAME (store AS store_name) FROM per_store)"""


_USER_CATEGORIES = """
user_categories AS (SELECT user_id, category, COUNT(*) AS category_count FROM merged GROUP BY ALL),
favourites AS (SELECT user_id, category AS top_category, category_count FROM user_categories
    QUALIFY RANK() OVER (PARTITION BY user_id ORDER BY category_count DESC, category) = 1)"""
_MART_USERS = _USER_CATEGORIES + ", " + _by_column("per_user", "user_id", {
    "total_reviews": _N, "avg_rating": "AVG(rating)", "total_helpful_votes": _VOTES, "total_buy_products": _BOUGHT,
    "first_review_date": 'MIN("timestamp")', "last_review_date": 'MAX("timestamp")'}) + """,
mart_users AS (SELECT per_user.*, top_category FROM per_user JOIN favourites USING (user_id))"""
_MART_PRODUCTS = _by_column("mart_parent_products", "parent_product_id", {
    "total_reviews": _N, "avg_rating": _STARS, "total_helpful_votes": _VOTES, "total_sell_products": _BOUGHT})
_MART_CATEGORIES = _by_column("per_category", "category", {
    "total_products": _PRODUCTS, "total_helpful_votes": _VOTES, "total_reviews": _N, "avg_rating": _STARS,
    "verified_purchases": _BOUGHT}) + f""",
mart_categories AS (
    SELECT {_name_id('category', 'category')} AS category_id, * RENAME (category AS category_name) FROM per_category)"""
_MART_REVIEWS = """
mart_reviews AS (SELECT review_id, user_id, product_id, CAST(rating AS DOUBLE) AS rating, verified_purchase,
    CAST(helpful_vote AS BIGINT) AS helpful_vote FROM merge_data)"""
_ATTRIBUTES = ["parent_product_id", "store", "category", "product_title", "price", "brand", "material"]
_SILVER = f"""
dim_time AS (SELECT time_id, "timestamp" AS review_date, CAST(year("timestamp") AS INTEGER) AS "year",
    CAST(month("timestamp") AS INTEGER) AS "month", CAST(day("timestamp") AS INTEGER) AS "day",
    CAST(quarter("timestamp") AS INTEGER) AS "quarter" FROM merge_data),
dim_reviews AS (SELECT review_id, review_title, review_text FROM merge_data),
first_seen AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id
        ORDER BY "timestamp", {', '.join(f'{a} NULLS FIRST' for a in _ATTRIBUTES)}) AS rn FROM merge_data),
dim_products AS (SELECT product_id, parent_product_id, store, category, product_title,
    CAST(CAST(price AS VARCHAR) AS DOUBLE) AS price, brand, material FROM first_seen WHERE rn = 1),
fact_reviews AS (SELECT review_id, user_id, time_id, product_id, CAST(rating AS DOUBLE) AS rating,
    verified_purchase, CAST(helpful_vote AS BIGINT) AS helpful_vote FROM merge_data)"""
_ALL = ",".join([_IDS, _SILVER, _MART_USERS, _MART_PRODUCTS, _MART_CATEGORIES, _store_mart(), _MART_REVIEWS])


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _key_report() -> str:
    parts = [
        f"""SELECT '{name}' AS table_name, CAST(SUM(n) AS BIGINT) AS n_rows,
            CAST(COALESCE(SUM(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_keys,
            CAST(COALESCE(SUM(CASE WHEN n > 1 AND k IS NOT NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS repeated_keys
            FROM (SELECT {key} AS k, COUNT(*) AS n FROM {name} GROUP BY {key}) q"""
        for name, key in PRIMARY_KEYS.items()
    ]
    return _with(_ALL, " UNION ALL ".join(parts))


def _foreign_report() -> str:
    parts = [
        f"""SELECT '{child}.{key} -> {parent}' AS constraint_name, COUNT(*) AS orphan_rows FROM {child} c
            WHERE c.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"""
        for child, key, parent in FOREIGN_KEYS
    ]
    return _with(_ALL, " UNION ALL ".join(parts))


# Change streams.
_CHANGES = " UNION ALL ".join(
    [f"""SELECT '{STREAMS.reviews_topic}' AS topic, 'c' AS op, 'raw_reviews' AS source_table, false AS has_before,
        CAST(l_partkey AS VARCHAR) AS parent_asin,
        CAST(l_linenumber AS BIGINT) AS ts_ms, CAST(l_orderkey % 3 AS INTEGER) AS "partition",
        CAST(l_orderkey * 16 + l_linenumber AS BIGINT) AS "offset", CAST(NULL AS VARCHAR) AS reason,
        {s.REVIEW_CHANGE} AS "value" FROM {_SALES}"""]
    + [f"""SELECT '{STREAMS.items_topic}', {op}, {origin}, {before}, {key}, CAST({s.ITEM_STEPS[version]} AS BIGINT),
        CAST(p_partkey % 3 AS INTEGER), CAST(p_partkey * 16 + {s.ITEM_STEPS[version]} AS BIGINT), {reason},
        {s.item_change(version)} FROM part WHERE {s.item_rows(version)}"""
       for version, op, origin, before, key, reason in [
           ("v1", "'c'", "'raw_item_metadata'", "false", "CAST(p_partkey AS VARCHAR)", "NULL"),
           ("v2", "'u'", "'raw_item_metadata'", "true", "CAST(p_partkey AS VARCHAR)", "NULL"),
           ("gone", "'d'", "'raw_item_metadata'", "false", "NULL", "'delete_event'"),
           ("tombstone", "NULL", "NULL", "false", "NULL", "'tombstone'")]]
)
# Per review: the latest version not after it, otherwise the first one after it.
_PAIRS = f"""
versions AS (
    SELECT p_partkey, {s.ITEM_STEPS['v1']} AS step, p_name AS item_title FROM part WHERE {s.item_rows('v1')}
    UNION ALL
    SELECT p_partkey, {s.ITEM_STEPS['v2']}, concat(p_name, ' v2') FROM part WHERE {s.item_rows('v2')}),
placed AS (
    SELECT *, COALESCE(
        (SELECT max(v.step) FROM versions v WHERE v.p_partkey = l_partkey AND v.step <= l_linenumber),
        (SELECT min(v.step) FROM versions v WHERE v.p_partkey = l_partkey AND v.step > l_linenumber)) AS taken
    FROM {_SALES}),
pairs AS (
    SELECT *, CASE WHEN l_linenumber = 7 THEN 'bad_type:rating' WHEN l_tax = 0 THEN 'missing_required:review_title'
        WHEN l_discount = 0.09 THEN 'bad_type:timestamp' WHEN p_size IN (7, 8) THEN 'bad_type:price' END AS fault
    FROM placed JOIN versions v ON v.p_partkey = l_partkey AND v.step = taken
    JOIN part p ON p.p_partkey = l_partkey)"""
_STREAM_MERGE = f"""
WITH {_PAIRS}
SELECT {_select(s.REVIEW_COLUMNS)}, p_type AS category, item_title AS product_title,
    {s.ITEM_COLUMNS['price']} AS price, CASE WHEN p_size % 10 <> 0 THEN p_brand END AS store,
    p_brand AS brand, CAST(NULL AS VARCHAR) AS material, CAST(NULL AS VARCHAR) AS style,
    split_part(p_name, ' ', 1) AS color
FROM pairs WHERE fault IS NULL"""
_MERGE_REJECTS = f"""
WITH {_PAIRS}
SELECT {s.REVIEW_COLUMNS['review_text']} AS review_text, item_title AS product_title, fault AS reason
FROM pairs WHERE fault IS NOT NULL"""

_LANDED = f"""
SELECT CASE WHEN l_discount <> 0 AND l_linenumber <> 7 THEN 'valid' ELSE 'rejected' END AS status,
    'raw_reviews' AS table_name, COUNT(*) AS n_rows,
    COUNT(*) FILTER (l_discount <> 0 AND l_linenumber <> 7) AS n_numbers,
    CAST(SUM(CASE WHEN l_discount <> 0 AND l_linenumber <> 1 THEN 2 ELSE 0 END) AS BIGINT) AS n_images
FROM {_SALES} GROUP BY 1
UNION ALL SELECT CASE WHEN p_size IN (3, 7) THEN 'rejected' ELSE 'valid' END, 'raw_item_metadata', COUNT(*),
    COUNT(*) FILTER (p_size NOT IN (3, 5, 7)), CAST(2 * COUNT(*) AS BIGINT) FROM part GROUP BY 1"""

_COUNTS = f"""
SELECT COALESCE({_LINE_REASON}, 'valid') AS outcome, 'reviews' AS entity, COUNT(*) AS n_lines
FROM {_SALES} GROUP BY 1
UNION ALL SELECT COALESCE({_ITEM_REASON}, 'valid'), 'metadata', COUNT(*) FROM part GROUP BY 1"""

_DUCK = {"STRING": "VARCHAR"}


def _mart_rows() -> str:
    def columns(mart: str) -> str:
        found = {f.name for f in GOLD[mart].fields}
        return ", ".join(f"CAST({c if c in found else 'NULL'} AS {_DUCK.get(kind, kind)}) AS {c}"
                         for c, kind in _MART_VALUES.items())

    return _with(f"{_MERGE}, {_MART_USERS}, {_MART_PRODUCTS}, {_MART_CATEGORIES}, {_store_mart()}", " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, {key} AS \"key\", {columns(mart)} FROM {mart}" for mart, key in _MART_KEYS.items()))


ORACLE: dict[str, str] = {
    "silver_reviews": _with(_LINES, "SELECT * FROM r"),
    "silver_metadata": _with(_LINES, "SELECT * FROM m"),
    "quarantine_reviews":
        f"SELECT {s.REVIEW_LINE} AS \"value\", {_LINE_REASON} AS reason FROM {_SALES} WHERE ({_LINE_REASON}) IS NOT NULL",
    "quarantine_metadata":
        f"SELECT {s.ITEM_LINE} AS \"value\", {_ITEM_REASON} AS reason FROM part WHERE ({_ITEM_REASON}) IS NOT NULL",
    "ingest_counts": _COUNTS,
    "raw_reviews_flatten": _RAW_REVIEWS,
    "raw_items_flatten": _RAW_ITEMS,
    "raw_tables_landed": _LANDED,
    "path_routing": f"SELECT 'reviews' AS entity, COUNT(*) AS n_lines FROM {_SALES} "
                    "UNION ALL SELECT 'metadata', COUNT(*) FROM part",
    "merge_batch_inner": _with(_MERGE, "SELECT * FROM merged"),
    "merge_bucketed": _with(_MERGE, "SELECT * FROM merged"),
    "catalog_years": _with(_MERGE, "SELECT CAST(year(\"timestamp\") AS INTEGER) AS review_year, category, "
                           "COUNT(*) AS total_reviews, COUNT(*) FILTER (verified_purchase) AS bought FROM merged "
                           "WHERE year(\"timestamp\") BETWEEN 1995 AND 1996 GROUP BY 1, 2"),
    "merge_from_lines": _with(_LINES, "SELECT * FROM merged"),
    "merge_fans_out": _with(_MERGE, "SELECT * FROM merged UNION ALL SELECT * FROM merged"),
    "merge_data_ids": _with(_IDS, "SELECT * FROM merge_data"),
    "uuid7_ids": f"SELECT COUNT(*) AS n_rows, COUNT(*) AS n_ids, COUNT(*) AS n_well_formed FROM {_SALES}",
    "review_preview": _with(_IDS, "SELECT review_id, store_id, category_id FROM merge_data ORDER BY 1 LIMIT 20"),
    "union_batch_stream": _with(_IDS, "SELECT *, 'batch' AS source FROM merge_data "
                                      "UNION ALL SELECT *, 'stream' FROM merge_data"),
    "dedup_reviews": _with(_IDS, "SELECT *, 'batch' AS source FROM merge_data"),
    "latest_items": _with(_MERGE, "SELECT * REPLACE (product_title || ' v2' AS product_title), 2 AS version FROM m"),
    **{name: _with(f"{_IDS}, {_SILVER}", f"SELECT * FROM {name}")
       for name in ("dim_time", "dim_reviews", "dim_products", "fact_reviews")},
    "pk_violations": _key_report(),
    "fk_orphans": _foreign_report(),
    "key_report_both_paths": _key_report(),
    "natural_key_duplicates": "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem "
                              "GROUP BY 1, 2 HAVING COUNT(*) > 1",
    "orphan_products": f"SELECT CAST(l_partkey AS VARCHAR) AS parent_product_id, COUNT(*) AS n_rows FROM {_SALES} "
                       f"WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE ({_ITEM_REASON}) IS NULL) GROUP BY 1",
    "mart_users": _with(f"{_MERGE}, {_MART_USERS}", "SELECT * FROM mart_users"),
    "mart_parent_products": _with(f"{_MERGE}, {_MART_PRODUCTS}", "SELECT * FROM mart_parent_products"),
    "mart_categories": _with(f"{_MERGE}, {_MART_CATEGORIES}", "SELECT * FROM mart_categories"),
    "mart_store_performance": _with(f"{_MERGE}, {_store_mart()}", "SELECT * FROM mart_store_performance"),
    "mart_reviews": _with(f"{_IDS}, {_MART_REVIEWS}", "SELECT * FROM mart_reviews"),
    "top_stores": _with(f"{_MERGE}, {_store_mart()}", "SELECT * FROM mart_store_performance "
                        "ORDER BY total_revenue DESC, store_name LIMIT 10"),
    "top_category_per_user": _with(f"{_MERGE}, {_MART_USERS}",
                                   "SELECT * FROM favourites"),
    "user_category_counts": _with(f"{_MERGE}, {_MART_USERS}", "SELECT * FROM user_categories"),
    "verified_counts": _with(_MERGE, " UNION ALL ".join(
        f"SELECT k.{key} AS \"key\", '{key}' AS key_kind, COALESCE(v.n, 0) AS verified "
        f"FROM (SELECT DISTINCT {key} FROM merged) k LEFT JOIN (SELECT {key}, COUNT(*) AS n FROM merged "
        f"WHERE verified_purchase = true GROUP BY {key}) v ON k.{key} = v.{key}"
        for key in ("user_id", "parent_product_id", "category"))),
    "distinct_products": _with(_MERGE, "SELECT category, COUNT(DISTINCT parent_product_id) AS total_products "
                                       "FROM merged GROUP BY category"),
    "catalog_sql": _with(_MERGE, "SELECT category, CAST(year(\"timestamp\") AS INTEGER) AS review_year, "
                         "COUNT(*) AS total_reviews, COUNT(DISTINCT user_id) AS total_users, "
                         "MAX(helpful_vote) AS most_votes FROM merged WHERE verified_purchase GROUP BY 1, 2"),
    "historical_store_mart": _with(f"{_LINES}, {_store_mart()}", "SELECT * FROM mart_store_performance"),
    "epoch_millis_ts": """SELECT event_id, date_trunc('second', ts) AS "at",
        strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at_text, date_trunc('second', ts) AS back,
        CAST(year(ts) AS INTEGER) AS "year", CAST(month(ts) AS INTEGER) AS "month",
        CAST(day(ts) AS INTEGER) AS "day", CAST(quarter(ts) AS INTEGER) AS "quarter" FROM events""",
    "event_props": "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "wire_roundtrip": _with(_MERGE, "SELECT *, CAST(NULL AS VARCHAR) AS reason FROM merged UNION ALL SELECT "
                            + ", ".join("NULL" for _ in MERGE.fields) + ", 'unknown_schema' FROM merged "
                            "WHERE helpful_vote = 7"),
    "wire_versions": _with(_MERGE, f"""SELECT *, CAST(NULL AS VARCHAR) AS reason FROM merged WHERE helpful_vote <= 2
        UNION ALL SELECT * REPLACE (NULL AS helpful_vote, NULL AS brand), NULL FROM merged WHERE helpful_vote IN (3, 4)
        UNION ALL SELECT * REPLACE (NULL AS verified_purchase), NULL FROM merged WHERE helpful_vote = 5
        UNION ALL SELECT {", ".join("NULL" for _ in MERGE.fields)}, CASE helpful_vote WHEN 6 THEN 'incompatible_schema'
            ELSE 'unknown_schema' END FROM merged WHERE helpful_vote >= 6"""),
    "cdc_envelope_parse": f"WITH c AS ({_CHANGES}) SELECT * EXCLUDE (\"value\") FROM c",
    "cdc_rejects": f"WITH c AS ({_CHANGES}) SELECT topic, \"partition\", \"offset\", \"value\", reason "
                   "FROM c WHERE reason IS NOT NULL",
    "stream_merge": _STREAM_MERGE,
    "merge_rejects": _MERGE_REJECTS,
    "replay_merge": _STREAM_MERGE,
    "marts_incremental": _mart_rows(),
    "current_items": f"SELECT p_type AS category, CAST(p_partkey AS VARCHAR) AS parent_product_id, "
                     f"concat(p_name, ' v2') AS product_title, {s.ITEM_COLUMNS['price']} AS price, "
                     "CASE WHEN p_size % 10 <> 0 THEN p_brand END AS store, p_brand AS brand, CAST(NULL AS VARCHAR) AS "
                     "material, CAST(NULL AS VARCHAR) AS style, split_part(p_name, ' ', 1) AS color "
                     "FROM part WHERE p_size NOT IN (7, 8, 48, 50)",
    "merge_after_relayout": _STREAM_MERGE,
    # Waits when it comes, and still when the next delivery has been merged; those of the last delivery go on waiting.
    "expired_reviews": f"SELECT {s.REVIEW_COLUMNS['review_text']} AS review_text, 'no_item' AS reason "
                       f"FROM {_SALES} JOIN part ON p_partkey = l_partkey WHERE l_linenumber <= 2 AND NOT EXISTS ("
                       "SELECT 1 FROM (VALUES (p_size % 3 + 1), (p_size % 3 + 5)) v(step) WHERE p_size <> 50 "
                       "AND CASE WHEN v.step <= 2 THEN v.step ELSE 3 END <= l_linenumber + 1)",
    "stream_to_lake": _with(_IDS, "SELECT *, 'stream' AS source FROM merge_data"),
    "compacted_merge_data": _with(_IDS, "SELECT *, 'stream' AS source FROM merge_data"),
    "landing_dedup": _with(_IDS, "SELECT *, 'stream' AS source FROM merge_data UNION ALL "
                                 "SELECT *, 'stream' FROM merge_data WHERE verified_purchase AND helpful_vote = 1"),
    "cdc_archive": f"WITH c AS ({_CHANGES}) SELECT topic, \"partition\", \"value\" FROM c WHERE \"value\" IS NOT NULL",
}
