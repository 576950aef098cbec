"""The checked queries in SQL, written independently of the Spark plans."""

from __future__ import annotations

SHOP = """
labels AS (SELECT p_partkey AS product_id, p_type AS category_code, p_brand AS brand FROM part),
clicks AS (
  SELECT ts AS event_ts, cast(ts AS date) AS event_date, event_type, user_id,
         cast(json_extract_string(props, '$.k') AS bigint) AS product_id, value AS price
  FROM events),
shop AS (
  SELECT c.*, l.category_code, l.brand FROM clicks c LEFT JOIN labels l USING (product_id))
"""

EVENT_ID = """sha256(concat_ws('||', coalesce(cast(user_id AS varchar), ''),
  coalesce(cast(event_ts AS varchar), ''), coalesce(event_type, ''),
  coalesce(cast(product_id AS varchar), '')))"""

KEYED_SHOP = SHOP + f", ev AS (SELECT *, {EVENT_ID} AS event_id FROM shop)"

ORDERS = """
ev AS (
  SELECT o_custkey AS user_id, o_orderdate AS event_ts, cast(o_orderdate AS date) AS event_date,
         'order' AS event_type, l_partkey AS product_id, cast(l_quantity AS integer) AS quantity,
         l_extendedprice / l_quantity AS price, p_type AS category_code, p_brand AS brand
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey)
"""

RAW = """
numbered AS (
  SELECT event_id AS n, ts, event_type AS kind, user_id AS u, value,
         json_extract_string(props, '$.k') AS k
  FROM events),
first_drop AS (
  SELECT n,
    CASE WHEN n % 97 = 0 THEN 'garbage' WHEN n % 89 = 0 THEN '   '
         WHEN n % 3 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S UTC')
         WHEN n % 3 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS event_time,
    CASE WHEN n % 19 = 0 THEN '  ' WHEN n % 5 = 0 THEN '  ' || upper(kind) || ' '
         ELSE kind END AS event_type,
    CASE WHEN n % 17 = 0 THEN 'abc' WHEN n % 7 = 0 THEN k || '.7' ELSE k END AS product_id,
    CASE WHEN n % 23 <> 0 THEN p_type END AS category_code,
    ' ' || p_brand AS brand,
    CASE WHEN n % 29 = 0 THEN 'n/a' ELSE cast(value AS varchar) END AS price,
    CASE WHEN n % 13 = 0 THEN ' ' ELSE cast(u AS varchar) END AS user_id,
    cast(n AS varchar) AS user_session,
    CASE WHEN n % 10 = 7 THEN 2 ELSE 1 END AS drop_no
  FROM numbered LEFT JOIN part ON cast(k AS bigint) = p_partkey),
raw AS (
  SELECT * EXCLUDE (n) FROM first_drop
  UNION ALL
  SELECT * EXCLUDE (n) REPLACE ('1.25' AS price, 2 AS drop_no)
  FROM first_drop WHERE n % 10 = 3 AND price IS NOT NULL)
"""

EVENT_TS = """coalesce(try_strptime(event_time, '%Y-%m-%d %H:%M:%S UTC'),
  try_strptime(event_time, '%Y-%m-%d %H:%M:%S'),
  try_strptime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ'))"""


def _clean(column: str) -> str:
    return f"nullif(trim({column}), '') AS {column}"


def _whole(column: str) -> str:
    pattern = r"^\s*([+-]?\d+)(\.\d*)?\s*$"
    return f"try_cast(nullif(regexp_extract({column}, '{pattern}', 1), '') AS bigint) AS {column}"


TEXT = ("event_time", "event_type", "product_id", "category_code", "brand", "price", "user_id", "user_session")

BRONZE = RAW + f""",
bronze AS (
  SELECT * EXCLUDE (drop_no), TIMESTAMP '2024-02-01 00:00:00' + to_hours(drop_no) AS ingest_ts,
         'drop-' || drop_no AS source_file, {EVENT_TS} AS event_ts,
         cast({EVENT_TS} AS date) AS event_date
  FROM raw)
"""

TYPED = BRONZE + f""",
cleaned AS (SELECT {", ".join(_clean(c) for c in TEXT)}, ingest_ts, source_file, event_ts, event_date
            FROM bronze),
typed AS (
  SELECT event_time, event_type, {_whole("product_id")}, category_code, brand,
         try_cast(price AS double) AS price, {_whole("user_id")}, user_session, ingest_ts,
         source_file, event_ts, event_date
  FROM cleaned),
keyed AS (SELECT *, {EVENT_ID} AS event_id FROM typed)
"""

SILVER = TYPED + """,
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY event_id
    ORDER BY ingest_ts DESC NULLS LAST, source_file NULLS FIRST, event_time NULLS FIRST,
             event_type NULLS FIRST, product_id NULLS FIRST, category_code NULLS FIRST,
             brand NULLS FIRST, price NULLS FIRST, user_id NULLS FIRST, user_session NULLS FIRST) AS rn
  FROM keyed),
ev AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)
"""

# Clicks with native ids and numbers as text, in the columns' order.
NATIVE_TEXT = (*TEXT, "event_id", "category_id", "quantity", "amount")
NATIVE_BRONZE = RAW + f""",
native AS (
  SELECT *, CASE WHEN s % 11 = 0 THEN '  ' WHEN s % 10 = 9 THEN 'e' || (s - 9) ELSE ' e' || s END AS event_id,
    CASE WHEN s % 23 = 0 THEN '12.0' ELSE cast(s % 50 AS varchar) END AS category_id,
    CASE WHEN s % 31 = 0 THEN 'x' ELSE (s % 4) || '.9' END AS quantity,
    CASE WHEN s % 37 = 0 THEN '' ELSE (s % 9) || '.5' END AS amount
  FROM (SELECT *, cast(user_session AS bigint) AS s FROM raw)),
bronze AS (
  SELECT * EXCLUDE (drop_no, s), TIMESTAMP '2024-02-01 00:00:00' + to_hours(drop_no) AS ingest_ts,
         'drop-' || drop_no AS source_file, {EVENT_TS} AS event_ts, cast({EVENT_TS} AS date) AS event_date
  FROM native),
cleaned AS (SELECT {", ".join(_clean(c) for c in NATIVE_TEXT)}, ingest_ts, source_file, event_ts, event_date
            FROM bronze),
typed AS (
  SELECT event_id AS native_id, event_time, event_type, {_whole("product_id")}, category_code, brand,
         try_cast(price AS double) AS price, {_whole("user_id")}, user_session, {_whole("category_id")},
         try_cast(nullif(regexp_extract(quantity, '^([0-9]+)[.]', 1), '') AS integer) AS quantity,
         try_cast(amount AS double) AS amount, ingest_ts, source_file, event_ts, event_date
  FROM cleaned),
keyed AS (SELECT *, coalesce(native_id, {EVENT_ID}) AS event_id FROM typed)
"""

NATIVE_SILVER = NATIVE_BRONZE + """,
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY event_id
    ORDER BY ingest_ts DESC NULLS LAST, source_file NULLS FIRST, event_time NULLS FIRST,
             event_type NULLS FIRST, product_id NULLS FIRST, category_code NULLS FIRST,
             brand NULLS FIRST, price NULLS FIRST, user_id NULLS FIRST, user_session NULLS FIRST) AS rn
  FROM keyed),
ev AS (SELECT * EXCLUDE (rn, native_id) FROM ranked WHERE rn = 1)
"""

PURCHASE = (
    "regexp_matches(lower(trim(coalesce(event_type, ''))), 'purchase|transaction|order|buy')"
)


def _revenue(quantity: str = "1.0") -> str:
    return f"CASE WHEN {PURCHASE} THEN coalesce(price, 0.0) * {quantity} END"


def _band(price: str) -> str:
    return f"""CASE WHEN {price} IS NULL THEN 'unknown' WHEN {price} < 10 THEN 'under_10'
      WHEN {price} < 50 THEN '10_to_50' WHEN {price} < 100 THEN '50_to_100'
      ELSE '100_plus' END"""


def _sessions(gap: int) -> str:
    """Appends the CTE ``sess``: events of ``ev`` with their session id."""
    order = "PARTITION BY session_key ORDER BY event_ts NULLS FIRST, md5(event_id), event_id"
    return f""",
with_key AS (
  SELECT *, coalesce(cast(user_id AS varchar), event_id) AS session_key FROM ev),
with_prev AS (SELECT *, lag(event_ts) OVER ({order}) AS prev_ts FROM with_key),
flagged AS (
  SELECT *, CASE WHEN prev_ts IS NULL OR event_ts IS NULL
      OR epoch_us(event_ts) // 1000000 - epoch_us(prev_ts) // 1000000 > {gap}
    THEN 1 ELSE 0 END AS starts
  FROM with_prev),
counted AS (
  SELECT *, sum(starts) OVER ({order} ROWS UNBOUNDED PRECEDING) AS session_no FROM flagged),
sess AS (
  SELECT *, sha256(concat_ws('||', session_key, cast(session_no AS varchar))) AS session_id
  FROM counted)
"""


FACTS = f"""SELECT event_id, event_ts, event_type, user_id AS customer_id, product_id, session_id,
  {_revenue()} AS revenue, event_date FROM sess"""

SUMMARY = f"""SELECT session_id, user_id AS customer_id, min(event_ts) AS start_ts,
  max(event_ts) AS end_ts, count(*) AS event_count, bool_or({PURCHASE}) AS purchased_flag
  FROM sess GROUP BY session_id, user_id"""

CUSTOMERS = """SELECT user_id AS customer_id, min(event_ts) AS first_seen_ts,
  max(event_ts) AS last_seen_ts, count(*) AS total_events
  FROM ev WHERE user_id IS NOT NULL GROUP BY user_id"""

PRODUCTS = f"""SELECT product_id, category, brand, round(price, 6) AS price,
    {_band("price")} AS price_band
  FROM (SELECT product_id, max(category_code) AS category, max(brand) AS brand,
               CAST(sum(CAST(price AS DECIMAL(28, 12))) AS double) / nullif(count(price), 0) AS price
        FROM ev WHERE product_id IS NOT NULL GROUP BY product_id)"""


def _check(name: str, layer: str, failed: str, total: str) -> str:
    return f"""SELECT '{name}' AS check_name, '{layer}' AS layer,
      cast({failed} AS bigint) AS failed_rows, cast({total} AS bigint) AS total_rows,
      {failed} = 0 AS passed"""


DQ_ID_NULL = _check("event_id_not_null", "silver", "count_if(event_id IS NULL)", "count(*)") + " FROM ev"
DQ_TS_NULL = _check("event_ts_not_null", "silver", "count_if(event_ts IS NULL)", "count(*)") + " FROM ev"
_KNOWN_TYPE = "coalesce(event_type IN ('click', 'error', 'purchase', 'signup', 'view'), false)"
DQ_TYPE = (
    _check("event_type_valid", "silver", f"count_if(NOT {_KNOWN_TYPE})", "count(*)") + " FROM ev"
)


def _unique(layer: str, source: str) -> str:
    counts = "(count(event_id) - count(DISTINCT event_id))"
    return _check("event_id_unique", layer, counts, "count(event_id)") + f" FROM {source}"


_N = {
    "bronze": "(SELECT count(*) FROM bronze)",
    "silver": "(SELECT count(*) FROM ev)",
    "with_user": "(SELECT count(user_id) FROM ev)",
    "fact": "(SELECT count(*) FROM sess)",
    "customers": f"(SELECT sum(total_events) FROM ({CUSTOMERS}))",
    "sessions": f"(SELECT sum(event_count) FROM ({SUMMARY}))",
}
DQ_COUNTS = "\nUNION ALL ".join(
    [
        _check(
            "silver_at_most_bronze",
            "silver",
            f"greatest({_N['silver']} - {_N['bronze']}, 0)",
            _N["bronze"],
        ),
        _check("fact_equals_silver", "gold", f"abs({_N['fact']} - {_N['silver']})", _N["silver"]),
        _check(
            "customer_events_equal_silver",
            "gold",
            f"abs({_N['customers']} - {_N['with_user']})",
            _N["with_user"],
        ),
        _check(
            "session_events_equal_fact",
            "gold",
            f"abs({_N['sessions']} - {_N['fact']})",
            _N["fact"],
        ),
    ]
)


def _foreign(facts: str, dim: str) -> str:
    missing = f"count_if(product_id NOT IN (SELECT product_id FROM {dim} WHERE product_id IS NOT NULL))"
    return _check("product_id_in_dim", "gold", missing, "count(*)") + (
        f" FROM {facts} WHERE product_id IS NOT NULL"
    )


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _profile() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, 'string' AS data_type, count({c}) AS non_null,"
        " count(*) AS total_rows FROM raw"
        for c in TEXT
    )


def all_sql() -> dict[str, str]:
    raw_list = ", ".join(TEXT)
    cleaned = ", ".join(_clean(c) for c in TEXT)
    dirty = SILVER + _sessions(1800)
    session_rows = "SELECT event_id, user_id, event_ts, session_id FROM sess"
    per_date = "SELECT event_date, count(*) AS row_count FROM bronze GROUP BY event_date"
    return {
        "bronze_events": _with(BRONZE, f"SELECT {raw_list}, event_ts, event_date, TIMESTAMP '2024-02-01 05:00:00' AS ingest_ts,"
            " replace(source_file, '-', '=') AS source_file FROM bronze"),
        "event_ts_parse": _with(
            BRONZE, "SELECT user_session, event_time, event_ts, event_date FROM bronze"
        ),
        "clean_strings": _with(RAW, f"SELECT {cleaned}, drop_no FROM raw"),
        "standardize_types": _with(
            TYPED,
            "SELECT user_session, event_ts, event_date, price, user_id, product_id FROM typed",
        ),
        "event_id_hash": _with(KEYED_SHOP, "SELECT user_id, event_ts, event_id FROM ev"),
        "dedupe_latest": _with(
            SILVER, "SELECT event_id, ingest_ts, source_file, user_session, price FROM ev"
        ),
        "dedupe_any": _with(TYPED, "SELECT DISTINCT event_id FROM keyed"),
        "native_silver_events": _with(
            NATIVE_SILVER,
            "SELECT event_id, event_ts, event_date, event_type, user_id, product_id, category_id,"
            " category_code, brand, price, ingest_ts, source_file, event_time, user_session, quantity,"
            " amount FROM ev",
        ),
        "native_dim_product": _with(
            NATIVE_SILVER,
            PRODUCTS.replace("max(category_code)", "coalesce(max(category_code), max(cast(category_id AS varchar)))"),
        ),
        "native_event_revenue": _with(
            NATIVE_SILVER,
            f"SELECT event_id, quantity, round({_revenue('coalesce(quantity, 1.0)')}, 6) AS revenue FROM ev",
        ),
        "native_dq_event_id_null": _with(
            NATIVE_BRONZE,
            _check("event_id_not_null", "bronze", "count_if(event_id IS NULL)", "count(*)") + " FROM cleaned",
        ),
        "native_dq_event_id_dup": _with(NATIVE_BRONZE, _unique("bronze", "keyed")),
        "silver_events": _with(
            SILVER,
            "SELECT event_id, event_ts, event_date, event_type, user_id, product_id, category_code,"
            " brand, price, ingest_ts, source_file, event_time, user_session FROM ev",
        ),
        "purchase_events": _with(
            SILVER,
            f"SELECT event_id, event_type, user_id, product_id, price FROM ev WHERE {PURCHASE}",
        ),
        "event_revenue": _with(
            SILVER, f"SELECT event_id, event_type, {_revenue()} AS revenue FROM ev"
        ),
        "order_revenue": _with(
            ORDERS,
            f"SELECT user_id, round(sum({_revenue('coalesce(quantity, 1.0)')}), 2) AS revenue"
            " FROM ev GROUP BY user_id",
        ),
        "price_bands": _with(
            KEYED_SHOP, f"SELECT event_id, price, {_band('price')} AS price_band FROM ev"
        ),
        "dim_customer": _with(SILVER, CUSTOMERS),
        "dim_product": _with(SILVER, PRODUCTS),
        "order_dim_customer": _with(ORDERS, CUSTOMERS),
        "order_dim_product": _with(ORDERS, PRODUCTS),
        "sessionize": _with(KEYED_SHOP + _sessions(1800), session_rows),
        "sessionize_gap60": _with(KEYED_SHOP + _sessions(3600), session_rows),
        "sessionize_gap0": _with(KEYED_SHOP + _sessions(1), session_rows),
        "fact_events": _with(KEYED_SHOP + _sessions(1800), FACTS),
        "fact_events_dirty": _with(dirty, FACTS),
        "session_summary": _with(KEYED_SHOP + _sessions(1800), SUMMARY),
        "session_summary_by_id": _with(KEYED_SHOP + _sessions(1800), SUMMARY),
        "session_summary_dirty": _with(dirty, SUMMARY),
        "order_session_summary": _with(
            ORDERS.replace("ev AS (", "lines AS (", 1)
            + f", ev AS (SELECT *, {EVENT_ID} AS event_id FROM lines)"
            + _sessions(1800),
            SUMMARY,
        ),
        "events_per_date": _with(BRONZE, per_date),
        "first_dates": _with(BRONZE, f"{per_date} ORDER BY event_date NULLS FIRST LIMIT 20"),
        "layer_counts": _with(
            SILVER,
            f"""SELECT 'bronze' AS layer, count(*) AS row_count FROM bronze
            UNION ALL SELECT 'silver', count(*) FROM ev
            UNION ALL SELECT 'dim_customer', count(*) FROM ({CUSTOMERS})
            UNION ALL SELECT 'dim_product', count(*) FROM ({PRODUCTS})""",
        ),
        "column_profile": _with(RAW, _profile()),
        "events_after_watermark": _with(
            KEYED_SHOP,
            "SELECT event_id, event_ts FROM ev WHERE event_ts > TIMESTAMP '2024-01-20 12:00:00'",
        ),
        "dq_event_id_null": _with(SILVER, DQ_ID_NULL),
        "dq_event_ts_null": _with(SILVER, DQ_TS_NULL),
        "dq_event_id_dup": _with(TYPED, _unique("bronze", "keyed")),
        "dq_event_type": _with(SILVER, DQ_TYPE),
        "dq_row_counts": _with(dirty, DQ_COUNTS),
        "dq_fk_product": _with(SHOP + "," + ORDERS, _foreign("ev", "shop")),
        "dq_results": _with(
            dirty,
            "\nUNION ALL ".join(
                [_unique("bronze", "keyed"), DQ_ID_NULL, DQ_TS_NULL, DQ_TYPE, _unique("silver", "ev"), DQ_COUNTS, _foreign("sess", "ev")]
            ),
        ),
        "built_fact_events": _with(dirty, FACTS),
        "grown_fact_events": _with(dirty, FACTS),
        "grown_old_file_events": _with(dirty, FACTS),
        "grown_session_summary": _with(dirty, SUMMARY),
        "grown_dim_customer": _with(SILVER, CUSTOMERS),
        "grown_dim_product": _with(SILVER, PRODUCTS),
        "native_grown_fact_events": _with(
            NATIVE_SILVER + _sessions(1800),
            FACTS.replace(_revenue(), _revenue("coalesce(quantity, 1.0)")),
        ),
        "native_grown_session_summary": _with(NATIVE_SILVER + _sessions(1800), SUMMARY),
        "grown_widened_events": _with(
            SILVER,
            "SELECT event_id, event_ts, event_date, event_type, user_id, product_id, category_code, brand, price,"
            " CASE WHEN ingest_ts = TIMESTAMP '2024-02-01 02:00:00' THEN cast(cast(user_session AS bigint) % 4 AS integer) END"
            " AS quantity FROM ev",
        ),
        "exported_dim_customer": _with(SILVER, CUSTOMERS),
        "exported_dim_product": _with(SILVER, PRODUCTS),
        "exported_fact_events": _with(dirty, FACTS),
        "exported_session_summary": _with(dirty, SUMMARY),
    }
