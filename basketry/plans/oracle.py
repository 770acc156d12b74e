"""The registered queries again, as SQL for DuckDB over tables registered by name."""

from __future__ import annotations

from basketry.functions.coercion import EMBEDDED_NUMBER, NULL_TOKENS
from basketry.functions.text import ENGLISH_STOP_WORDS, TERM_PATTERN
from basketry.plans.adapters import DATASET_VIEWS, DUCKDB_K, REVIEW_ORDER, TABLES, view_sql
from basketry.plans.registry import PAYLOAD_SQL, STORE_PRODUCTS, STORE_USERS, STORE_VIEWS
from basketry.specs import DATASETS

PLAIN_NUMBER = r"^[-+]?((\d+\.?\d*|\.\d+)([eE][-+]?\d+)?|(?i:inf|infinity))$"


def stop_words() -> list[str]:
    return ENGLISH_STOP_WORDS


def with_views(names, body: str, *ctes: str) -> str:
    parts = [view_sql(*names), *ctes]
    return "WITH " + ",\n".join(p for p in parts if p) + "\n" + body


def order(columns) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in columns)


def first_of(view: str, key: str, columns) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order(columns)}) AS rn "
        f"FROM {view}) WHERE rn = 1"
    )


def codes(view: str, column: str) -> str:
    """(value, code) subquery of a column's label codes."""
    return (
        f"(SELECT {column} AS v, CAST(row_number() OVER (ORDER BY {column}) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT {column} FROM {view} WHERE {column} IS NOT NULL))"
    )


def coded(view: str, column: str, alias: str) -> tuple[str, str]:
    """(select item, join) that add a label code."""
    return f"coalesce({alias}.code, -1) AS {alias}", f"LEFT JOIN {codes(view, column)} {alias} ON t.{column} = {alias}.v"


def count_of(condition: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0) AS BIGINT)"


EXTRACT = f"TRY_CAST(nullif(regexp_extract(avg_rating, '{EMBEDDED_NUMBER}', 1), '') AS DOUBLE)"
NUMBER = f"CASE WHEN regexp_matches(trim(avg_rating), '{PLAIN_NUMBER}') THEN TRY_CAST(trim(avg_rating) AS DOUBLE) END"

VIEW_COLUMNS = {
    "users": "user_id age gender city membership customer_segment email signup_date",
    "products": "product_id product_name category brand price avg_rating description",
    "reviews": "review_id user_id product_id rating sentiment review_date l_shipdate l_suppkey l_extendedprice",
    "sessions": "session_id user_id session_start session_duration_sec",
    "clickstream": "event_id session_id user_id product_id event_timestamp event_type dwell_time_sec",
}
REVIEWS_READY = (
    f"first_reviews AS ({first_of('v_reviews', 'review_id', REVIEW_ORDER)})",
    "kept_reviews AS (SELECT * REPLACE (coalesce(rating, 3.0) AS rating) FROM first_reviews "
    "WHERE user_id IS NOT NULL AND product_id IS NOT NULL)",
)
USER_STATS = (
    "activity AS (SELECT user_id, count(*) AS n FROM v_sessions GROUP BY 1)",
    "user_means AS (SELECT user_id, avg(rating) AS m FROM kept_reviews GROUP BY 1)",
)
PRODUCT_STATS = (
    "product_stats AS (SELECT p.*, coalesce(s.m, 0.0) AS item_avg_rating, CAST(coalesce(s.n, 0) AS BIGINT) AS item_interaction_count "
    "FROM v_products p LEFT JOIN (SELECT product_id, avg(rating) AS m, count(*) AS n FROM kept_reviews GROUP BY 1) s USING (product_id))"
)
POPULAR = "ORDER BY item_interaction_count DESC, item_avg_rating DESC, product_id"


def checks(name: str) -> list[tuple[str, str, str, bool]]:
    """(check, column, count expression, decides) of a dataset's report, by hand."""
    have = VIEW_COLUMNS[name].split()
    out = [("nulls", c, count_of(f"{c} IS NULL"), False) for c in have]
    for c in DATASETS[name].required:
        out.append(("required", c, count_of(f"{c} IS NULL" if c in have else "true"), True))
    if name == "users":
        out += [
            ("malformed", "age", count_of("false"), True),
            ("range", "age", count_of("age < 0 OR age > 120"), True),
            ("email", "email", count_of("email IS NULL OR NOT contains(email, '@')"), True),
        ]
    if name == "products":
        e = f"coalesce({NUMBER}, {EXTRACT})"
        out += [
            ("malformed", "price", count_of("false"), True),
            ("range", "price", count_of("price < 0"), True),
            ("malformed", "avg_rating", count_of(f"avg_rating IS NOT NULL AND {e} IS NULL"), True),
            ("range", "avg_rating", count_of(f"{e} < 0 OR {e} > 5"), True),
        ]
    if name == "reviews":
        out += [
            ("malformed", "rating", count_of("false"), True),
            ("range", "rating", count_of("rating < 1 OR rating > 5"), True),
        ]
    if name == "sessions":
        out += [
            ("malformed", "session_duration_sec", count_of("false"), True),
            ("range", "session_duration_sec", count_of("session_duration_sec < 0"), True),
        ]
    return out


def duplicates(view: str, columns: str = "*") -> str:
    """Rows less distinct rows."""
    return f"((SELECT count(*) FROM {view}) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {view})))"


def report_rows(name: str) -> str:
    v = DATASET_VIEWS[name]
    rows = [
        f"SELECT '{name}' AS dataset, 'rows' AS \"check\", '*' AS \"column\", count(*) AS n_bad, true AS passed FROM {v}",
        f"SELECT '{name}', 'duplicates', '*', n, n = 0 FROM (SELECT {duplicates(v)} AS n)",
    ]
    rows += [
        f"SELECT '{name}', '{check}', '{c}', {n}, {f'{n} = 0' if decides else 'true'} FROM {v}"
        for check, c, n, decides in checks(name)
    ]
    return "\nUNION ALL ".join(rows)


REPORT = "\nUNION ALL ".join(report_rows(n) for n in DATASET_VIEWS)
ALL_VIEWS = list(DATASET_VIEWS.values())


def missing(name: str) -> list[str]:
    return [c for c in DATASETS[name].columns if c not in VIEW_COLUMNS[name].split()] if name == "clickstream" else []


# --- text --------------------------------------------------------------------------


def text_ctes() -> tuple[str, ...]:
    """tok, tf, vocab, weights over v_items."""
    words = ", ".join(f"'{w}'" for w in stop_words())
    return (
        f"tok AS (SELECT product_id, unnest(regexp_extract_all(lower(concat(product_name, ' ', category, ' ', description)), "
        f"'{TERM_PATTERN}')) AS term FROM v_items)",
        f"tf AS (SELECT product_id, term, count(*) AS tf FROM tok WHERE term NOT IN ({words}) GROUP BY ALL)",
        "vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS corpus_freq, count(*) AS doc_freq FROM tf GROUP BY term "
        "ORDER BY corpus_freq DESC, term LIMIT 1000)",
        "idf AS (SELECT *, ln((1 + (SELECT count(*) FROM v_items)) / (1 + doc_freq)) + 1 AS idf FROM vocab)",
        "raw_weights AS (SELECT product_id, term, tf * idf AS x FROM tf JOIN idf USING (term))",
        "weights AS MATERIALIZED (SELECT product_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY product_id)) AS w FROM raw_weights)",
    )


def content_ctes(interactions: str, k: int) -> tuple[str, ...]:
    """content_lists (user_id, rank, product_id, score): brute force over all users and items."""
    return (
        f"hist AS (SELECT user_id, product_id, count(*) AS n FROM {interactions} WHERE user_id IN (SELECT user_id FROM v_users) GROUP BY ALL)",
        "profiles AS MATERIALIZED (SELECT user_id, term, sum(n * w) AS w FROM hist JOIN weights USING (product_id) GROUP BY ALL)",
        "dots AS (SELECT p.user_id, w.product_id, round(sum(p.w * w.w), 9) AS score FROM profiles p JOIN weights w USING (term) GROUP BY ALL)",
        "warm AS (SELECT DISTINCT user_id FROM hist)",
        "candidates AS (SELECT user_id, product_id, coalesce(score, 0.0) AS score FROM warm CROSS JOIN (SELECT product_id FROM v_items) "
        "LEFT JOIN dots USING (user_id, product_id) ANTI JOIN hist USING (user_id, product_id))",
        "own AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INTEGER) AS rank, "
        f"product_id, score FROM candidates QUALIFY rank <= {k})",
        "item_stats AS (SELECT i.product_id, coalesce(s.n, 0) AS item_interaction_count, coalesce(s.m, 0.0) AS item_avg_rating FROM v_items i "
        "LEFT JOIN (SELECT product_id, count(*) AS n, avg(rating) AS m FROM v_interactions GROUP BY 1) s USING (product_id))",
        f"popular AS (SELECT CAST(row_number() OVER ({POPULAR}) AS INTEGER) AS rank, product_id FROM item_stats QUALIFY rank <= {k})",
        # Lists that stay short are filled with popular items not yet listed.
        "own_size AS (SELECT u.user_id, count(o.rank) AS n FROM v_users u LEFT JOIN own o USING (user_id) GROUP BY 1)",
        "filling AS (SELECT s.user_id, CAST(s.n + row_number() OVER (PARTITION BY s.user_id ORDER BY p.rank) AS INTEGER) AS rank, p.product_id, 0.0 AS score "
        f"FROM own_size s CROSS JOIN popular p ANTI JOIN own o ON o.user_id = s.user_id AND o.product_id = p.product_id WHERE s.n < {k})",
        f"content_lists AS (SELECT * FROM own UNION ALL SELECT * FROM filling WHERE rank <= {k})",
        "popular_lists AS (SELECT user_id, rank, product_id FROM v_users CROSS JOIN popular)",
    )


def split_ctes(view: str) -> tuple[str, ...]:
    """flagged: the view with is_test on each eligible user's last row."""
    return (
        f"flagged AS (SELECT *, user_id IS NOT NULL AND count(*) OVER (PARTITION BY user_id) >= 2 AND row_number() OVER "
        f"(PARTITION BY user_id ORDER BY review_date DESC NULLS LAST, review_id DESC NULLS LAST) = 1 AS is_test FROM {view})",
        "train AS (SELECT * FROM flagged WHERE NOT is_test)",
        "test AS (SELECT * FROM flagged WHERE is_test)",
    )


def metrics(lists: str, k: int) -> str:
    """One row (n_users, precision, recall, ndcg) of ``lists`` against ``test``."""
    return f"""(
        SELECT count(*) AS n_users, coalesce(round(avg(hits / n_listed), 6), 0.0) AS precision,
               coalesce(round(avg(hits / n_true), 6), 0.0) AS recall,
               coalesce(round(avg(dcg / (SELECT sum(1 / log2(r + 1)) FROM range(1, {k} + 1) t(r) WHERE r <= least(n_true, {k}))), 6), 0.0) AS ndcg
        FROM (SELECT l.user_id, count(*) AS n_listed, count(t.product_id) AS hits,
                     coalesce(sum(CASE WHEN t.product_id IS NOT NULL THEN 1 / log2(l.rank + 1) END), 0) AS dcg
              FROM {lists} l LEFT JOIN (SELECT DISTINCT user_id, product_id FROM test) t
                ON t.user_id = l.user_id AND t.product_id = l.product_id
              WHERE l.rank <= {k} GROUP BY l.user_id)
        JOIN (SELECT user_id, count(DISTINCT product_id) AS n_true FROM test GROUP BY 1) USING (user_id))"""


# --- feature store ----------------------------------------------------------------------


def unpivoted(view, source: str, version: str, at: str, replace: dict[str, str] | None = None, where: str = "true") -> str:
    rows = []
    for name, _ in view.features:
        expr = (replace or {}).get(name, name)
        value = "''" if name == "tenure" else f"coalesce(CAST({expr} AS VARCHAR), 'None')"
        rows.append(
            f"SELECT '{view.name}' AS feature_view, CAST({view.join_key} AS VARCHAR) AS entity_id, '{name}' AS attribute_name, "
            f"{value} AS attribute_value, '{version}' AS feature_version, '{at}' AS materialized_at FROM {source} WHERE {where}"
        )
    return "\nUNION ALL ".join(rows)


STORE_CTES = (
    "store_users AS (SELECT u.*, coalesce(a.n, 0) AS user_activity_frequency FROM v_users u "
    "LEFT JOIN (SELECT user_id, count(*) AS n FROM v_sessions GROUP BY 1) a USING (user_id))",
    "store_products AS (SELECT p.*, coalesce(a.n, 0) AS item_interaction_count FROM v_products p "
    "LEFT JOIN (SELECT product_id, count(*) AS n FROM v_reviews GROUP BY 1) a USING (product_id))",
)
T1, T2, T3 = "2024-01-01T00:00:00", "2024-01-02T00:00:00", "2024-01-03T00:00:00"
STORE = (
    unpivoted(STORE_USERS, "store_users", "v1", T1, where="gender IS NULL")
    + "\nUNION ALL " + unpivoted(STORE_USERS, "store_users", "v1", T3, {"gender": "lower(gender)"}, "gender IS NOT NULL")
    + "\nUNION ALL " + unpivoted(STORE_USERS, "store_users", "v2", T2)
    + "\nUNION ALL " + unpivoted(STORE_PRODUCTS, "store_products", "v1", T1)
)
STORE_INPUTS = ["v_users", "v_products", "v_sessions", "v_reviews"]


def build() -> dict[str, str]:
    """One SQL text per registered query."""
    text = text_ctes()
    q: dict[str, str] = {}
    rated = "CASE WHEN {0} THEN NULL ELSE {1} END"
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)

    q["scan_csv_roundtrip"] = with_views(
        ["v_products"],
        "SELECT product_id, product_name, category, brand, price, "
        f"CASE WHEN avg_rating NOT IN ({tokens}) THEN avg_rating END AS avg_rating FROM v_products",
    )
    q["scan_free_text"] = (
        "SELECT doc_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS n_chars, source FROM "
        "(SELECT *, CASE WHEN text <> '' THEN replace(text, chr(13) || chr(10), chr(10)) END AS t FROM documents)"
    )
    q["land_partitioned"] = (
        "SELECT strftime(ts, '%Y-%m-%d') AS ingest_date, count(*) AS n_rows, round(sum(value), 6) AS total_value FROM events GROUP BY 1"
    )
    q["profile_landings"] = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_null, {bounds.format('min')} AS low, "
        f"{bounds.format('max')} AS high, true AS distinct_close, CAST(1 AS INTEGER) AS dates_read FROM events"
        for c, bounds in (
            ("event_id", "round(CAST({0}(event_id) AS DOUBLE), 6)"), ("user_id", "round(CAST({0}(user_id) AS DOUBLE), 6)"),
            ("event_type", "CAST(NULL AS DOUBLE)"), ("value", "round({0}(value), 6)"),
        )
    )
    q["latest_partition"] = (
        "SELECT event_id, user_id, event_type, value FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"
    )
    payloads = PAYLOAD_SQL.replace("{k_expr}", DUCKDB_K).replace("{events}", "events").replace("{{", "{").replace("}}", "}")
    q["json_payload_items"] = (
        "SELECT event_type, count(*) AS n_payloads, CAST(sum(CASE WHEN json_type(payload) = 'ARRAY' THEN json_array_length(payload) "
        "WHEN json_type(payload, '$.products') = 'ARRAY' THEN json_array_length(payload, '$.products') ELSE 0 END) AS BIGINT) AS n_items "
        f"FROM ({payloads}) GROUP BY 1"
    )
    items = (
        "CASE WHEN json_type({p}) = 'ARRAY' THEN json_array_length({p}) "
        "WHEN json_type({p}, '$.products') = 'ARRAY' THEN json_array_length({p}, '$.products') ELSE 0 END"
    )
    q["payload_landing"] = " UNION ALL ".join(
        f"SELECT '{day}' AS ingest_date, count(*) AS n_payloads, CAST(sum({items.format(p='payload')}) AS BIGINT) AS n_items "
        f"FROM ({payloads}) WHERE event_type = '{kind}'"
        for day, kind in (("2024-01-01", "view"), ("2024-01-02", "click"))
    )
    numbered = payloads.replace("SELECT event_type, props,", "SELECT event_id, event_type, props,").replace("SELECT event_type,", "SELECT event_id, event_type,")
    cut = "CASE WHEN event_id % 10 = 0 THEN left(payload, length(payload) - 1) ELSE payload END"
    q["payload_lanes"] = (
        "SELECT event_type, count(*) FILTER (json_valid(p)) AS n_parsed, count(*) FILTER (NOT json_valid(p)) AS n_unparsed, "
        f"CAST(sum(CASE WHEN json_valid(p) THEN {items.format(p='p')} ELSE 0 END) AS BIGINT) AS n_items, "
        "CAST(sum(length(p)) FILTER (NOT json_valid(p)) AS BIGINT) AS unparsed_chars "
        f"FROM (SELECT event_type, {cut} AS p FROM ({numbered})) GROUP BY 1"
    )
    q["published_sets"] = " UNION ALL ".join(
        f"SELECT CAST({step} AS INTEGER) AS step, CAST({record} AS INTEGER) AS record, '{t}' AS table_name, count(*) AS n_rows FROM {t} WHERE {where}"
        for step, record, t, where in (
            (0, 1, "orders", "true"), (0, 1, "customer", "true"), (1, 1, "orders", "true"), (1, 1, "customer", "true"),
            (2, 2, "orders", "true"), (2, 2, "customer", "c_custkey % 3 = 0"),
        )
    )
    q["ingest_metrics"] = " UNION ALL ".join(
        [f"SELECT '{t}' AS dataset, true AS ok, count(*) AS n_rows FROM {t}" for t in TABLES]
        + ["SELECT 'returns', false, CAST(0 AS BIGINT)"]
    )
    q["warehouse_counts"] = with_views(
        ["v_reviews"],
        "SELECT 'dim_users' AS table_name, count(DISTINCT c_custkey) AS n_rows FROM customer UNION ALL "
        "SELECT 'dim_products', count(DISTINCT p_partkey) FROM part UNION ALL "
        "SELECT 'fact_interactions', count(*) FROM kept_reviews",
        *REVIEWS_READY,
    )

    q["schema_check"] = with_views(
        ALL_VIEWS,
        " UNION ALL ".join(
            f"SELECT '{n}' AS dataset, CAST({len(missing(n))} AS INTEGER) AS n_missing, '{','.join(missing(n))}' AS missing, "
            f"{str(not missing(n)).lower()} AS passed, count(*) AS n_rows FROM {v}"
            for n, v in DATASET_VIEWS.items()
        ),
    )
    q["numeric_coerce"] = with_views(
        ["v_products"],
        f"SELECT product_id, {NUMBER} AS number, coalesce({NUMBER}, {EXTRACT}) AS embedded, "
        f"avg_rating IS NOT NULL AND coalesce({NUMBER}, {EXTRACT}) IS NULL AS malformed FROM v_products",
    )
    q["extract_rating"] = with_views(
        ["v_products"], f"SELECT product_id, coalesce({EXTRACT}, 0.0) AS avg_rating FROM v_products"
    )

    def report_part(check: str, names, **source) -> str:
        return " UNION ALL ".join(
            f"SELECT '{n}' AS dataset, '{c}' AS \"column\", {expr} AS n_bad FROM {source.get(n, DATASET_VIEWS[n])}"
            for n in names for found, c, expr, _ in checks(n) if found == check
        )

    q["range_violations"] = with_views(
        ["v_dirty", "v_users", "v_products", "v_sessions"],
        report_part("range", ["reviews", "users", "products", "sessions"], reviews="v_dirty"),
    )
    q["email_format"] = with_views(
        ["v_users"], "SELECT user_id, email IS NULL OR NOT contains(email, '@') AS invalid FROM v_users"
    )
    q["null_profile"] = with_views(
        ALL_VIEWS,
        " UNION ALL ".join(
            f"SELECT '{n}' AS dataset, '{c}' AS \"column\", count(*) AS total_rows, {count_of(f'{c} IS NULL')} AS n_null FROM {v}"
            for n, v in DATASET_VIEWS.items() for c in VIEW_COLUMNS[n].split()
        ),
    )
    q["required_nulls"] = with_views(ALL_VIEWS, report_part("required", DATASET_VIEWS))
    q["duplicate_rows"] = (
        f"SELECT 'documents' AS dataset, count(*) AS total_rows, {duplicates('documents', 'text')} AS duplicate_rows FROM documents "
        f"UNION ALL SELECT 'lineitem', count(*), {duplicates('lineitem', 'l_orderkey, l_linenumber')} FROM lineitem"
    )
    q["quality_report"] = with_views(ALL_VIEWS, REPORT)
    gate = " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, {str(not missing(n)).lower()} AS schema_ok, (SELECT bool_and(passed) FROM report WHERE dataset = '{n}') "
        f"AS quality_ok, (SELECT count(*) FROM {v}) AS n FROM (SELECT 1)"
        for n, v in DATASET_VIEWS.items()
    )
    q["validation_gate"] = with_views(
        ALL_VIEWS,
        "SELECT dataset, schema_ok, quality_ok, schema_ok AND quality_ok AS promoted, "
        f"CASE WHEN schema_ok AND quality_ok THEN n ELSE 0 END AS n_promoted FROM ({gate})",
        f"report AS ({REPORT})",
    )

    q["dedup_keep_first"] = with_views(
        ["v_reviews"],
        "SELECT review_id, user_id, product_id, rating, sentiment, strftime(review_date, '%Y-%m-%d') AS review_date, "
        "strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_suppkey, l_extendedprice FROM first_reviews",
        REVIEWS_READY[0],
    )
    q["median_impute"] = with_views(
        ["v_users", "v_products"],
        "SELECT 'users' AS dataset, user_id AS id, round(coalesce(age, (SELECT median(age) FROM v_users)), 6) AS value FROM v_users UNION ALL "
        "SELECT 'products', product_id, round(coalesce(price, (SELECT median(price) FROM v_products)), 6) FROM v_products",
    )
    q["minmax_scale"] = with_views(
        ["v_sessions"],
        "SELECT session_id, CASE WHEN hi > lo THEN round((x - lo) / (hi - lo), 6) ELSE 0.0 END AS scaled FROM "
        "(SELECT session_id, session_duration_sec AS x, min(session_duration_sec) OVER () AS lo, max(session_duration_sec) OVER () AS hi "
        "FROM v_sessions)",
    )
    q["log_normalize"] = with_views(
        ["v_clickstream"],
        "SELECT event_id, round(ln(1 + CASE WHEN dwell_time_sec < 0 THEN 0.0 ELSE dwell_time_sec END), 6) AS dwell_log FROM v_clickstream",
    )
    items, joins = zip(*(coded("v_users", c, a) for c, a in (
        ("gender", "gender_code"), ("membership", "membership_code"), ("customer_segment", "segment_code"))))
    q["label_encode"] = with_views(["v_users"], f"SELECT t.user_id, {', '.join(items)} FROM v_users t {' '.join(joins)}")

    items, joins = zip(*(coded("filled", c, a) for c, a in (
        ("gender", "gender_encoded"), ("membership", "membership_encoded"), ("customer_segment", "segment_encoded"))))
    q["prepare_users_dates"] = with_views(
        ["v_users"],
        f"SELECT t.user_id, round(t.age, 6) AS age, t.gender, {', '.join(items)}, strftime(signed, '%Y-%m-%d') AS signup_date, "
        "CAST(coalesce(year(signed), 0) AS BIGINT) AS signup_year, CAST(coalesce(month(signed), 0) AS BIGINT) AS signup_month, "
        f"CASE WHEN hi > lo THEN round((t.age - lo) / (hi - lo), 6) ELSE 0.0 END AS age_normalized FROM filled t {' '.join(joins)}",
        "filled AS (SELECT *, min(age) OVER () AS lo, max(age) OVER () AS hi FROM (SELECT * REPLACE "
        "(coalesce(age, (SELECT median(age) FROM v_users)) AS age, coalesce(gender, 'Unknown') AS gender), "
        "TRY_CAST(signup_date AS DATE) AS signed FROM v_users))",
    )
    items, joins = zip(*(coded("v_products", c, a) for c, a in (("category", "category_encoded"), ("brand", "brand_encoded"))))
    q["prepare_products"] = with_views(
        ["v_products"],
        "SELECT t.product_id, t.category, t.brand, round(t.price2, 6) AS price, coalesce(t.r, 0.0) AS avg_rating, "
        f"{', '.join(items)}, round(ln(1 + greatest(t.price2, 0.0)), 6) AS price_log_normalized FROM (SELECT *, {EXTRACT} AS r, "
        f"coalesce(price, (SELECT median(price) FROM v_products)) AS price2 FROM v_products) t {' '.join(joins)}",
    )
    item, join = coded("kept_reviews", "sentiment", "sentiment_encoded")
    q["prepare_reviews"] = with_views(
        ["v_reviews"],
        f"SELECT t.review_id, t.user_id, t.product_id, t.rating, {item}, strftime(t.review_date, '%Y-%m-%d') AS review_date "
        f"FROM kept_reviews t {join}",
        *REVIEWS_READY,
    )
    zone = {"users": ("v_users", "user_id", 14), "products": ("v_products", "product_id", 10), "reviews": ("kept_reviews", "review_id", 10),
            "sessions": ("v_sessions", "session_id", 5)}
    q["processed_zone"] = with_views(
        ["v_users", "v_products", "v_reviews", "v_sessions"],
        " UNION ALL ".join(
            f"SELECT '{n}' AS dataset, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys, CAST(sum({key}) AS BIGINT) AS key_sum, "
            f"CAST({columns} AS INTEGER) AS n_columns FROM {source}"
            for n, (source, key, columns) in zone.items()
        ),
        *REVIEWS_READY,
    )
    q["warehouse_users"] = with_views(
        ["v_users", "v_reviews", "v_sessions"],
        "SELECT CAST(u.user_id AS VARCHAR) AS user_id, round(coalesce(u.age, (SELECT median(age) FROM v_users)), 6) AS age, "
        "coalesce(u.gender, 'Unknown') AS gender, u.city, u.membership, CAST(coalesce(year(TRY_CAST(u.signup_date AS DATE)), 0) AS BIGINT) AS signup_year, "
        "coalesce(a.n, 0) AS user_activity_frequency, round(coalesce(m.m, 0.0), 6) AS user_avg_rating "
        "FROM v_users u LEFT JOIN activity a USING (user_id) LEFT JOIN user_means m USING (user_id)",
        *REVIEWS_READY, *USER_STATS,
    )
    q["warehouse_products"] = with_views(
        ["v_products", "v_reviews"],
        "SELECT CAST(product_id AS VARCHAR) AS product_id, product_name, category, brand, "
        "round(coalesce(price, (SELECT median(price) FROM v_products)), 6) AS price, round(item_avg_rating, 6) AS item_avg_rating, "
        "item_interaction_count, description FROM product_stats",
        *REVIEWS_READY, PRODUCT_STATS,
    )
    q["warehouse_interactions"] = with_views(
        ["v_reviews"],
        "SELECT CAST(t.review_id AS VARCHAR) AS review_id, CAST(t.user_id AS VARCHAR) AS user_id, CAST(t.product_id AS VARCHAR) AS product_id, "
        f"t.rating, CAST({item.split(' AS ')[0]} AS BIGINT) AS sentiment_encoded, strftime(t.review_date, '%Y-%m-%d') AS review_date FROM kept_reviews t {join}",
        *REVIEWS_READY,
    )
    # The declared columns, by hand: (column, type, SQL for a value that is present).
    stored = {
        "dim_users": ("v_users", "user_id:string age:double gender:string city:string membership:string signup_year:bigint "
                      "user_activity_frequency:bigint user_avg_rating:double", {}),
        "dim_products": ("v_products", "product_id:string product_name:string category:string brand:string price:double item_avg_rating:double "
                         "item_interaction_count:bigint description:string", {"category": "category"}),
        "fact_interactions": ("kept_reviews", "review_id:string user_id:string product_id:string rating:double sentiment_encoded:bigint "
                              "review_date:string", {"review_date": "review_date"}),
    }
    q["warehouse_column_types"] = with_views(
        ["v_users", "v_products", "v_reviews"],
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS \"column\", '{kind}' AS type, count({have.get(c, '1')}) AS n_values FROM {source}"
            for t, (source, columns, have) in stored.items() for c, kind in (x.split(":") for x in columns.split())
        ),
        *REVIEWS_READY,
    )
    q["gate_without_contracts"] = with_views(
        ["v_users"],
        f"SELECT dataset, schema_ok, dup = 0 AND bad = 0 AS quality_ok, schema_ok AND dup = 0 AND bad = 0 AS promoted, "
        "CASE WHEN schema_ok AND dup = 0 AND bad = 0 THEN n ELSE 0 END AS n_promoted FROM ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS dataset, {ok} AS schema_ok, {duplicates(source, columns)} AS dup, {bad} AS bad, (SELECT count(*) FROM {source}) AS n"
            for n, source, columns, ok, bad in (
                ("nation", "nation", "*", "true", "0"), ("region", "region", "*", "true", "0"),
                ("lines", "lineitem", "l_orderkey, l_returnflag", "true", "0"),
                ("users", "v_users", "*", "false", "(SELECT count(*) FROM v_users WHERE email IS NULL OR NOT contains(email, '@'))"),
            )
        )
        + ")",
    )
    dwell = rated.format("event_id % 5 = 0", "dwell_time_sec")
    q["nan_log_normalize"] = with_views(
        ["v_clickstream"], f"SELECT event_id, round(ln(1 + greatest({dwell}, CASE WHEN {dwell} IS NOT NULL THEN 0.0 END)), 6) AS dwell_log FROM v_clickstream"
    )
    q["nan_label_encode"] = with_views(
        ["v_dirty"],
        "SELECT review_id, coalesce(code, -1) AS rating_code FROM holed LEFT JOIN (SELECT r, CAST(row_number() OVER (ORDER BY r) - 1 AS INTEGER) AS code "
        "FROM (SELECT DISTINCT r FROM holed WHERE r IS NOT NULL)) USING (r)",
        f"holed AS (SELECT review_id, {rated.format('review_id % 4 = 0', 'rating')} AS r FROM v_dirty)",
    )
    q["date_losses"] = with_views(
        ["v_users"],
        "SELECT 'signup_date' AS \"column\", (SELECT CASE WHEN TRY_CAST(signup_date AS DATE) IS NOT NULL THEN 'yyyy-MM-dd' END FROM v_users "
        "WHERE signup_date IS NOT NULL ORDER BY user_id LIMIT 1) AS date_format, count(signup_date) AS n_values, "
        "count(*) FILTER (signup_date IS NOT NULL AND TRY_CAST(signup_date AS DATE) IS NULL) AS n_lost FROM v_users",
    )
    q["stage_difference"] = with_views(
        ["v_users"],
        "SELECT user_id, 'changed' AS kind, concat_ws(',', CASE WHEN age IS NULL THEN 'age' END, CASE WHEN gender IS NULL THEN 'gender' END) "
        "AS changed FROM v_users WHERE age IS NULL OR gender IS NULL",
    )
    q["exploration_summary"] = with_views(
        ["v_reviews", "v_clickstream"],
        "SELECT n AS n_reviews, (SELECT count(*) FROM v_clickstream) AS n_events, u AS n_users, p AS n_items, round(1 - n / (CAST(u AS DOUBLE) * p), 6) AS sparsity "
        "FROM (SELECT count(*) AS n, count(DISTINCT user_id) AS u, count(DISTINCT product_id) AS p FROM v_reviews)",
    )
    q["nan_histogram"] = with_views(
        ["v_reviews"],
        "SELECT CAST(b AS INTEGER) AS bin, round(lo + b * (hi - lo) / 4, 6) AS low, round(lo + (b + 1) * (hi - lo) / 4, 6) AS high, "
        "(SELECT count(*) FROM holed WHERE rating IS NOT NULL AND least(floor((rating - lo) / (hi - lo) * 4), 3) = b) AS n "
        "FROM range(4) t(b), (SELECT min(rating) AS lo, max(rating) AS hi FROM holed)",
        f"holed AS (SELECT {rated.format('review_id % 7 = 0', 'rating')} AS rating FROM v_reviews)",
    )
    q["nan_popularity_topk"] = with_views(
        ["v_products", "v_reviews"],
        "SELECT product_id, round(m, 6) AS item_avg_rating FROM (SELECT product_id, CASE WHEN product_id % 3 = 0 THEN NULL ELSE item_avg_rating END AS m "
        "FROM product_stats) ORDER BY m DESC NULLS LAST, product_id LIMIT 200",
        *REVIEWS_READY, PRODUCT_STATS,
    )
    q["prepare_sessions"] = with_views(
        ["v_sessions"],
        "SELECT session_id, user_id, x AS session_duration_sec, CASE WHEN hi > lo THEN round((x - lo) / (hi - lo), 6) ELSE 0.0 END "
        "AS duration_normalized FROM (SELECT *, min(x) OVER () AS lo, max(x) OVER () AS hi FROM "
        "(SELECT session_id, user_id, coalesce(session_duration_sec, 0.0) AS x FROM v_sessions))",
    )
    item, join = coded("kept", "event_type", "event_type_encoded")
    q["prepare_clickstream"] = with_views(
        ["v_clickstream"],
        "SELECT t.event_id, t.session_id, t.user_id, t.product_id, CAST(coalesce(hour(t.event_timestamp), -1) AS BIGINT) AS event_hour, "
        f"round(greatest(coalesce(t.dwell_time_sec, 0.0), 0.0), 6) AS dwell_time_sec, {item} FROM kept t {join}",
        "kept AS (SELECT * FROM v_clickstream WHERE session_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL)",
    )

    q["user_features"] = with_views(
        ["v_users", "v_sessions", "v_reviews"],
        "SELECT u.user_id, CAST(coalesce(a.n, 0) AS BIGINT) AS user_activity_frequency, round(coalesce(m.m, 0.0), 6) AS user_avg_rating "
        "FROM v_users u LEFT JOIN activity a USING (user_id) LEFT JOIN user_means m USING (user_id)",
        *REVIEWS_READY, *USER_STATS,
    )
    q["product_features"] = with_views(
        ["v_products", "v_reviews"],
        "SELECT product_id, product_name, round(item_avg_rating, 6) AS item_avg_rating, item_interaction_count FROM product_stats",
        *REVIEWS_READY, PRODUCT_STATS,
    )
    q["audit_pk"] = with_views(
        ["v_reviews"],
        "SELECT review_id, count(*) AS n_rows FROM v_reviews GROUP BY 1 HAVING count(*) > 1 OR review_id IS NULL",
    )
    q["audit_not_null"] = with_views(
        ALL_VIEWS,
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{n}' AS dataset, '{c}' AS \"column\", {count_of(f'{c} IS NULL')} AS n_null FROM {v}"
            for n, v in DATASET_VIEWS.items() for c in VIEW_COLUMNS[n].split()
        ) + ") WHERE n_null > 0",
    )
    q["audit_fk"] = with_views(
        ["v_reviews", "v_users", "v_products"],
        "SELECT 'user_id' AS fk, r.user_id AS key, count(*) AS n_rows FROM v_reviews r WHERE NOT EXISTS "
        "(SELECT 1 FROM v_users u WHERE u.user_id = r.user_id AND u.age IS NOT NULL) GROUP BY 2 UNION ALL "
        "SELECT 'product_id', r.product_id, count(*) FROM v_reviews r WHERE NOT EXISTS "
        "(SELECT 1 FROM v_products p WHERE p.product_id = r.product_id AND p.category IS NOT NULL) GROUP BY 2",
    )
    q["audit_check"] = with_views(["v_dirty"], "SELECT * FROM v_dirty WHERE NOT rating BETWEEN 1 AND 5")

    q["feature_unpivot"] = with_views(
        STORE_INPUTS,
        unpivoted(STORE_USERS, "store_users", "v1", T1) + "\nUNION ALL " + unpivoted(STORE_PRODUCTS, "store_products", "v1", T1),
        *STORE_CTES,
    )
    q["feature_upsert"] = with_views(STORE_INPUTS, STORE, *STORE_CTES)
    q["feature_lookup_version"] = with_views(
        STORE_INPUTS,
        "SELECT feature_view, entity_id, attribute_name, attribute_value FROM store "
        "WHERE feature_version = 'v1' AND feature_view = 'user_features'",
        *STORE_CTES, f"store AS ({STORE})",
    )
    q["feature_lookup_latest"] = with_views(
        STORE_INPUTS,
        "SELECT feature_view, entity_id, attribute_name, attribute_value, feature_version FROM (SELECT *, rank() OVER "
        "(PARTITION BY feature_view, entity_id ORDER BY materialized_at DESC) AS r FROM store) WHERE r = 1",
        *STORE_CTES, f"store AS ({STORE})",
    )
    declared = " UNION ALL ".join(
        f"SELECT '{v.name}' AS feature_view, '{v.description}' AS description, '{v.source_table}' AS source_table, "
        f"'{v.join_key}' AS join_key, '{f}' AS feature, '{t}' AS feature_type"
        for v in STORE_VIEWS for f, t in v.features
    )
    q["feature_repeated_keys"] = with_views(
        ["v_reviews"],
        " UNION ALL ".join(
            f"SELECT 'last_review' AS feature_view, CAST(product_id AS VARCHAR) AS entity_id, '{f}' AS attribute_name, "
            f"coalesce(CAST(arg_max_null({f}, review_id) AS VARCHAR), 'None') AS attribute_value, 'r{n}' AS feature_version, "
            f"'2024-01-0{n + 1}T00:00:00' AS materialized_at FROM v_reviews WHERE review_id % 2 = {n} GROUP BY product_id"
            for n in (0, 1) for f in ("rating", "user_id")
        )
        # Products without an odd review keep what the first batch gave them: of one time, the greatest value.
        + "".join(
            f" UNION ALL SELECT 'last_review', CAST(product_id AS VARCHAR), '{f}', max(coalesce(CAST({f} AS VARCHAR), 'None')), 'r1', "
            f"'2024-01-02T00:00:00' FROM v_reviews GROUP BY product_id HAVING count(*) FILTER (review_id % 2 = 1) = 0"
            for f in ("rating", "user_id")
        ),
    )
    q["audit_feature_key"] = with_views(
        ["v_reviews"],
        "SELECT 'batch' AS table_name, CAST(sum(2 * n) AS BIGINT) AS n_rows, CAST(2 * count(*) FILTER (n > 1) AS BIGINT) AS n_broken "
        "FROM sizes UNION ALL SELECT 'store', CAST(2 * count(*) AS BIGINT), CAST(0 AS BIGINT) FROM sizes",
        "sizes AS (SELECT product_id, count(*) AS n FROM v_reviews GROUP BY 1)",
    )
    q["feature_registry"] = with_views(
        STORE_INPUTS,
        f"SELECT d.*, l.last_materialized_at, l.latest_version FROM ({declared}) d LEFT JOIN (SELECT feature_view, "
        "max(materialized_at) AS last_materialized_at, arg_max(feature_version, materialized_at) AS latest_version "
        "FROM store GROUP BY 1) l USING (feature_view)",
        *STORE_CTES, f"store AS ({STORE})",
    )

    q["popularity_topk"] = with_views(
        ["v_products", "v_reviews"],
        f"SELECT product_id, item_interaction_count, round(item_avg_rating, 6) AS item_avg_rating FROM product_stats {POPULAR} LIMIT 5",
        *REVIEWS_READY, PRODUCT_STATS,
    )
    top = f"(SELECT CAST(row_number() OVER ({POPULAR}) AS INTEGER) AS rank, product_id FROM product_stats)"
    q["popularity_all_users"] = with_views(
        ["v_users", "v_products", "v_reviews"],
        f"SELECT user_id, rank, product_id FROM v_users CROSS JOIN {top} WHERE rank <= 5",
        *REVIEWS_READY, PRODUCT_STATS,
    )
    q["batch_recommend_lookup"] = with_views(
        ["v_users", "v_products", "v_reviews", "v_sessions"],
        f"SELECT user_id, rank, product_id FROM v_users CROSS JOIN {top} WHERE rank <= 3 AND user_id IN (SELECT user_id FROM v_sessions)",
        *REVIEWS_READY, PRODUCT_STATS,
    )
    q["holdout_split"] = with_views(
        ["v_reviews"],
        "SELECT review_id, user_id, product_id, is_test FROM flagged",
        *REVIEWS_READY, *split_ctes("kept_reviews"),
    )
    q["cold_start_fallback"] = with_views(
        ["v_users", "v_items", "v_interactions"],
        "SELECT user_id, rank, product_id FROM v_users CROSS JOIN popular WHERE user_id NOT IN (SELECT user_id FROM v_interactions)",
        "item_stats AS (SELECT i.product_id, coalesce(s.n, 0) AS item_interaction_count, coalesce(s.m, 0.0) AS item_avg_rating FROM v_items i "
        "LEFT JOIN (SELECT product_id, count(*) AS n, avg(rating) AS m FROM v_interactions GROUP BY 1) s USING (product_id))",
        f"popular AS (SELECT CAST(row_number() OVER ({POPULAR}) AS INTEGER) AS rank, product_id FROM item_stats QUALIFY rank <= 5)",
    )
    words = ", ".join(f"'{w}'" for w in stop_words())
    q["tokenize_terms"] = (
        f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TERM_PATTERN}')) AS term "
        f"FROM documents) WHERE term NOT IN ({words}) GROUP BY ALL"
    )
    q["tfidf_vocabulary"] = with_views(
        ["v_items"], "SELECT term, corpus_freq, doc_freq, round(idf, 6) AS idf FROM idf", *text[:4]
    )
    q["top_terms_sketched"] = with_views(["v_items"], "SELECT term, corpus_freq FROM vocab", *text[:3])
    q["tfidf_weights"] = with_views(["v_items"], "SELECT product_id, term, round(w, 6) AS weight FROM weights", *text)
    q["item_similarity_topk"] = with_views(
        ["v_items"],
        "SELECT product_id, rank, similar_id, round(score, 6) AS score FROM (SELECT a.product_id, CAST(row_number() OVER (PARTITION BY "
        "a.product_id ORDER BY coalesce(s.score, 0.0) DESC, b.product_id) AS INTEGER) AS rank, b.product_id AS similar_id, "
        "coalesce(s.score, 0.0) AS score FROM v_items a JOIN v_items b ON a.product_id <> b.product_id LEFT JOIN sims s "
        "ON s.a = a.product_id AND s.b = b.product_id QUALIFY rank <= 5)",
        *text,
        "sims AS (SELECT x.product_id AS a, y.product_id AS b, round(sum(x.w * y.w), 9) AS score FROM weights x JOIN weights y USING (term) GROUP BY ALL)",
    )
    q["item_similarity_indexed"] = q["item_similarity_topk"]
    recommender = ["v_users", "v_items", "v_interactions"]
    content = content_ctes("v_interactions", 5)
    q["user_profile"] = with_views(recommender, "SELECT user_id, term, round(w, 6) AS weight FROM profiles", *text, *content[:2])
    q["content_topk"] = with_views(
        recommender, "SELECT user_id, rank, product_id, round(score, 6) AS score FROM content_lists", *text, *content
    )
    q["content_topk_indexed"] = q["content_topk"]
    q["eval_ndcg"] = with_views(
        ["v_users", "v_products", "v_reviews"],
        f"SELECT * FROM {metrics('popular_lists', 100)}",
        *REVIEWS_READY, PRODUCT_STATS, *split_ctes("kept_reviews"),
        f"popular_lists AS (SELECT user_id, rank, product_id FROM v_users CROSS JOIN {top} WHERE rank <= 100)",
    )
    q["recommendation_artifact"] = with_views(
        [*recommender, "v_sessions"],
        "SELECT user_id, rank, product_id, round(score, 6) AS score FROM content_lists WHERE rank <= 3 AND user_id IN (SELECT user_id FROM v_sessions)",
        *text, *content,
    )
    q["metric_log"] = with_views(
        ["v_users", "v_products", "v_reviews"],
        " UNION ALL ".join(
            f"SELECT 'run-{k}' AS run_id, 'popularity' AS model, CAST({k} AS INTEGER) AS k, '{m}' AS metric, {m} AS value FROM {metrics('popular_lists', k)}"
            for k in (50, 100) for m in ("precision", "recall", "ndcg")
        ),
        *REVIEWS_READY, PRODUCT_STATS, *split_ctes("kept_reviews"),
        f"popular_lists AS (SELECT user_id, rank, product_id FROM v_users CROSS JOIN {top} WHERE rank <= 100)",
    )
    q["eval_report"] = with_views(
        recommender,
        f"SELECT 'popularity' AS model, CAST(20 AS INTEGER) AS k, * FROM {metrics('popular_lists', 20)} UNION ALL "
        f"SELECT 'content_tfidf', 20, * FROM {metrics('content_lists', 20)}",
        *text, *split_ctes("v_interactions"), *content_ctes("train", 20),
    )

    q["rating_histogram"] = with_views(
        ["v_reviews"],
        "SELECT CAST(b AS INTEGER) AS bin, round(lo + b * (hi - lo) / 5, 6) AS low, round(lo + (b + 1) * (hi - lo) / 5, 6) AS high, "
        "(SELECT count(*) FROM v_reviews WHERE rating IS NOT NULL AND least(floor((rating - lo) / (hi - lo) * 5), 4) = b) AS n "
        "FROM range(5) t(b), (SELECT min(rating) AS lo, max(rating) AS hi FROM v_reviews)",
    )
    q["item_popularity_top15"] = with_views(
        ["v_reviews"], "SELECT product_id, count(*) AS n FROM v_reviews WHERE product_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15"
    )
    q["item_popularity_sketched"] = with_views(
        ["v_reviews"],
        "SELECT product_id, count(*) AS n, true AS proven FROM v_reviews WHERE product_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15",
    )
    q["matrix_sparsity"] = with_views(
        ["v_reviews"],
        "SELECT n_rows, n_users, n_items, round(1 - n_rows / (CAST(n_users AS DOUBLE) * n_items), 6) AS sparsity FROM (SELECT count(*) AS n_rows, "
        "count(DISTINCT user_id) AS n_users, count(DISTINCT product_id) AS n_items FROM v_reviews)",
    )
    q["stage_audit"] = with_views(
        ["v_users", "v_products", "v_reviews"],
        " UNION ALL ".join(
            f"SELECT '{track}' AS track, '{stage}' AS stage, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys FROM {source}"
            for track, stage, source, key in (
                ("users", "raw", "v_users", "user_id"), ("users", "prepared", "v_users", "user_id"),
                ("products", "raw", "v_products", "product_id"), ("products", "prepared", "v_products", "product_id"),
                ("reviews", "raw", "v_reviews", "review_id"), ("reviews", "prepared", "kept_reviews", "review_id"),
            )
        ),
        *REVIEWS_READY,
    )
    return q
