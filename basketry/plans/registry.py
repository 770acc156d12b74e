"""The registered queries over the test tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import coercion
from basketry.functions.temporal import DATE_FORMAT, date_losses as lost_dates
from basketry.operators import (
    aggregates, dedup, encode, evaluate, feature_store, fingerprint, heavy, holdout, impute, integrity, profile, quality, recommend,
    tfidf,
)
from basketry.plans import prepare, warehouse
from basketry.plans.adapters import DATASET_VIEWS, REVIEW_ORDER, TABLES, table, view
from basketry.session import materialize, work_path
from basketry.sources import commits, files, landing, profiles, zones
from basketry.specs import DATASETS, DatasetSpec, FeatureView

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(column: str | Column, name: str | None = None) -> Column:
    """Doubles are compared to six digits."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, 6).alias(name or column)


def day(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM-dd").alias(column)


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def dataset_views(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {name: view(spark, d, v) for name, v in DATASET_VIEWS.items()}


# The test views carry part of the contract's columns. Each spec asks for what its
# view has, but for clickstream, which keeps the full list and so fails its check.
def view_spec(name: str, df: DataFrame) -> DatasetSpec:
    full = DATASETS[name]
    columns = full.columns if name == "clickstream" else tuple(c for c in full.columns if c in df.columns)
    return DatasetSpec(name, columns, full.key, full.required, full.ranges, full.email_column)


# --- sources ---------------------------------------------------------------


@query
def scan_csv_roundtrip(spark, d):
    path = work_path(spark, "csv")
    view(spark, d, "v_products").write.csv(path, header=True)
    df = files.read_csv(spark, path)
    return df.select(
        F.col("product_id").try_cast("long").alias("product_id"), "product_name", "category", "brand",
        coercion.to_number(F.col("price")).alias("price"), "avg_rating",
    )


@query
def scan_free_text(spark, d):
    """Documents as CSV with line breaks inside quotes, read back range by range."""
    path = work_path(spark, "csv")
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    docs.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    df = files.read_csv(spark, path, free_text=True)
    return df.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"), "source")


@query
def land_partitioned(spark, d):
    path = work_path(spark, "landing")
    landing.land(table(spark, d, "events"), path, F.date_format("ts", "yyyy-MM-dd"))
    return spark.read.parquet(path).groupBy(F.col("ingest_date").cast("string").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("n_rows"), r6(F.sum("value"), "total_value")
    )


@query
def profile_landings(spark, d):
    """Events landed by day and profiled twice, the second time with one more day: what the stored states give, and
    whether distinct counts are within their error."""
    path, states = work_path(spark, "landing"), work_path(spark, "states")
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", "ts")
    day_ = F.date_format("ts", "yyyy-MM-dd")
    last = events.agg(F.max(day_)).scalar()
    landing.land(events.where(day_ < last), path, day_)
    profiles.refresh(spark, path, states)
    landing.land(events.where(day_ == last), path, day_)
    n_read = len(profiles.refresh(spark, path, states))
    exact = union([
        events.agg(F.count_distinct(c).alias("d")).select(F.lit(c).alias("column"), "d")
        for c in ("event_id", "user_id", "event_type", "value")
    ])
    found = profiles.profile(spark, states).join(exact, "column")
    close = F.abs(F.col("n_distinct") - F.col("d")) <= F.greatest(F.lit(1.0), F.col("d") * profiles.DISTINCT_ERROR)
    return found.select(
        "column", "n_rows", "n_null", r6("low"), r6("high"), close.alias("distinct_close"), F.lit(n_read).alias("dates_read")
    )


@query
def latest_partition(spark, d):
    path = work_path(spark, "landing")
    landing.land(table(spark, d, "events"), path, F.date_format("ts", "yyyy-MM-dd"))
    return landing.read_latest(spark, path).select("event_id", "user_id", "event_type", "value")


PAYLOAD_SQL = """
    SELECT event_type,
           CASE event_type
             WHEN 'view' THEN concat('{{"products":[', repeat('{{"id":1}},', k), '{{"id":0}}],"total":1}}')
             WHEN 'click' THEN concat('[', repeat('0,', k), '0]')
             ELSE props END AS payload
    FROM (SELECT event_type, props, CAST({k_expr} AS INT) AS k FROM {events}) AS e"""


@query
def json_payload_items(spark, d):
    sql = PAYLOAD_SQL.replace("{k_expr}", "get_json_object(props, '$.k')")
    payloads = spark.sql(sql, events=table(spark, d, "events"))
    return payloads.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_payloads"), F.sum(files.payload_item_count(F.col("payload"))).alias("n_items")
    )


@query
def payload_landing(spark, d):
    """Responses landed as they came on two days, the second of them twice; what each day holds."""
    path = work_path(spark, "payloads")
    sql = PAYLOAD_SQL.replace("{k_expr}", "get_json_object(props, '$.k')")
    payloads = spark.sql(sql, events=table(spark, d, "events"))
    for day_, kind in (("2024-01-01", "view"), ("2024-01-02", "view"), ("2024-01-02", "click")):
        landing.ingest_payloads(payloads.where(F.col("event_type") == kind), path, day_)
    landed = spark.read.text(path).groupBy(F.col("ingest_date").cast("string").alias("ingest_date"))
    return landed.agg(F.count(F.lit(1)).alias("n_payloads"), F.sum(files.payload_item_count(F.col("value"))).alias("n_items"))


@query
def payload_lanes(spark, d):
    """The same responses, every tenth cut short, parsed when they are landed; those that do not parse are kept and counted."""
    path = work_path(spark, "payloads")
    sql = PAYLOAD_SQL.replace("{k_expr}", "get_json_object(props, '$.k')").replace("SELECT event_type, props,", "SELECT event_id, event_type, props,")
    payloads = spark.sql(sql.replace("SELECT event_type,", "SELECT event_id, event_type,"), events=table(spark, d, "events"))
    cut = F.when(F.col("event_id") % 10 == 0, F.expr("left(payload, length(payload) - 1)")).otherwise(F.col("payload"))
    landing.land_parsed(payloads.withColumn("payload", cut), path, "2024-01-01")
    return landing.read_latest(spark, path).groupBy("event_type").agg(
        F.count("value").alias("n_parsed"), F.count("unparsed").alias("n_unparsed"),
        F.sum(files.parsed_item_count(F.col("value"))).alias("n_items"), F.sum(F.length("unparsed")).alias("unparsed_chars"),
    )


@query
def ingest_metrics(spark, d):
    root = work_path(spark, "raw")
    sources = [(name, table(spark, d, name)) for name in TABLES] + [("returns", f"{root}/no-such-file.csv")]
    return landing.ingest(spark, sources, root, "2024-01-31").select("dataset", "ok", "n_rows")


@query
def warehouse_counts(spark, d):
    return zones.table_counts(star_schema(spark, d))


@query
def published_sets(spark, d):
    """What readers see after each change of a set: one that succeeds, one whose second table fails, one of a single table."""
    root = work_path(spark, "zone")
    orders, customer = table(spark, d, "orders").select("o_orderkey"), table(spark, d, "customer").select("c_custkey")
    broken = customer.select(F.when(F.col("c_custkey") > 0, F.raise_error(F.lit("stopped"))).cast("long").alias("c_custkey"))
    steps = [
        {"orders": orders, "customer": customer},
        {"orders": orders.where("o_orderkey % 2 = 0"), "customer": broken},
        {"customer": customer.where("c_custkey % 3 = 0")},
    ]
    seen = []
    for step, tables in enumerate(steps):
        try:
            zones.write_tables(tables, root)
        except Exception as error:
            if "stopped" not in str(error):
                raise
        now = zones.table_counts(zones.require_tables(spark, root, ["orders", "customer"]))
        seen.append(now.select(F.lit(step).alias("step"), F.lit(commits.head(spark, root)[0]).alias("record"), "*"))
    return union(seen)


@query
def processed_zone(spark, d):
    """The prepared tables, written to their zone as one set and read back by name."""
    root = work_path(spark, "processed")
    zones.write_tables({
        "users": users_ready(spark, d), "products": products_ready(spark, d), "reviews": reviews_ready(spark, d),
        "sessions": sessions_ready(spark, d),
    }, root)
    stored = zones.require_tables(spark, root, ["users", "products", "reviews", "sessions"])
    return union([
        df.agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct(DATASETS[name].key).alias("n_keys"),
            F.sum(F.col(DATASETS[name].key)).alias("key_sum"), F.lit(len(df.columns)).alias("n_columns"),
        ).select(F.lit(name).alias("dataset"), "*")
        for name, df in stored.items()
    ])


def loaded_warehouse(spark, d):
    """The star schema, loaded under its constraints and read back."""
    root = work_path(spark, "warehouse")
    warehouse.load(spark, star_schema(spark, d), root)
    return zones.require_tables(spark, root, list(warehouse.PRIMARY_KEYS))


@query
def warehouse_users(spark, d):
    df = loaded_warehouse(spark, d)["dim_users"]
    return df.select(
        "user_id", r6("age"), "gender", "city", "membership", "signup_year", "user_activity_frequency", r6("user_avg_rating")
    )


@query
def warehouse_products(spark, d):
    df = loaded_warehouse(spark, d)["dim_products"]
    return df.select(
        "product_id", "product_name", "category", "brand", r6("price"), r6("item_avg_rating"), "item_interaction_count", "description"
    )


@query
def warehouse_interactions(spark, d):
    df = loaded_warehouse(spark, d)["fact_interactions"]
    return df.select("review_id", "user_id", "product_id", "rating", "sentiment_encoded", F.col("review_date").substr(1, 10).alias("review_date"))


@query
def warehouse_column_types(spark, d):
    """The stored type of each warehouse column and how many values it holds after its cast."""
    return union([
        df.agg(*(F.count(c).alias(c) for c in df.columns))
        .select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(c).alias("n_values")) for c, t in df.dtypes))))
        .select(F.lit(name).alias("table_name"), "*")
        for name, df in loaded_warehouse(spark, d).items()
    ])


# --- quality -----------------------------------------------------------------


@query
def schema_check(spark, d):
    views = dataset_views(spark, d)
    checked = quality.schema_check(((n, df, view_spec(n, df)) for n, df in views.items()), spark)
    counts = zones.table_counts(views).withColumnRenamed("table_name", "dataset")
    return checked.join(counts, "dataset")


@query
def numeric_coerce(spark, d):
    text = F.col("avg_rating")
    df = view(spark, d, "v_products").select("product_id", "avg_rating")
    return df.select(
        "product_id",
        coercion.to_number(text).alias("number"),
        coercion.to_number_or_embedded(text).alias("embedded"),
        coercion.malformed(text, coercion.to_number_or_embedded(text)).alias("malformed"),
    )


@query
def extract_rating(spark, d):
    rating = F.coalesce(coercion.extract_number(F.col("avg_rating")), F.lit(0.0))
    return view(spark, d, "v_products").select("product_id", rating.alias("avg_rating"))


@query
def range_violations(spark, d):
    tables = {"reviews": view(spark, d, "v_dirty")}
    tables.update({n: view(spark, d, DATASET_VIEWS[n]) for n in ("users", "products", "sessions")})
    return union([quality.rule_counts(df, DATASETS[n], "range") for n, df in tables.items()])


@query
def email_format(spark, d):
    return view(spark, d, "v_users").select("user_id", quality.invalid_email(F.col("email")).alias("invalid"))


@query
def null_profile(spark, d):
    return union([quality.null_profile(df, n) for n, df in dataset_views(spark, d).items()])


@query
def required_nulls(spark, d):
    return union([quality.rule_counts(df, DATASETS[n], "required") for n, df in dataset_views(spark, d).items()])


@query
def duplicate_rows(spark, d):
    tables = {
        "documents": table(spark, d, "documents").select("text"),
        "lineitem": table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"),
    }
    return union([dedup.duplicate_rows(df).select(F.lit(n).alias("dataset"), "*") for n, df in tables.items()])


def full_report(spark, d):
    return union([quality.quality_report(df, view_spec(n, df)) for n, df in dataset_views(spark, d).items()])


@query
def quality_report(spark, d):
    return full_report(spark, d)


@query
def validation_gate(spark, d):
    views = dataset_views(spark, d)
    schema = quality.schema_check(((n, df, view_spec(n, df)) for n, df in views.items()), spark)
    gate = materialize(quality.gate(schema, full_report(spark, d)), "gate")
    root = work_path(spark, "validated")
    staged = zones.promote(views, gate, root)
    counts = zones.table_counts({n: zones.read_table(spark, root, n) for n in staged})
    staged_rows = counts.select(F.col("table_name").alias("dataset"), F.col("n_rows").alias("n_promoted"))
    return gate.join(staged_rows, "dataset", "left").na.fill({"n_promoted": 0})


@query
def gate_without_contracts(spark, d):
    """Landed tables that no contract names: judged by their duplicates, promoted or held back, counted."""
    lake = work_path(spark, "lake")
    tables = {
        "nation": table(spark, d, "nation"), "region": table(spark, d, "region"),
        "lines": table(spark, d, "lineitem").select("l_orderkey", "l_returnflag"), "users": view(spark, d, "v_users"),
    }
    for name, df in tables.items():
        landing.land(df, f"{lake}/raw/{name}", "2024-01-01")
    found = {name: landing.read_latest(spark, f"{lake}/raw/{name}") for name in landing.landed(spark, f"{lake}/raw")}
    report, schema = quality.profile_datasets(spark, found, DATASETS)
    gate = materialize(quality.gate(schema, report), "gate")
    zones.promote(found, gate, f"{lake}/validated")
    staged = zones.existing(spark, f"{lake}/validated", found)
    counts = zones.table_counts({n: zones.read_table(spark, f"{lake}/validated", n) for n in staged})
    promoted = counts.select(F.col("table_name").alias("dataset"), F.col("n_rows").alias("n_promoted"))
    return gate.join(promoted, "dataset", "left").na.fill({"n_promoted": 0})


# --- preparation ---------------------------------------------------------------


@query
def dedup_keep_first(spark, d):
    df = dedup.keep_first(view(spark, d, "v_reviews"), ["review_id"], REVIEW_ORDER)
    return df.select(
        "review_id", "user_id", "product_id", "rating", "sentiment", day("review_date"), day("l_shipdate"), "l_suppkey",
        "l_extendedprice",
    )


@query
def median_impute(spark, d):
    users = impute.median_impute(view(spark, d, "v_users"), ["age"])
    products = impute.median_impute(view(spark, d, "v_products"), ["price"])
    return union([
        users.select(F.lit("users").alias("dataset"), F.col("user_id").alias("id"), r6("age", "value")),
        products.select(F.lit("products").alias("dataset"), F.col("product_id").alias("id"), r6("price", "value")),
    ])


@query
def minmax_scale(spark, d):
    df = encode.minmax_scale(view(spark, d, "v_sessions"), {"session_duration_sec": "scaled"})
    return df.select("session_id", r6("scaled"))


@query
def log_normalize(spark, d):
    df = encode.log_scale(view(spark, d, "v_clickstream"), {"dwell_time_sec": "dwell_log"})
    return df.select("event_id", r6("dwell_log"))


@query
def label_encode(spark, d):
    columns = {"gender": "gender_code", "membership": "membership_code", "customer_segment": "segment_code"}
    return encode.label_encode(view(spark, d, "v_users"), columns).select("user_id", *columns.values())


def with_nan(df, column, key, m):
    """``df`` with NaN in place of every m-th value."""
    return df.withColumn(column, F.when(F.col(key) % m == 0, float("nan")).otherwise(F.col(column)))


@query
def nan_log_normalize(spark, d):
    df = encode.log_scale(with_nan(view(spark, d, "v_clickstream"), "dwell_time_sec", "event_id", 5), {"dwell_time_sec": "dwell_log"})
    return df.select("event_id", r6("dwell_log"))


@query
def nan_label_encode(spark, d):
    df = encode.label_encode(with_nan(view(spark, d, "v_dirty"), "rating", "review_id", 4), {"rating": "rating_code"})
    return df.select("review_id", "rating_code")


@query
def date_losses(spark, d):
    """Values that the date format of a column's first value turns into null."""
    return lost_dates(view(spark, d, "v_users"), ["signup_date"], ["user_id"])


USER_ORDER = ("age", "gender", "membership", "customer_segment", "email", "signup_date")


def users_ready(spark, d):
    return prepare.prepare_users(view(spark, d, "v_users"), USER_ORDER, DATE_FORMAT)


@query
def prepare_users_dates(spark, d):
    return users_ready(spark, d).select(
        "user_id", r6("age"), "gender", "gender_encoded", "membership_encoded", "segment_encoded",
        day("signup_date"), "signup_year", "signup_month", r6("age_normalized"),
    )


def products_ready(spark, d):
    df = view(spark, d, "v_products")
    return prepare.prepare_products(df, [c for c in df.columns if c != "product_id"])


@query
def prepare_products(spark, d):
    return products_ready(spark, d).select(
        "product_id", "category", "brand", r6("price"), "avg_rating", "category_encoded", "brand_encoded",
        r6("price_log_normalized"),
    )


def reviews_ready(spark, d):
    return prepare.prepare_reviews(view(spark, d, "v_reviews"), REVIEW_ORDER)


@query
def prepare_reviews(spark, d):
    return reviews_ready(spark, d).select(
        "review_id", "user_id", "product_id", "rating", "sentiment_encoded", day("review_date")
    )


def sessions_ready(spark, d):
    return prepare.prepare_sessions(view(spark, d, "v_sessions"), ["user_id", "session_start", "session_duration_sec"])


@query
def prepare_sessions(spark, d):
    return sessions_ready(spark, d).select("session_id", "user_id", "session_duration_sec", r6("duration_normalized"))


@query
def prepare_clickstream(spark, d):
    df = view(spark, d, "v_clickstream")
    ready = prepare.prepare_clickstream(df, [c for c in df.columns if c != "event_id"])
    return ready.select(
        "event_id", "session_id", "user_id", "product_id", "event_hour", r6("dwell_time_sec"), "event_type_encoded"
    )


# --- features and constraints ------------------------------------------------------


@query
def user_features(spark, d):
    users, sessions = view(spark, d, "v_users"), view(spark, d, "v_sessions")
    df = aggregates.user_features(users, sessions, reviews_ready(spark, d))
    return df.select("user_id", "user_activity_frequency", r6("user_avg_rating"))


@query
def product_features(spark, d):
    df = aggregates.product_features(view(spark, d, "v_products"), reviews_ready(spark, d))
    return df.select("product_id", "product_name", r6("item_avg_rating"), "item_interaction_count")


def star_schema(spark, d):
    return warehouse.build(
        users_ready(spark, d), products_ready(spark, d), reviews_ready(spark, d), sessions_ready(spark, d)
    )


@query
def audit_pk(spark, d):
    return integrity.primary_key(view(spark, d, "v_reviews"), ["review_id"])


@query
def audit_not_null(spark, d):
    tables = {n: view(spark, d, v) for n, v in DATASET_VIEWS.items()}
    return union([
        integrity.not_null(df, df.columns).select(F.lit(n).alias("dataset"), "*") for n, df in tables.items()
    ])


@query
def audit_fk(spark, d):
    # Dimensions as a gate would leave them: users with a known age, products with a category.
    fact = view(spark, d, "v_reviews")
    users = view(spark, d, "v_users").where("age IS NOT NULL")
    products = view(spark, d, "v_products").where("category IS NOT NULL")
    return union([
        integrity.foreign_key(fact, "user_id", users, "user_id").select(F.lit("user_id").alias("fk"), "*"),
        integrity.foreign_key(fact, "product_id", products, "product_id").select(F.lit("product_id").alias("fk"), "*"),
    ])


@query
def audit_check(spark, d):
    return integrity.check_between(view(spark, d, "v_dirty"), "rating", 1, 5)


# --- feature store -------------------------------------------------------------------

STORE_USERS = FeatureView(
    "user_features", "dim_users", "user_id", "Users", (
        ("age", "REAL"), ("gender", "TEXT"), ("city", "TEXT"), ("membership", "TEXT"),
        ("user_activity_frequency", "INTEGER"), ("tenure", "TEXT"),
    ),
)
STORE_PRODUCTS = FeatureView(
    "product_features", "dim_products", "product_id", "Products", (
        ("product_name", "TEXT"), ("category", "TEXT"), ("brand", "TEXT"), ("price", "REAL"),
        ("item_interaction_count", "INTEGER"),
    ),
)
STORE_VIEWS = (STORE_USERS, STORE_PRODUCTS)


def store_tables(spark, d):
    sessions = view(spark, d, "v_sessions")
    reviews = view(spark, d, "v_reviews")
    return {
        "dim_users": aggregates.user_features(view(spark, d, "v_users"), sessions, reviews),
        "dim_products": aggregates.product_features(view(spark, d, "v_products"), reviews),
    }


@query
def feature_unpivot(spark, d):
    return feature_store.unpivot_views(store_tables(spark, d), STORE_VIEWS, "v1", "2024-01-01T00:00:00")


def written_path(spark, d):
    """v1 of both views, v2 of users, then v1 again for the users with a gender, renamed."""
    path = work_path(spark, "features")
    tables = store_tables(spark, d)
    feature_store.write_features(
        feature_store.unpivot_views(tables, STORE_VIEWS, "v1", "2024-01-01T00:00:00"), path
    )
    feature_store.write_features(
        feature_store.unpivot_view(tables["dim_users"], STORE_USERS, "v2", "2024-01-02T00:00:00"), path
    )
    renamed = tables["dim_users"].where("gender IS NOT NULL").withColumn("gender", F.lower("gender"))
    feature_store.write_features(
        feature_store.unpivot_view(renamed, STORE_USERS, "v1", "2024-01-03T00:00:00"), path
    )
    return path


@query
def feature_upsert(spark, d):
    return feature_store.read_features(spark, written_path(spark, d))


@query
def feature_lookup_version(spark, d):
    return feature_store.read_version(spark, written_path(spark, d), "v1", "user_features")


@query
def feature_lookup_latest(spark, d):
    return feature_store.latest(spark, written_path(spark, d))


@query
def feature_registry(spark, d):
    current = feature_store.read_current(spark, written_path(spark, d)).select("feature_view", F.inline("features"))
    return feature_store.registry(current, STORE_VIEWS, spark)


def repeated_batch(spark, d):
    """Every review as a materialisation of its product: the later review's rating and user count."""
    view_ = FeatureView("last_review", "reviews", "product_id", "Last review", (("rating", "REAL"), ("user_id", "TEXT")))
    reviews = view(spark, d, "v_reviews")
    parts = [
        feature_store.unpivot_view(reviews.where(f"review_id % 2 = {n}"), view_, f"r{n}", f"2024-01-0{n + 1}T00:00:00", order=["review_id"])
        for n in (0, 1)
    ]
    return union(parts), feature_store.unpivot_view(reviews, view_, "r1", "2024-01-02T00:00:00")


@query
def feature_repeated_keys(spark, d):
    """A store fed with batches that repeat keys, in which the last row of a key counts."""
    path = work_path(spark, "features")
    ordered, loose = repeated_batch(spark, d)
    feature_store.write_features(loose, path)
    feature_store.write_features(ordered, path)
    return feature_store.read_features(spark, path)


@query
def audit_feature_key(spark, d):
    """Rows and broken keys of a batch that repeats keys, and of the store it is written to."""
    path = work_path(spark, "features")
    _, loose = repeated_batch(spark, d)
    feature_store.write_features(loose, path)
    tables = {"batch": loose, "store": feature_store.read_features(spark, path)}
    return union([
        df.agg(F.count(F.lit(1)).alias("n_rows")).join(
            integrity.primary_key(df, feature_store.KEYS).agg(F.count(F.lit(1)).alias("n_broken"))
        ).select(F.lit(name).alias("table_name"), "n_rows", "n_broken")
        for name, df in tables.items()
    ])


# --- recommenders ------------------------------------------------------------------------


def product_stats(spark, d):
    return aggregates.product_features(view(spark, d, "v_products"), reviews_ready(spark, d))


@query
def popularity_topk(spark, d):
    top = recommend.popular_products(product_stats(spark, d), 5)
    return top.select("product_id", "item_interaction_count", r6("item_avg_rating"))


@query
def nan_popularity_topk(spark, d):
    """Products by one mean rating only, of which every third is NaN."""
    stats = with_nan(product_stats(spark, d), "item_avg_rating", "product_id", 3).withColumn("item_interaction_count", F.lit(1))
    return recommend.popular_products(stats, 200).select("product_id", r6(impute.present("item_avg_rating"), "item_avg_rating"))


@query
def popularity_all_users(spark, d):
    return recommend.recommend_popular(view(spark, d, "v_users"), product_stats(spark, d), 5)


@query
def holdout_split(spark, d):
    split = holdout.holdout_split(reviews_ready(spark, d), "user_id", "review_date", "review_id")
    return split.select("review_id", "user_id", "product_id", "is_test")


def catalogue(spark, d):
    """Documents as items, with their interaction statistics from events."""
    return aggregates.product_features(view(spark, d, "v_items"), view(spark, d, "v_interactions"))


def item_model(spark, d):
    return recommend.fit_content(view(spark, d, "v_items"))


@query
def cold_start_fallback(spark, d):
    cold = recommend.cold_start_users(view(spark, d, "v_users"), view(spark, d, "v_interactions"))
    return recommend.recommend_popular(cold, catalogue(spark, d), 5)


@query
def tokenize_terms(spark, d):
    return tfidf.tokenize(table(spark, d, "documents"), "doc_id", F.col("text"))


@query
def tfidf_vocabulary(spark, d):
    rows = item_model(spark, d).vocabulary(spark)
    return rows.select("term", "corpus_freq", "doc_freq", r6("idf"))


@query
def top_terms_sketched(spark, d):
    """The vocabulary from a sketch of all terms and a recount of the candidates."""
    items = view(spark, d, "v_items")
    return tfidf.top_terms(items, recommend.item_text(items), sketch=True)


@query
def tfidf_weights(spark, d):
    return item_model(spark, d).vector_rows().select("product_id", "term", r6("weight"))


@query
def item_similarity_topk(spark, d):
    return recommend.similar_items(item_model(spark, d), 5).select("product_id", "rank", "similar_id", r6("score"))


@query
def user_profile(spark, d):
    model = item_model(spark, d)
    history = recommend.history_counts(view(spark, d, "v_users"), view(spark, d, "v_interactions"))
    rows = recommend.user_profiles(history, model).select("user_id", F.inline(F.arrays_zip("idx", "w")))
    return rows.select("user_id", model.term_at("idx"), r6("w", "weight"))


@query
def content_topk(spark, d):
    users, interactions = view(spark, d, "v_users"), view(spark, d, "v_interactions")
    recs = recommend.recommend_content(users, catalogue(spark, d), interactions, 5, item_model(spark, d))
    return recs.select("user_id", "rank", "product_id", r6("score"))


# The same lists by the search that item tables beyond the broadcast limit get.
@query
def item_similarity_indexed(spark, d):
    lists = recommend.similar_items(item_model(spark, d), 5, broadcast_bytes=0)
    return lists.select("product_id", "rank", "similar_id", r6("score"))


@query
def content_topk_indexed(spark, d):
    users, interactions = view(spark, d, "v_users"), view(spark, d, "v_interactions")
    recs = recommend.recommend_content(users, catalogue(spark, d), interactions, 5, item_model(spark, d), broadcast_bytes=0)
    return recs.select("user_id", "rank", "product_id", r6("score"))


@query
def batch_recommend_lookup(spark, d):
    # Lists are stored, then looked up for everyone who had a session.
    stored = materialize(recommend.recommend_popular(view(spark, d, "v_users"), product_stats(spark, d), 5), "lists")
    return recommend.lookup(view(spark, d, "v_sessions"), stored, 3)


@query
def recommendation_artifact(spark, d):
    """Content lists published as a table, then looked up for everyone who had a session."""
    root = work_path(spark, "recommendations")
    users, interactions = view(spark, d, "v_users"), view(spark, d, "v_interactions")
    lists = recommend.recommend_content(users, catalogue(spark, d), interactions, 5, item_model(spark, d))
    zones.write_table(lists, root, "content")
    stored = zones.require_tables(spark, root, ["content"])["content"]
    return recommend.lookup(view(spark, d, "v_sessions"), stored, 3).select("user_id", "rank", "product_id", r6("score"))


@query
def metric_log(spark, d):
    """Two runs' metrics appended to one log."""
    path = work_path(spark, "metrics")
    reviews = materialize(reviews_ready(spark, d), "reviews")
    _, test = holdout.train_test(reviews, "user_id", "review_date", "review_id")
    products = materialize(aggregates.product_features(view(spark, d, "v_products"), reviews), "products")
    for k in (50, 100):
        lists = recommend.recommend_popular(view(spark, d, "v_users"), products, k)
        report = evaluate.compare_models(test, {"popularity": lists}, k)
        evaluate.metric_rows(report, f"run-{k}").write.mode("append").parquet(path)
    return spark.read.parquet(path).select("run_id", "model", "k", "metric", r6("value"))


def rounded_metrics(df):
    return df.select(*(r6(c) if c in ("precision", "recall", "ndcg") else F.col(c) for c in df.columns))


@query
def eval_ndcg(spark, d):
    reviews = materialize(reviews_ready(spark, d), "reviews")
    _, test = holdout.train_test(reviews, "user_id", "review_date", "review_id")
    products = aggregates.product_features(view(spark, d, "v_products"), reviews)
    lists = recommend.recommend_popular(view(spark, d, "v_users"), products, 100)
    return rounded_metrics(evaluate.evaluate_at_k(test, lists, 100))


@query
def eval_report(spark, d):
    users, items = view(spark, d, "v_users"), materialize(catalogue(spark, d), "catalogue")
    train, test = holdout.train_test(view(spark, d, "v_interactions"), "user_id", "review_date", "review_id")
    lists = {
        "popularity": recommend.recommend_popular(users, items, 20),
        "content_tfidf": recommend.recommend_content(users, items, train, 20, item_model(spark, d)),
    }
    return rounded_metrics(evaluate.compare_models(test, lists, 20))


# --- profile -------------------------------------------------------------------------------


@query
def rating_histogram(spark, d):
    return profile.histogram(view(spark, d, "v_reviews"), "rating", 5).select("bin", r6("low"), r6("high"), "n")


@query
def nan_histogram(spark, d):
    df = with_nan(view(spark, d, "v_reviews"), "rating", "review_id", 7)
    return profile.histogram(df, "rating", 4).select("bin", r6("low"), r6("high"), "n")


@query
def exploration_summary(spark, d):
    df = profile.exploration_summary(view(spark, d, "v_reviews"), view(spark, d, "v_clickstream"))
    return df.select("n_reviews", "n_events", "n_users", "n_items", r6("sparsity"))


@query
def stage_difference(spark, d):
    """Users whose cells a preparation changed, and which cells, found by hash trees."""
    return fingerprint.changed_keys(view(spark, d, "v_users"), users_ready(spark, d), "user_id", ["age", "gender", "membership", "email"])


@query
def item_popularity_top15(spark, d):
    return profile.top_items(view(spark, d, "v_reviews"), "product_id", 15)


@query
def item_popularity_sketched(spark, d):
    """The same list from a sketch and a recount, with the proof that nothing else can be in it."""
    found = heavy.top_counts(view(spark, d, "v_reviews").select("product_id"), "product_id", 15)
    proven = found.proof.agg(F.every("proven")).scalar()
    return found.rows.select(F.col("value").alias("product_id"), "n", proven.alias("proven"))


@query
def matrix_sparsity(spark, d):
    df = profile.matrix_sparsity(view(spark, d, "v_reviews"), "user_id", "product_id")
    return df.select("n_rows", "n_users", "n_items", r6("sparsity"))


@query
def stage_audit(spark, d):
    tracks = [
        ("users", "raw", view(spark, d, "v_users"), "user_id"),
        ("users", "prepared", users_ready(spark, d), "user_id"),
        ("products", "raw", view(spark, d, "v_products"), "product_id"),
        ("products", "prepared", products_ready(spark, d), "product_id"),
        ("reviews", "raw", view(spark, d, "v_reviews"), "review_id"),
        ("reviews", "prepared", reviews_ready(spark, d), "review_id"),
    ]
    return profile.stage_audit(tracks).select("track", "stage", "n_rows", "n_keys")


__all__ = ["QUERIES"]
