"""Versioned long-form feature store: the history of all versions, and beside it the current state.

The history has one row for each (view, entity, attribute, version). The current state has one row for
each (view, entity): the last materialised value of every attribute. Both change in one commit record
(``sources.commits``), so a reader sees them agree; lookups of the latest values read the current
state only, whose files are cut by entity, and never rank the history.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.coercion import python_float_text
from basketry.session import materialize, work_path
from basketry.sources import commits
from basketry.specs import FeatureView

KEYS = ["feature_view", "entity_id", "attribute_name", "feature_version"]
COLUMNS = ["feature_view", "entity_id", "attribute_name", "attribute_value", "feature_version", "materialized_at"]


def value_text(df: DataFrame, feature: str) -> Column:
    """A feature as text: null gives 'None', a feature the table lacks gives ''."""
    if feature not in df.columns:
        return F.lit("")
    x = F.col(feature)
    if isinstance(df.schema[feature].dataType, (T.DoubleType, T.FloatType)):
        number = F.nanvl(x.cast("double"), F.lit(None))
        return F.coalesce(python_float_text(number), F.lit("None"))
    return F.coalesce(x.cast("string"), F.lit("None"))


def new_version() -> str:
    """The version of a materialisation that names none: its time."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


def unpivot_view(
    df: DataFrame, view: FeatureView, version: str, materialized_at: str, order: Sequence[str] = ()
) -> DataFrame:
    """One row per entity and declared feature; an entity without an id is 'None'.

    With ``order`` an entity that occurs more than once gives the values of its last row.
    """
    names = [name for name, _ in view.features]
    entity = F.coalesce(F.col(view.join_key).cast("string"), F.lit("None")).alias("entity_id")
    wide = df.select(entity, *(value_text(df, n).alias(n) for n in names), F.struct(*order, F.lit(0).alias("_")).alias("_order"))
    if order:
        last = F.max_by(F.struct(*names), "_order").alias("v")
        wide = wide.groupBy("entity_id").agg(last).select("entity_id", "v.*")
    else:
        wide = wide.drop("_order")
    long = wide.unpivot("entity_id", names, "attribute_name", "attribute_value")
    return long.select(
        F.lit(view.name).alias("feature_view"), "entity_id", "attribute_name", "attribute_value",
        F.lit(version).alias("feature_version"), F.lit(materialized_at).alias("materialized_at"),
    )


def unpivot_views(tables: Mapping[str, DataFrame], views: Iterable[FeatureView], version: str, at: str) -> DataFrame:
    """All views' rows; ``tables`` maps source table names to DataFrames."""
    out = None
    for view in views:
        rows = unpivot_view(tables[view.source_table], view, version, at)
        out = rows if out is None else out.unionByName(rows)
    return out


def fold_batch(rows: DataFrame) -> DataFrame:
    """One row of each key: the last materialised one, of those of one time the one with the greatest value."""
    newest = F.max_by(F.struct("attribute_value", "materialized_at"), F.struct("materialized_at", "attribute_value")).alias("v")
    folded = rows.groupBy(*KEYS).agg(newest)
    return folded.select(*KEYS, "v.*").select(*COLUMNS)


def upsert(store: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` replace stored rows of the same key; the rest of the store is kept. A repeated key in ``rows`` leaves one row."""
    rows = fold_batch(rows)
    return store.join(rows, KEYS, "left_anti").unionByName(rows).select(*COLUMNS)


def write_features(rows: DataFrame, path: str) -> None:
    """Upsert into the store at ``path``: the touched (view, version) parts of its history are rewritten, the
    touched views' current state is merged, and one record makes both count."""
    spark = rows.sparkSession
    rows = materialize(fold_batch(rows), "new-features")
    # One row per view and version written; their names may hold any character, so folders are numbered.
    pairs = sorted(tuple(r) for r in rows.select("feature_view", "feature_version").distinct().collect())
    if not pairs:
        return
    stored = _adopted(spark, path)
    old = {pair: stored[_history(*pair)] for pair in pairs if _history(*pair) in stored}
    kept = _read(spark, path, old.values(), _HISTORY).join(rows, KEYS, "left_anti") if old else rows.limit(0)
    numbered = spark.createDataFrame([(*pair, n) for n, pair in enumerate(pairs)], "feature_view string, feature_version string, part int")
    parts = kept.unionByName(rows).join(F.broadcast(numbered), ["feature_view", "feature_version"])
    folder = f"{commits.VERSIONS}/history-{work_path(spark, '').rpartition('-')[2]}"
    parts.write.partitionBy("part").parquet(f"{path}/{folder}")
    staged = {_history(*pair): f"{folder}/part={n}" for n, pair in enumerate(pairs)}

    for view in sorted({view for view, _ in pairs}):
        name = f"current/{view}"
        history = {t: p for t, p in {**stored, **staged}.items() if t.startswith(_history(view, ""))}
        before = _read(spark, path, [stored[name]], _CURRENT) if name in stored else spark.createDataFrame([], _CURRENT)
        merged = _merge(before, rows.where(F.col("feature_view") == view), _read(spark, path, history.values(), _HISTORY))
        # Files cut by entity: a lookup of one entity opens one of them.
        ordered = merged.repartitionByRange("entity_id").sortWithinPartitions("entity_id")
        staged |= commits.stage({name: ordered}, path)
    commits.commit(spark, path, staged)


_HISTORY = ", ".join(f"{c} string" for c in COLUMNS)
_CURRENT = (
    "feature_view string, entity_id string, materialized_at string, features array<struct<attribute_name: string, "
    "attribute_value: string, feature_version: string, materialized_at: string>>"
)


def _history(view: str, version: str) -> str:
    return f"history/{view}/{version}"


def _read(spark: SparkSession, root: str, paths: Iterable[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*(f"{root}/{p}" for p in paths))


def _adopted(spark: SparkSession, path: str) -> dict[str, str]:
    """The store's record. A store that was written as partition folders, without a record, gets one first."""
    stored = commits.head(spark, path)[1]
    if stored:
        return stored
    try:
        plain = spark.read.schema(_HISTORY).parquet(path).select(*COLUMNS)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    write_features(materialize(plain, "plain-features"), f"{path}/{commits.VERSIONS}/adopted")
    inner = commits.head(spark, f"{path}/{commits.VERSIONS}/adopted")[1]
    commits.commit(spark, path, {name: f"{commits.VERSIONS}/adopted/{p}" for name, p in inner.items()})
    return commits.head(spark, path)[1]


def _merge(current: DataFrame, rows: DataFrame, history: DataFrame) -> DataFrame:
    """The current state after ``rows``; one exchange by (view, entity) serves both groupings.

    A new row replaces the current one of its version whatever its time. Where it is older than the
    one it replaces, another version may be the last now, which only the history knows: those
    attributes are taken from it.
    """
    key = ["feature_view", "entity_id", "attribute_name"]
    value = F.struct("materialized_at", "feature_version", "attribute_value")  # compared in this order
    before = current.select("feature_view", "entity_id", F.inline("features"))
    both = before.withColumn("fresh", F.lit(False)).unionByName(rows.withColumn("fresh", F.lit(True)))
    grouped = both.repartition("feature_view", "entity_id").groupBy(*key).agg(
        F.max(F.when(~F.col("fresh"), value)).alias("was"),
        F.max(F.when(F.col("fresh"), value)).alias("new"),
        F.collect_set(F.when(F.col("fresh"), F.col("feature_version"))).alias("versions"),
    )
    replaced = F.coalesce(F.array_contains("versions", F.col("was.feature_version")), F.lit(False))
    open_ = F.coalesce(replaced & (F.col("new.materialized_at") < F.col("was.materialized_at")), F.lit(False)).alias("open")
    judged = grouped.select(*key, F.greatest(F.when(~replaced, F.col("was")), "new").alias("v"), open_)
    settled = judged.where(~F.col("open")).select(*key, "v")
    unsettled = materialize(judged.where("open").select(*key), "unsettled-features")
    if not unsettled.isEmpty():
        again = history.join(unsettled, key, "left_semi").groupBy(*key).agg(F.max(value).alias("v"))
        settled = settled.unionByName(again)
    entry = F.struct("attribute_name", "v.attribute_value", "v.feature_version", "v.materialized_at")
    return settled.groupBy("feature_view", "entity_id").agg(
        F.max("v.materialized_at").alias("materialized_at"), F.array_sort(F.collect_list(entry)).alias("features")
    )


def read_features(spark: SparkSession, path: str) -> DataFrame | None:
    """The whole history, or None before the first write."""
    parts = [p for t, p in commits.head(spark, path)[1].items() if t.startswith("history/")]
    if parts:
        return _read(spark, path, parts, _HISTORY).select(*COLUMNS)
    try:
        return spark.read.schema(_HISTORY).parquet(path).select(*COLUMNS)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_version(spark: SparkSession, path: str, version: str, view: str | None = None, entity: str | None = None) -> DataFrame:
    """As ``lookup_version``, from the folders of that version alone."""
    named = {t: p for t, p in commits.head(spark, path)[1].items() if t.startswith("history/") and t.endswith(f"/{version}")}
    if view is not None:
        named = {t: p for t, p in named.items() if t == _history(view, version)}
    store = _read(spark, path, named.values(), _HISTORY) if named else spark.createDataFrame([], _HISTORY)
    return lookup_version(store, version, view, entity)


def read_current(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """(feature_view, entity_id, materialized_at, features): one row for each entity, with all its attributes' last values."""
    parts = [p for t, p in commits.head(spark, path)[1].items() if t.startswith("current/") and view in (None, t.removeprefix("current/"))]
    return _read(spark, path, parts, _CURRENT) if parts else spark.createDataFrame([], _CURRENT)


def latest(spark: SparkSession, path: str, view: str | None = None, entity: str | None = None) -> DataFrame:
    """Each entity's rows of its last materialisation, from the current state.

    Where one time has several versions of an attribute, the greatest counts.
    """
    rows = _narrow(read_current(spark, path, view), view, entity)
    last = F.filter("features", lambda f: f["materialized_at"] == F.col("materialized_at"))
    return rows.select("feature_view", "entity_id", F.inline(last)).select(*COLUMNS[:5])


def retrieve(spark: SparkSession, path: str, view: str, entity: str, version: str | None = None) -> DataFrame:
    """(attribute_name, attribute_value) of one entity, of its last materialisation or as of a named version."""
    rows = latest(spark, path, view, entity) if version is None else read_version(spark, path, version, view, entity)
    return rows.select("attribute_name", "attribute_value")


def lookup_version(store: DataFrame, version: str, view: str | None = None, entity: str | None = None) -> DataFrame:
    """(feature_view, entity_id, attribute_name, attribute_value) as of a named version."""
    rows = _narrow(store, view, entity).where(F.col("feature_version") == version)
    return rows.select(*COLUMNS[:4])


def lookup_latest(store: DataFrame, view: str | None = None, entity: str | None = None) -> DataFrame:
    """Each entity's rows of its last materialisation, whichever version that wrote, from any history.

    Every version's rows are ranked; ``latest`` reads the stored current state instead.
    """
    newest = Window.partitionBy("feature_view", "entity_id").orderBy(F.desc("materialized_at"))
    rows = _narrow(store, view, entity).withColumn("_age", F.rank().over(newest)).where("_age = 1")
    return rows.select(*COLUMNS[:5])


def wide_features(rows: DataFrame, view: FeatureView) -> DataFrame:
    """Looked-up rows of one view back to one row per entity."""
    names = [name for name, _ in view.features]
    return rows.groupBy("entity_id").pivot("attribute_name", names).agg(F.first("attribute_value"))


def registry(store: DataFrame, views: Iterable[FeatureView], spark: SparkSession) -> DataFrame:
    """One row per declared feature with its view's table, key and latest version; ``store`` may be the history or latest rows."""
    declared = spark.createDataFrame(
        [(v.name, v.description, v.source_table, v.join_key, f, t) for v in views for f, t in v.features],
        "feature_view string, description string, source_table string, join_key string, feature string, feature_type string",
    )
    latest = store.groupBy("feature_view").agg(
        F.max("materialized_at").alias("last_materialized_at"),
        F.max_by("feature_version", "materialized_at").alias("latest_version"),
    )
    return declared.join(latest, "feature_view", "left")


def _narrow(store: DataFrame, view: str | None, entity: str | None) -> DataFrame:
    if view is not None:
        store = store.where(F.col("feature_view") == view)
    if entity is not None:
        store = store.where(F.col("entity_id") == str(entity))
    return store
