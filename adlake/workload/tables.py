"""Keyed operators: merges, differences, enrichment, checks, projections."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.operators.dedupe import drop_seen, duplicate_keys, latest
from adlake.operators.diff import changed_rows, hydrate, next_state, with_fingerprint
from adlake.operators.merge import apply_backfill, children_of, enrich, merge_upsert, missing_keys
from adlake.operators.project import (
    child_table,
    exclude_entities,
    exclude_value,
    filter_status,
    json_to_string,
    recent,
    select_fields,
    tag,
    union_rows,
)
from adlake.operators.quality import BACKFILL_FIELDS, backfill_stats, backfill_verdict, completeness, old_column_checksum
from adlake.operators.incremental import max_cursor
from adlake.operators.sinks import shared_dir, stage_backfill
from adlake.plans import exports
from adlake.sources.files import json_page_items
from adlake.sources.tables import combine_entities
from adlake.workload.registry import money, props_k, query, table, PROPS_K_SQL


def _day_rows(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    events = table(spark, sf_dir, "events").filter(F.col("event_type") == kind)
    return events.select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "event_type", props_k().alias("k")
    )


_DAY_ROWS_SQL = f"""
    d AS (
      SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, event_type, {PROPS_K_SQL} AS k FROM events
    ),
    last AS (
      SELECT user_id, day, event_type, max(event_id) AS event_id, arg_max(k, event_id) AS k
      FROM d GROUP BY user_id, day, event_type
    )
"""


@query(
    "merge_upsert",
    f"""
    WITH {_DAY_ROWS_SQL}
    SELECT * FROM last WHERE event_type = 'purchase'
    UNION ALL
    SELECT v.* FROM last v WHERE event_type = 'view' AND NOT EXISTS (
      SELECT 1 FROM last p WHERE p.event_type = 'purchase' AND p.user_id = v.user_id AND p.day = v.day)
    """,
)
def merge_upsert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last view of a user's day, replaced by the last purchase where there is one."""
    keys = ["user_id", "day"]
    stored = latest(_day_rows(spark, sf_dir, "view"), keys, ["event_id"])
    return merge_upsert(stored, _day_rows(spark, sf_dir, "purchase"), keys, ["event_id"])


@query(
    "first_wins",
    """
    SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type,
           arg_min(value, event_id) AS value
    FROM events GROUP BY user_id
    """,
)
def first_wins_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return drop_seen(events, "user_id", ["event_id"])


@query(
    "latest_version",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS status,
           CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS version
    FROM orders
    """,
)
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    old = orders.withColumn("version", F.lit(1))
    new = orders.filter(F.col("status") == "F").select("o_orderkey", F.lit("X").alias("status"), F.lit(2).alias("version"))
    return latest(old.unionByName(new), ["o_orderkey"], ["version"])


@query(
    "max_cursor",
    "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_value FROM events",
)
def max_cursor_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = max_cursor(table(spark, sf_dir, "events"), "ts")
    return last.select(F.date_format("last_value", "yyyy-MM-dd HH:mm:ss").alias("last_value"))


@query(
    "unique_check",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
)
def unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _light(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("account_id"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("effective_object_story_id"),
    )


def _stored_prints(light: DataFrame) -> DataFrame:
    """State of an earlier snapshot: low-priority rows were not there, urgent ones differed."""
    old = light.filter(F.col("name") != "5-LOW").withColumn(
        "status", F.when(F.col("name") == "1-URGENT", F.lit("X")).otherwise(F.col("status"))
    )
    return with_fingerprint(old).select("account_id", "id", "fingerprint")


@query(
    "changed_rows",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS account_id, CAST(o_orderkey AS VARCHAR) AS id,
           o_orderpriority AS name, o_orderstatus AS status
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
    """,
)
def changed_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    light = _light(spark, sf_dir)
    changed = changed_rows(light, _stored_prints(light), ["account_id", "id"])
    return changed.select("account_id", "id", "name", "status")


_PRINT_SQL = """
    sha256('{"effective_object_story_id":' || CASE WHEN o_orderstatus <> 'P' THEN '"' || o_orderpriority || '"' ELSE 'null' END
           || ',"id":"' || o_orderkey || '","name":"' || o_orderpriority || '","status":"' || o_orderstatus || '"}')
"""


@query(
    "snapshot_state",
    f"""
    SELECT CAST(o_custkey AS VARCHAR) AS account_id, CAST(o_orderkey AS VARCHAR) AS id, {_PRINT_SQL} AS fingerprint
    FROM orders
    """,
)
def snapshot_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after the changed rows were stored: the prints of the snapshot, row for row."""
    light, keys = _light(spark, sf_dir), ["account_id", "id"]
    state = _stored_prints(light)
    return next_state(state, changed_rows(light, state, keys), keys)


@query(
    "hydrate_changed",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS account_id, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS name,
           o_orderstatus AS status, o_totalprice AS price, strftime(o_orderdate, '%Y-%m-%d') AS day
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
    """,
)
def hydrate_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide attributes fetched for the changed rows only."""
    light = _light(spark, sf_dir)
    heavy = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_totalprice").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    changed = changed_rows(light, _stored_prints(light), ["account_id", "id"])
    return hydrate(changed, heavy, "id").select("account_id", "id", "name", "status", "price", "day")


@query(
    "enrich",
    """
    SELECT l_orderkey, l_partkey, coalesce(p_brand, l_returnflag) AS l_returnflag, p_name,
           coalesce(p_size, -1) AS p_size
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') ON p_partkey = l_partkey
    """,
)
def enrich_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    parts = table(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("l_returnflag"), "p_name", "p_size"
    )
    return enrich(items, parts, "l_partkey").withColumn("p_size", F.coalesce("p_size", F.lit(-1)))


_HALF_HOT_SQL = "CASE WHEN l_linenumber < 4 THEN 1 ELSE l_partkey END AS l_partkey"


@query(
    "enrich_hot",
    f"""
    WITH items AS (SELECT l_orderkey, {_HALF_HOT_SQL}, l_returnflag FROM lineitem)
    SELECT l_orderkey, l_partkey, coalesce(p_brand, l_returnflag) AS l_returnflag, p_name
    FROM items LEFT JOIN part ON p_partkey = l_partkey
    """,
)
def enrich_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One id in about half of the rows, dealt over many tasks."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", F.expr(_HALF_HOT_SQL.removesuffix(" AS l_partkey")).alias("l_partkey"), "l_returnflag")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("l_returnflag"), "p_name")
    return enrich(items, parts, "l_partkey", hot_share=0.01)


@query(
    "leads_of_ads",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')
    """,
)
def leads_of_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ads = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return children_of(leads, ads, "o_custkey", "c_custkey")


@query(
    "missing_keys",
    """
    SELECT o_orderkey AS id, 'missing' AS side FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL
    SELECT DISTINCT l_orderkey, 'extra' FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    """,
)
def missing_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    missing, _ = missing_keys(orders, items, "id")
    _, extra = missing_keys(orders.filter(F.col("o_orderstatus") != "P"), items, "id")
    return missing.withColumn("side", F.lit("missing")).unionByName(extra.distinct().withColumn("side", F.lit("extra")))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New order columns computed from the items; an order without items has none."""
    items = table(spark, sf_dir, "lineitem")
    n = F.count(F.lit(1))
    per_order = items.groupBy(F.col("l_orderkey").cast("string").alias("id")).agg(
        F.sum(money("l_extendedprice")).cast("decimal(10,2)").alias("subtotal_eur"),
        F.when(F.max("l_returnflag") != "A", F.sum(money("l_quantity")))
        .cast("decimal(10,2)")
        .alias("profit_eur"),
        n.alias("item_count"),
        F.count_distinct("l_partkey").alias("distinct_plan_count"),
        F.when(n < 9, n > 1).alias("is_cart"),
    )
    return per_order.select(*BACKFILL_FIELDS)


_STAGED_SQL = """
    s AS (
      SELECT CAST(l_orderkey AS VARCHAR) AS id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS subtotal_eur,
             CASE WHEN max(l_returnflag) <> 'A' THEN sum(CAST(l_quantity AS DECIMAL(18,2))) END AS profit_eur,
             count(*) AS item_count, count(DISTINCT l_partkey) AS distinct_plan_count,
             CASE WHEN count(*) < 9 THEN count(*) > 1 END AS is_cart
      FROM lineitem GROUP BY l_orderkey
    )
"""


@query(
    "backfill_validate",
    f"""
    WITH {_STAGED_SQL}
    SELECT (SELECT count(*) FROM s) AS row_count, (SELECT count(DISTINCT id) FROM s) AS unique_id_count,
           (SELECT count(*) FROM s WHERE subtotal_eur IS NULL) AS null_subtotal_count,
           (SELECT count(*) FROM s WHERE item_count IS NULL) AS null_item_count,
           (SELECT count(*) FROM s WHERE distinct_plan_count IS NULL) AS null_distinct_plan_count,
           (SELECT count(*) FROM s WHERE is_cart IS NULL) AS null_is_cart_count,
           (SELECT count(*) FROM s WHERE profit_eur IS NULL AND item_count > 0) AS unexpected_null_profit_count,
           (SELECT count(*) FROM orders WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT id FROM s))
             AS missing_from_staging,
           (SELECT count(*) FROM s WHERE id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders
             WHERE o_orderstatus = 'F') AND id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders
             WHERE o_orderstatus <> 'F')) AS extra_in_staging
    """,
)
def backfill_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    return backfill_stats(_staged(spark, sf_dir), orders)


_FILLED = {
    "subtotal_eur": "CAST(coalesce(s.subtotal_eur, -1) AS DOUBLE)",
    "profit_eur": "CAST(coalesce(s.profit_eur, -1) AS DOUBLE)",
    "item_count": "coalesce(s.item_count, -1)",
    "distinct_plan_count": "coalesce(s.distinct_plan_count, -1)",
}


@query(
    "apply_backfill",
    f"""
    WITH {_STAGED_SQL}
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice, {", ".join(f"{e} AS {n}" for n, e in _FILLED.items())}
    FROM orders LEFT JOIN s ON s.id = CAST(o_orderkey AS VARCHAR)
    """,
)
def apply_backfill_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), "o_totalprice")
    filled = apply_backfill(base, _staged(spark, sf_dir), "id", BACKFILL_FIELDS[1:])
    eur = [F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in ("subtotal_eur", "profit_eur")]
    counts = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("item_count", "distinct_plan_count")]
    return filled.select("id", "o_totalprice", *eur, *counts)


@query(
    "stage_backfill",
    f"""
    WITH {_STAGED_SQL}
    SELECT id, CAST(subtotal_eur AS DOUBLE) AS subtotal_eur, CAST(coalesce(profit_eur, -1) AS DOUBLE) AS profit_eur,
           item_count, distinct_plan_count, coalesce(CAST(is_cart AS INTEGER), -1) AS is_cart FROM s
    """,
)
def stage_backfill_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged fields alone, checked and written to a table of their own, from rows that have more."""
    wide = _staged(spark, sf_dir).withColumn("unasked", F.lit("x"))
    staged = stage_backfill(wide, BACKFILL_FIELDS, "id", shared_dir(spark))
    return staged.select(
        "id",
        F.col("subtotal_eur").cast("double").alias("subtotal_eur"),
        F.coalesce(F.col("profit_eur").cast("double"), F.lit(-1.0)).alias("profit_eur"),
        "item_count",
        "distinct_plan_count",
        F.coalesce(F.col("is_cart").cast("int"), F.lit(-1)).alias("is_cart"),
    )


@query(
    "backfill_verdict",
    f"""
    WITH {_STAGED_SQL},
    n AS (SELECT (SELECT count(*) FROM s) AS found, (SELECT count(*) FROM s WHERE profit_eur IS NULL) AS no_profit,
                 (SELECT count(*) FROM s WHERE is_cart IS NULL) AS no_cart)
    SELECT 'whole' AS case_name, CASE WHEN no_profit = 0 AND no_cart = 0 THEN 'accepted' ELSE 'rejected' END AS verdict FROM n
    UNION ALL SELECT 'filled', 'accepted' FROM n
    UNION ALL SELECT 'short', 'rejected' FROM n
    """,
)
def backfill_verdict_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict over the staged rows as they are, with their gaps filled, and with one row too few expected."""
    staged = _staged(spark, sf_dir)
    filled = staged.withColumns({"profit_eur": F.coalesce("profit_eur", F.lit(0)), "is_cart": F.coalesce("is_cart", F.lit(True))})
    found = []
    for name, rows, extra in (("whole", staged, 0), ("filled", filled, 0), ("short", filled, 1)):
        stats = backfill_stats(rows, rows.select("id")).first().asDict()
        try:
            backfill_verdict(stats, stats["row_count"] + extra)
            found.append((name, "accepted"))
        except ValueError:
            found.append((name, "rejected"))
    return spark.createDataFrame(found, "case_name string, verdict string")


_OLD = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(
    "backfill_checksum",
    f"""
    WITH {_STAGED_SQL}
    SELECT (SELECT count(*) FROM orders) AS n_rows, CAST(1 AS BIGINT) AS n_equal,
           CASE WHEN (SELECT count(*) FROM orders) > 0 THEN CAST(0 AS BIGINT) END AS n_equal_changed
    """,
)
def backfill_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old columns have one checksum before and after the backfill, and another one after a change of any row."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), *_OLD)
    filled = apply_backfill(orders, _staged(spark, sf_dir), "id", BACKFILL_FIELDS[1:])
    first = orders.agg(F.min("o_orderkey").alias("k"))
    changed = orders.join(F.broadcast(first), orders.o_orderkey == first.k, "left").withColumn(
        "o_totalprice", F.when(F.col("k").isNotNull(), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    before, after, other = (old_column_checksum(x, _OLD).first() for x in (orders, filled, changed))
    row = (before.n_rows, int(before == after), int(before == other))
    return spark.createDataFrame([row], "n_rows bigint, n_equal bigint, n_equal_changed bigint")


@query(
    "completeness",
    """
    WITH gaps AS (
      SELECT c_mktsegment AS resource, CAST(c_nationkey AS VARCHAR) AS entity FROM customer
      EXCEPT
      SELECT c_mktsegment, CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_acctbal > 9500
    )
    SELECT resource, count(*) AS n_missing, array_to_string(list(entity ORDER BY entity), ',') AS entities FROM gaps GROUP BY resource
    """,
)
def completeness_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("resource"),
        F.col("c_nationkey").cast("string").alias("entity"),
        (F.col("c_acctbal") > 9500).alias("complete"),
    )
    gaps = completeness(landed, landed, shown=None)
    return gaps.select("resource", "n_missing", F.array_join("entities", ",").alias("entities"))


@query(
    "union_rows",
    """
    SELECT n_name AS name, CAST(n_regionkey AS VARCHAR) AS parent, 'nation' AS entity FROM nation
    UNION ALL SELECT r_name, NULL, 'region' FROM region
    UNION ALL SELECT c_name, NULL, 'customer' FROM customer
    """,
)
def union_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("parent")
    )
    regions = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    labelled = combine_entities({"nation": nations, "region": regions})
    return union_rows([labelled, tag(customers, entity="customer")])


_STATES = ("F", "O")


@query(
    "project_filter",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority, 'g1' AS managing_system, 'act' AS account_id
    FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW'
      AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    """,
)
def project_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filter_status(table(spark, sf_dir, "orders"), _STATES, "o_orderstatus")
    kept = exclude_value(kept, "o_orderpriority", "5-LOW")
    overdrawn = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select("c_custkey")
    kept = exclude_entities(kept, "o_custkey", overdrawn)
    fields = select_fields(kept, ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return tag(fields, managing_system="g1", account_id="act")


@query(
    "recent_changes",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS change_date_time FROM orders
    WHERE o_orderdate >= DATE '2001-07-01' AND o_orderdate < DATE '2001-07-15'
    ORDER BY o_orderdate, o_orderkey LIMIT 1000
    """,
)
def recent_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the last 14 days, at most 1000 of them as the report has it."""
    orders, order = table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"]
    return recent(orders, "o_orderdate", 14, dt.date(2001, 7, 15), limit=1000, order_by=order).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("change_date_time")
    )


@query(
    "conform",
    """
    SELECT o_orderkey AS id, o_totalprice AS subtotal_eur, round(o_totalprice * 0, 2) AS profit_eur,
           o_custkey AS item_count, CAST(-1 AS BIGINT) AS distinct_plan_count,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_cart, o_orderpriority AS note
    FROM orders
    """,
)
def conform_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text order rows under the pinned types; a column that is not there yet is added as NULL."""
    text = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").cast("string").alias("subtotal_eur"),
        F.lit("0.00").alias("profit_eur"),
        F.col("o_custkey").cast("string").alias("item_count"),
        (F.col("o_orderstatus") == "F").cast("string").alias("is_cart"),
        F.col("o_orderpriority").alias("note"),
    )
    typed = exports.order_rows(text)
    return typed.select(
        "id",
        F.col("subtotal_eur").cast("double").alias("subtotal_eur"),
        F.col("profit_eur").cast("double").alias("profit_eur"),
        "item_count",
        F.coalesce("distinct_plan_count", F.lit(-1)).cast("bigint").alias("distinct_plan_count"),
        F.col("is_cart").cast("int").alias("is_cart"),
        "note",
    )


@query(
    "child_rows",
    """
    SELECT p_partkey, CAST(i - 1 AS INTEGER) AS list_idx, string_split(p_name, ' ')[i] AS value
    FROM part, unnest(generate_series(1, len(string_split(p_name, ' ')))) AS t(i)
    """,
)
def child_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return child_table(parts, ["p_partkey"], "words")


@query(
    "json_items",
    """
    SELECT o_orderkey AS id, CAST(i AS INTEGER) AS n, o_orderpriority AS label
    FROM orders, unnest(generate_series(1, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END)) AS t(i)
    """,
)
def json_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of an export API: rows sit in a list; a page may be empty."""

    def item(n: int):
        return F.struct(F.col("o_orderkey").alias("id"), F.lit(n).alias("n"), F.col("o_orderpriority").alias("label"))

    status = F.col("o_orderstatus")
    rows = F.when(status == "F", F.array(item(1), item(2))).when(status == "O", F.array(item(1))).otherwise(
        F.array().cast("array<struct<id:bigint,n:int,label:string>>")
    )
    pages = table(spark, sf_dir, "orders").select(
        F.to_json(F.struct(rows.alias("items"), F.lit("next").alias("cursor"))).alias("body")
    )
    schema = "items array<struct<id:bigint,n:int,label:string>>"
    return json_page_items(pages.select(F.from_json("body", schema).alias("p")).select("p.*"))


@query(
    "json_column",
    """
    SELECT o_orderkey,
           '{"status":"' || o_orderstatus || '","cust":' || CAST(o_custkey AS VARCHAR) || '}' AS map_json
    FROM orders
    """,
)
def json_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust")).alias("map_json"),
    )
    return json_to_string(rows, ["map_json", "absent"])
