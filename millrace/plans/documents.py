"""Keyed-document queries on customer, orders and an action log from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import keyed_docs as kd
from millrace.plans.registry import query
from millrace.sources.tables import load

_FIELDS = ["c_name", "c_acctbal", "c_mktsegment"]


def _customers(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", *_FIELDS)


def _table(spark, sf):
    """Customers with an even key, as first versions."""
    return kd.new_documents(_customers(spark, sf).where("c_custkey % 2 = 0"))


@query(
    "doc_create",
    """SELECT c_custkey, c_name, 'created' AS result FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 <> 0
       UNION ALL SELECT c_custkey, c_name, 'conflict' FROM customer WHERE c_custkey % 6 = 0
       UNION ALL SELECT c_custkey, c_name, 'kept' FROM customer WHERE c_custkey % 2 = 0""",
)
def doc_create(spark, sf):
    old = _table(spark, sf)
    new = _customers(spark, sf).where("c_custkey % 3 = 0")
    table, conflicts = kd.create(old, new, "c_custkey")
    kind = F.when(F.col("c_custkey") % 2 == 0, "kept").otherwise("created")
    return table.select("c_custkey", "c_name", kind.alias("result")).unionByName(
        conflicts.select("c_custkey", "c_name", F.lit("conflict").alias("result"))
    )


@query(
    "doc_index",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS c_name,
              CAST(CASE WHEN c_custkey % 6 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version
       FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0""",
)
def doc_index(spark, sf):
    new = _customers(spark, sf).where("c_custkey % 3 = 0").withColumn("c_name", F.upper("c_name"))
    return kd.index(_table(spark, sf), new, "c_custkey").select("c_custkey", "c_name", "version")


@query(
    "doc_partial_update",
    """SELECT c_custkey, c_name,
              CASE WHEN c_custkey % 4 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment,
              CAST(CASE WHEN c_custkey % 4 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version,
              CASE WHEN c_custkey % 4 = 0 THEN 'updated' WHEN c_custkey % 6 = 0 THEN 'noop' END AS result
       FROM customer WHERE c_custkey % 2 = 0""",
)
def doc_partial_update(spark, sf):
    customers = _customers(spark, sf)
    # each fourth moves to another segment, each sixth sends what is stored already
    segment = F.when(F.col("c_custkey") % 4 == 0, F.lit("MOVED")).otherwise(F.col("c_mktsegment"))
    changes = customers.where("c_custkey % 4 = 0 OR c_custkey % 6 = 0").select(
        "c_custkey", segment.alias("c_mktsegment"), F.lit(None).cast("string").alias("c_name")
    )
    return kd.partial_update(_table(spark, sf), changes, "c_custkey").select(
        "c_custkey", "c_name", "c_mktsegment", "version", "result"
    )


@query(
    "doc_cas_update",
    """SELECT c_custkey, CASE WHEN c_custkey % 8 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment,
              CAST(CASE WHEN c_custkey % 8 = 0 THEN 1 ELSE 0 END AS BIGINT) AS seq_no,
              CASE WHEN c_custkey % 8 = 0 THEN 'updated' WHEN c_custkey % 4 = 0 THEN 'conflict' END AS result
       FROM customer WHERE c_custkey % 2 = 0""",
)
def doc_cas_update(spark, sf):
    expected = F.when(F.col("c_custkey") % 8 == 0, 0).otherwise(7).cast("long")
    changes = (
        _customers(spark, sf)
        .where("c_custkey % 4 = 0")
        .select("c_custkey", F.lit("MOVED").alias("c_mktsegment"), expected.alias("seq_no"))
    )
    return kd.partial_update(_table(spark, sf), changes, "c_custkey", check=["seq_no"]).select(
        "c_custkey", "c_mktsegment", "seq_no", "result"
    )


@query(
    "doc_cas_retry",
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment,
              CAST(CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS seq_no
       FROM customer WHERE c_custkey % 2 = 0""",
)
def doc_cas_retry(spark, sf):
    """Conflicting updates are sent again with the version read back."""
    expected = F.when(F.col("c_custkey") % 8 == 0, 0).otherwise(7).cast("long")
    changes = (
        _customers(spark, sf)
        .where("c_custkey % 4 = 0")
        .select("c_custkey", F.lit("MOVED").alias("c_mktsegment"), expected.alias("seq_no"))
    )
    first = kd.partial_update(_table(spark, sf), changes, "c_custkey", check=["seq_no"])
    again = (
        changes.drop("seq_no")
        .join(first.where("result = 'conflict'").select("c_custkey", "seq_no"), "c_custkey")
        .select("c_custkey", "c_mktsegment", "seq_no")
    )
    return kd.partial_update(first.drop("result"), again, "c_custkey", check=["seq_no"]).select(
        "c_custkey", "c_mktsegment", "seq_no"
    )


@query(
    "doc_update_by_query",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment,
              'yes' AS checked, CAST(CASE WHEN c_acctbal < 0 THEN 3 ELSE 2 END AS BIGINT) AS version
       FROM customer WHERE c_custkey % 2 = 0""",
)
def doc_update_by_query(spark, sf):
    some = kd.update_where(_table(spark, sf), {"c_mktsegment": F.lit("DEBT")}, F.col("c_acctbal") < 0)
    every = kd.update_where(some, {"checked": F.lit("yes")})
    return every.select("c_custkey", "c_mktsegment", "checked", "version")


@query(
    "doc_exists",
    """SELECT DISTINCT l_orderkey + (CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE 100000000 END) AS o_orderkey, l_orderkey % 2 = 0 AS found
       FROM lineitem""",
)
def doc_exists(spark, sf):
    moved = F.when(F.col("l_orderkey") % 2 == 0, 0).otherwise(100_000_000).cast("long")
    ids = load(spark, sf, "lineitem").select((F.col("l_orderkey") + moved).alias("o_orderkey"))
    return kd.exists(load(spark, sf, "orders").select("o_orderkey"), ids, "o_orderkey")


@query(
    "doc_get",
    """SELECT c_custkey, c_name, version FROM (SELECT *, CAST(1 AS BIGINT) AS version FROM customer WHERE c_custkey % 2 = 0)
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
)
def doc_get(spark, sf):
    ids = load(spark, sf, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return kd.get(_table(spark, sf), ids, "c_custkey", ["c_acctbal", "c_mktsegment", "seq_no"])


@query(
    "doc_delete",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0
       AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
)
def doc_delete(spark, sf):
    ids = load(spark, sf, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return kd.delete_ids(_table(spark, sf), ids, "c_custkey").select("c_custkey", "c_name")


@query(
    "doc_delete_by_query",
    """SELECT c_custkey, c_mktsegment FROM customer
       WHERE c_custkey % 2 = 0 AND NOT coalesce(c_acctbal < 0 OR c_mktsegment = 'BUILDING', false)""",
)
def doc_delete_by_query(spark, sf):
    gone = (F.col("c_acctbal") < 0) | (F.col("c_mktsegment") == "BUILDING")
    return kd.delete_where(_table(spark, sf), gone).select("c_custkey", "c_mktsegment")


@query(
    "doc_reindex",
    """SELECT c_custkey, lower(c_name) AS name, CAST(2 AS BIGINT) AS kept, CAST(1 AS BIGINT) AS fresh
       FROM customer WHERE c_custkey % 2 = 0""",
)
def doc_reindex(spark, sf):
    table = kd.update_where(_table(spark, sf), {"c_name": F.lower("c_name")})
    layout = {"name": F.col("c_name")}
    kept = kd.reindex(table, layout, "c_custkey", keep_version=True).withColumnRenamed("version", "kept")
    fresh = kd.reindex(table, layout, "c_custkey", keep_version=False).select(
        "c_custkey", F.col("version").alias("fresh")
    )
    return kept.join(fresh, "c_custkey").select("c_custkey", "name", "kept", "fresh")


# Action log: signup = create, view = index, click = update of the value,
# purchase = update that repeats the kind, error = delete.
def _actions(spark, sf):
    kind = F.col("event_type")
    op = (
        F.when(kind == "signup", "create")
        .when(kind == "view", "index")
        .when(kind == "error", "delete")
        .otherwise("update")
    )
    writes_value = kind.isin("signup", "view", "click")
    writes_kind = kind.isin("signup", "view", "purchase")
    return load(spark, sf, "events").select(
        "user_id",
        "event_id",
        op.alias("op"),
        F.when(writes_value, F.col("value")).alias("value"),
        F.when(writes_kind, F.lit("shopper")).alias("kind"),
    )


_BULK_SQL = """WITH RECURSIVE log AS (
    SELECT user_id, event_id, event_type AS t, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
  run AS (
    SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST(-1 AS BIGINT) AS event_id, false AS alive, CAST(NULL AS DOUBLE) AS value,
           CAST(NULL AS VARCHAR) AS kind, CAST(0 AS BIGINT) AS version, CAST(NULL AS VARCHAR) AS result
    FROM (SELECT DISTINCT user_id FROM events)
    UNION ALL
    SELECT r.user_id, l.rn, l.event_id,
      CASE WHEN l.t IN ('signup', 'view') THEN true WHEN l.t = 'error' THEN false ELSE r.alive END,
      CASE WHEN l.t = 'view' OR (l.t = 'signup' AND NOT r.alive) THEN l.value WHEN l.t = 'error' THEN NULL
           WHEN l.t = 'click' AND r.alive THEN l.value ELSE r.value END,
      CASE WHEN l.t = 'view' OR (l.t = 'signup' AND NOT r.alive) THEN 'shopper' WHEN l.t = 'error' THEN NULL
           WHEN l.t = 'purchase' AND r.alive THEN 'shopper' ELSE r.kind END,
      r.version + CASE WHEN l.t = 'view' OR (l.t = 'signup' AND NOT r.alive) OR (l.t = 'error' AND r.alive)
                         OR (l.t = 'click' AND r.alive AND r.value IS DISTINCT FROM l.value) THEN 1 ELSE 0 END,
      CASE WHEN l.t = 'view' THEN CASE WHEN r.alive THEN 'updated' ELSE 'created' END
           WHEN l.t = 'signup' THEN CASE WHEN r.alive THEN 'conflict' ELSE 'created' END
           WHEN NOT r.alive THEN 'not_found' WHEN l.t = 'error' THEN 'deleted'
           WHEN l.t = 'click' AND r.value IS DISTINCT FROM l.value THEN 'updated' ELSE 'noop' END
    FROM run r JOIN log l ON l.user_id = r.user_id AND l.rn = r.rn + 1)"""


@query(
    "doc_bulk",
    _BULK_SQL + " SELECT event_id, user_id, result, version, value, kind FROM run WHERE rn > 0",
)
def doc_bulk(spark, sf):
    done = kd.bulk(_actions(spark, sf), "user_id", "event_id", "op", ["value", "kind"])
    return done.select("event_id", "user_id", "result", "version", "value", "kind")


@query(
    "doc_bulk_state",
    _BULK_SQL
    + """ SELECT user_id, version, value, kind FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) AS back FROM run) WHERE back = 1 AND alive""",
)
def doc_bulk_state(spark, sf):
    done = kd.bulk(_actions(spark, sf), "user_id", "event_id", "op", ["value", "kind"])
    return kd.state_after(done, "user_id", "event_id", "op").select("user_id", "version", "value", "kind")


@query(
    "tbl_merge",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN upper(c_name) ELSE c_name END AS c_name FROM customer
       WHERE c_custkey % 3 <> 0 AND (c_custkey % 2 = 0 OR c_custkey % 3 = 1)""",
)
def tbl_merge(spark, sf):
    """Even customers, merged with: key % 3 = 0 deleted, key % 3 = 1 renamed or added."""
    customers = _customers(spark, sf)
    changes = customers.where("c_custkey % 3 < 2").select(
        "c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_custkey") % 3 == 0).alias("gone")
    )
    return kd.merge(customers.where("c_custkey % 2 = 0"), changes, "c_custkey", "gone", ["c_name"])
