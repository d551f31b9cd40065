"""Document operations (create, index, update, delete, bulk) on keyed tables.

A table holds one row per id: the id, the document fields, ``version`` and
``seq_no``. Every operation is one join or one ordered scan over all requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import latest_per_key
from millrace.operators.scan import Ordered, last_known, running_sum
from millrace.session import written


def new_documents(df: DataFrame) -> DataFrame:
    """Rows as a table of first versions."""
    return df.withColumn("version", F.lit(1).cast("long")).withColumn("seq_no", F.lit(0).cast("long"))


def create(
    table: DataFrame, new: DataFrame, key: str, seq: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Add documents whose id is free; the others come back as conflicts.

    Of several requests for one free id the first gets in: the one with the
    smallest ``seq``, or without it the one read first.
    """
    numbered = written(
        new.sparkSession, new.withColumn("__row", F.monotonically_increasing_id()), "requests"
    )
    order = F.struct(*([seq] if seq else []), "__row")
    first = numbered.groupBy(key).agg(F.min_by("__row", order).alias("__row"))
    winners = first.join(table.select(key), key, "left_anti").select("__row")
    added = numbered.join(winners, "__row", "left_semi").drop("__row")
    conflicts = numbered.join(winners, "__row", "left_anti").drop("__row")
    return table.unionByName(new_documents(added)), conflicts


def _newest(changes: DataFrame, key: str, seq: str | None) -> DataFrame:
    """One row per id: with ``seq`` the newest, else the rows as they are."""
    return changes if seq is None else latest_per_key(changes, [key], [seq]).drop(seq)


def index(table: DataFrame, new: DataFrame, key: str, seq: str | None = None) -> DataFrame:
    """Insert or overwrite whole documents. ``new`` has one row per id, or a
    column ``seq``: then the newest row of an id counts."""
    new = _newest(new, key, seq)
    fields = [c for c in new.columns if c != key]
    old = table.select(key, *[F.col(c).alias(f"__old_{c}") for c in fields], "version", "seq_no")
    both = old.join(new.withColumn("__new", F.lit(True)), key, "full")
    fresh = F.col("__new").isNotNull()
    return both.select(
        key,
        *[F.when(fresh, F.col(c)).otherwise(F.col(f"__old_{c}")).alias(c) for c in fields],
        (F.coalesce("version", F.lit(0)) + fresh.cast("long")).alias("version"),
        F.when(F.col("seq_no").isNull(), 0)
        .otherwise(F.col("seq_no") + fresh.cast("long"))
        .cast("long")
        .alias("seq_no"),
    )


def partial_update(
    table: DataFrame, changes: DataFrame, key: str, check: Sequence[str] = (), seq: str | None = None
) -> DataFrame:
    """Merge the given (non-null) fields into existing documents.

    ``changes`` has one row per id, or a column ``seq``: then the newest row of
    an id counts. Result: the new table plus ``result``, one
    of ``updated``, ``noop`` (nothing differs), ``conflict`` or null (not asked
    for). ``check`` names version columns that ``changes`` also carries, for
    instance ``seq_no``: where they differ the document stays as it is.
    """
    changes = _newest(changes, key, seq)
    fields = [c for c in changes.columns if c != key and c not in check]
    asked = changes.select(
        key,
        *[F.col(c).alias(f"__new_{c}") for c in fields],
        *[F.col(c).alias(f"__if_{c}") for c in check],
        F.lit(True).alias("__asked"),
    )
    differs = F.lit(False)
    for c in fields:
        differs = differs | (F.col(f"__new_{c}").isNotNull() & ~F.col(f"__new_{c}").eqNullSafe(F.col(c)))
    stale = F.lit(False)
    for c in check:
        stale = stale | ~F.col(f"__if_{c}").eqNullSafe(F.col(c))
    result = (
        F.when(F.col("__asked").isNull(), None)
        .when(stale, F.lit("conflict"))
        .when(differs, F.lit("updated"))
        .otherwise(F.lit("noop"))
    )
    done = F.coalesce(F.col("result") == "updated", F.lit(False))
    merged = table.join(asked, key, "left").withColumn("result", result)
    merged = merged.withColumns(
        {c: F.when(done, F.coalesce(f"__new_{c}", c)).otherwise(F.col(c)) for c in fields}
    )
    return merged.withColumns(
        {c: F.col(c) + done.cast("long") for c in ("version", "seq_no")}
    ).select(*table.columns, "result")


def missing(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Requests for ids the table does not have."""
    return changes.join(table.select(key), key, "left_anti")


def update_where(
    table: DataFrame, assignments: dict[str, Column], predicate: Column | None = None
) -> DataFrame:
    """Set fields on all matching documents, reading one snapshot.

    Without a predicate every document matches, which adds new fields too.
    """
    hit = F.lit(True) if predicate is None else F.coalesce(predicate, F.lit(False))
    snapshot = table.withColumn("__hit", hit)
    new = {}
    for name, value in assignments.items():
        old = F.col(name) if name in table.columns else F.lit(None)
        new[name] = F.when(F.col("__hit"), value).otherwise(old)
    new["version"] = F.col("version") + F.col("__hit").cast("long")
    new["seq_no"] = F.col("seq_no") + F.col("__hit").cast("long")
    return snapshot.withColumns(new).drop("__hit")


def get(table: DataFrame, ids: DataFrame, key: str, leave_out: Sequence[str] = ()) -> DataFrame:
    """Documents of the listed ids without the named fields."""
    return table.join(ids.select(key), key, "left_semi").drop(*leave_out)


def exists(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Each asked id (once) with a flag ``found``."""
    known = table.select(key, F.lit(True).alias("found"))
    return (
        ids.select(key).distinct().join(known, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))
    )


def delete_ids(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return table.join(ids.select(key), key, "left_anti")


def delete_where(table: DataFrame, predicate: Column) -> DataFrame:
    """Drop matching documents; an unknown (null) answer keeps the document."""
    return table.where(~F.coalesce(predicate, F.lit(False)))


def reindex(table: DataFrame, fields: dict[str, Column], key: str, keep_version: bool) -> DataFrame:
    """Copy documents with their ids under a new field layout."""
    version = F.col("version") if keep_version else F.lit(1).cast("long")
    return table.select(
        key, *[c.alias(n) for n, c in fields.items()], version.alias("version"), F.lit(0).cast("long").alias("seq_no")
    )


def merge(
    table: DataFrame,
    changes: DataFrame,
    key: str,
    deleted: str,
    fields: Sequence[str],
    seq: str | None = None,
) -> DataFrame:
    """Merge into: matched rows are updated or (flag ``deleted``) dropped, new ids
    added. ``changes`` has one row per id, or a column ``seq`` (newest counts)."""
    changes = _newest(changes, key, seq)
    old = table.select(key, *[F.col(c).alias(f"__old_{c}") for c in fields], F.lit(True).alias("__had"))
    both = old.join(changes.withColumn("__asked", F.lit(True)), key, "full")
    asked = F.col("__asked").isNotNull()
    return both.where(~(asked & F.coalesce(deleted, F.lit(False)))).select(
        key, *[F.when(asked, F.col(c)).otherwise(F.col(f"__old_{c}")).alias(c) for c in fields]
    )


def bulk(
    actions: DataFrame,
    key: str,
    seq: str,
    op: str,
    fields: Sequence[str],
    table: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Apply an ordered log of index / create / update / delete actions.

    Returns the log with, per action, ``result`` and the ``version`` after it:
    ``created``, ``updated``, ``deleted``, ``noop`` (update changes nothing),
    ``conflict`` (create of an existing id) or ``not_found`` (update or delete
    of an absent one). The fields come back as they are after the action, and
    ``alive`` tells whether the document exists then. ``seq`` is unique.

    Whether a document exists depends only on the last index, create or delete
    before it, a field only on its last assignment, the version only on how
    many changes came before: three scans, no per-id loop, any number of
    actions per id.
    """
    log = actions.select(key, seq, op, *fields)
    if table is not None:
        # documents already there act as loads before the first action
        log = log.unionByName(
            table.select(
                key, F.lit(None).cast(actions.schema[seq].dataType).alias(seq), F.lit("load").alias(op), *fields
            )
        )
    what = F.col(op)
    rows = Ordered(log, [key], [seq], hot_rows=hot_rows)
    presence = F.when(what.isin("index", "create", "load"), 1).when(what == "delete", 0)
    rows.add(__was=last_known(presence, before=True)).cut()

    was = F.coalesce(F.col("__was") == 1, F.lit(False))
    overwrite = what.isin("index", "load") | ((what == "create") & ~was)
    assigned = {}
    for f in fields:
        assigned[f"__before_{f}"] = last_known(
            F.when(overwrite, F.struct(F.col(f).alias("v")))
            .when((what == "delete") & was, F.struct(F.lit(None).cast(log.schema[f].dataType).alias("v")))
            .when((what == "update") & was & F.col(f).isNotNull(), F.struct(F.col(f).alias("v"))),
            before=True,
        )
    rows.add(**assigned).cut()

    differs = F.lit(False)
    for f in fields:
        differs = differs | (F.col(f).isNotNull() & ~F.col(f).eqNullSafe(F.col(f"__before_{f}.v")))
    result = (
        F.when(what == "load", F.lit("load"))
        .when(what == "index", F.when(was, F.lit("updated")).otherwise(F.lit("created")))
        .when(what == "create", F.when(was, F.lit("conflict")).otherwise(F.lit("created")))
        .when(~was, F.lit("not_found"))
        .when(what == "delete", F.lit("deleted"))
        .when(differs, F.lit("updated"))
        .otherwise(F.lit("noop"))
    )
    changed = result.isin("load", "created", "updated", "deleted").cast("long")
    rows.add(version=running_sum(changed))

    alive = F.when(what.isin("index", "create", "load"), F.lit(True)).when(what == "delete", F.lit(False))
    after = {
        f: F.when(overwrite, F.col(f))
        .when(what == "delete", F.lit(None))
        .when((what == "update") & was, F.coalesce(F.col(f), F.col(f"__before_{f}.v")))
        .otherwise(F.col(f"__before_{f}.v"))
        for f in fields
    }
    return rows.frame().select(
        key,
        seq,
        op,
        *[c.alias(f) for f, c in after.items()],
        result.alias("result"),
        "version",
        F.coalesce(alive, was).alias("alive"),
    )


def state_after(results: DataFrame, key: str, seq: str, op: str) -> DataFrame:
    """Table after a bulk run: the newest result row per id that is alive."""
    rest = [c for c in results.columns if c not in (key, op)]
    return (
        results.groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(seq)).alias("__row"))
        .where("__row.alive")
        .select(key, "__row.*")
        .drop(seq, "alive", "result")
    )
