"""Questions about ordered series: next higher value, runs, gaps, spans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.operators import scan as sc
from millrace.session import written

CHUNK_ROWS = 100_000


def _answer_chunks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Next greater value inside each chunk of rows that come sorted by
    (keys, chunk, place): rows wait on a stack until a greater one arrives."""
    chunk, waiting, top = None, [], None
    done: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * len(schema)
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema)]
        done.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            here, (place, v) = row[:-2], row[-2:]
            if here != chunk:
                done.extend((*chunk, *open_row, None) for open_row in waiting)
                chunk, waiting, top = here, [], None
            if v is None or v != v:  # a missing value answers nothing and is no answer
                done.append((*here, place, None, False, None))
                continue
            while waiting and waiting[-1][1] < v:
                done.append((*here, *waiting.pop(), place))
            waiting.append((place, v, top is None or v > top))
            top = v if top is None else max(top, v)
        yield flush()
    done.extend((*chunk, *open_row, None) for open_row in waiting)
    yield flush()


def _number(column: str, df: DataFrame) -> Column:
    """Neither null nor NaN."""
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    known = F.col(column).isNotNull()
    return known & ~F.isnan(column) if floating else known


def next_higher(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    chunk_rows: int = CHUNK_ROWS,
    hot_rows: int | None = None,
) -> DataFrame:
    """Adds ``place`` (row number in the key) and ``next_place``, the place of the
    first later row with a greater ``value`` (null if there is none).

    Rows are numbered and cut into chunks. A chunk answers most rows itself.
    For the others, maxima over 1, 2, 4, ... chunks tell which later chunk has
    the first greater value, and that chunk's rising maxima tell the place.
    No task ever holds more than a chunk, whatever the series looks like.
    """
    spark = df.sparkSession
    numbered = sc.scan(df, keys, order, hot_rows=hot_rows, place=sc.row_number())
    # stored once: rows with ties must keep their numbers. As a struct the key
    # joins with itself where it is null, too
    numbered = written(spark, numbered.withColumn("__k", F.struct(*keys)), "numbered")
    chunk = F.floor((F.col("place") - 1) / chunk_rows).alias("__chunk")
    # the value keeps its type: large integers and decimals compare exactly
    slim = numbered.select("__k", chunk, "place", F.col(value).alias("__v"))

    schema = T.StructType(
        [
            *slim.schema.fields,
            T.StructField("__rising", T.BooleanType()),
            T.StructField("next_place", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    sorted_chunks = slim.repartition("__k", "__chunk").sortWithinPartitions("__k", "__chunk", "place")
    answered = sorted_chunks.mapInArrow(lambda batches: _answer_chunks(batches, arrow), schema)
    local = written(spark, answered, "next-higher")
    chunks = local.agg(F.max("__chunk")).first()[0] or 0
    if chunks == 0:
        found = local.select("__k", "place", "next_place")
        return numbered.join(found, ["__k", "place"]).drop("__k")

    open_rows = local.where(F.col("next_place").isNull() & _number("__v", slim)).select(
        "__k", "place", "__v", (F.col("__chunk") + 1).alias("__at")
    )
    # maxima[j]: key, chunk -> maximum of the 2^j chunks from there on
    maxima = [
        written(
            spark,
            local.where(_number("__v", slim)).groupBy("__k", F.col("__chunk").alias("__at")).agg(F.max("__v").alias("__max")),
            "maxima",
        )
    ]
    while 2 ** len(maxima) <= chunks:
        low, half = maxima[-1], 2 ** (len(maxima) - 1)
        right = low.select("__k", (F.col("__at") - half).alias("__at"), F.col("__max").alias("__max2"))
        wider = low.join(right, ["__k", "__at"], "full").select(
            "__k", "__at", F.greatest("__max", "__max2").alias("__max")
        )
        maxima.append(written(spark, wider, "maxima"))
    for j in reversed(range(len(maxima))):
        step = (
            open_rows.join(maxima[j], ["__k", "__at"], "left")
            # a span without a greater value is skipped as a whole
            .withColumn("__at", F.when(F.col("__max") > F.col("__v"), F.col("__at")).otherwise(F.col("__at") + 2**j))
            .drop("__max")
        )
        open_rows = written(spark, step, "next-higher-step") if j % 4 == 0 else step
    # every open row now points at the chunk with its answer, if there is one
    rising = local.where("__rising").select(
        "__k", F.col("__chunk").alias("__at"), "__v", F.col("place").alias("__found")
    )
    # smallest rising maximum above the value = last seen when sorted by falling value
    both = rising.withColumn("__open", F.lit(0)).withColumn("place", F.lit(None).cast("long")).unionByName(
        open_rows.withColumn("__open", F.lit(1)).withColumn("__found", F.lit(None).cast("long"))
    )
    # equal values: open rows come first (descending order), a greater one is wanted
    seen = sc.scan(both, ["__k", "__at"], ["-__v", "-__open"], hot_rows=hot_rows, __hit=sc.last_known("__found"))
    crossed = seen.where("__open = 1").select("__k", "place", F.col("__hit").alias("__crossed"))
    found = (
        local.select("__k", "place", "next_place")
        .join(crossed, ["__k", "place"], "left")
        .withColumn("next_place", F.coalesce("next_place", "__crossed"))
        .drop("__crossed")
    )
    return numbered.join(found, ["__k", "place"]).drop("__k")


def runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    condition: Column,
    hot_rows: int | None = None,
) -> DataFrame:
    """Unbroken runs of rows where ``condition`` holds: keys, ``run``, ``length``.

    Rows of one run share the number of failing rows before them.
    """
    holds = F.coalesce(condition, F.lit(False))
    flagged = df.withColumn("__holds", holds)
    marked = sc.scan(
        flagged, keys, order, hot_rows=hot_rows, run=sc.running_sum((~F.col("__holds")).cast("long"))
    )
    return marked.where("__holds").groupBy(*keys, "run").agg(F.count(F.lit(1)).alias("length"))


def longest_run(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    condition: Column,
    hot_rows: int | None = None,
) -> DataFrame:
    """Longest run per key that has one."""
    return runs(df, keys, order, condition, hot_rows).groupBy(*keys).agg(F.max("length").alias("longest"))


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    time_ms: str,
    gap_ms: int,
    hot_rows: int | None = None,
) -> DataFrame:
    """Sessions split where ``gap_ms`` or more passes without a row."""
    rows = sc.Ordered(df, keys, [time_ms], hot_rows=hot_rows).add(__before=sc.previous(time_ms)).cut()
    opens = F.col("__before").isNull() | (F.col(time_ms) - F.col("__before") >= gap_ms)
    rows.add(__session=sc.running_sum(opens.cast("long"), peers=False))
    return (
        rows.frame()
        .groupBy(*keys, "__session")
        .agg(F.min(time_ms).alias("first_ms"), F.max(time_ms).alias("last_ms"), F.count(F.lit(1)).alias("rows"))
        .drop("__session")
    )


def id_gaps(ids: DataFrame, column: str, hot_rows: int | None = None) -> DataFrame:
    """Missing stretches between existing ids: ``after``, ``before``, ``missing``."""
    distinct = ids.select(column).where(F.col(column).isNotNull()).distinct()
    paired = sc.scan(distinct, [], [column], hot_rows=hot_rows, before=sc.following(column))
    missing = F.col("before") - F.col(column) - 1
    return paired.where(missing > 0).select(F.col(column).alias("after"), "before", missing.alias("missing"))


def id_repeats(ids: DataFrame, column: str) -> DataFrame:
    """Ids that occur more than once."""
    return ids.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def mode_span(df: DataFrame, keys: Sequence[str], value: str, position: str) -> DataFrame:
    """Most frequent value per key and the span of positions that holds it.

    Equal counts: the shorter span wins, then the smaller value. ``position``
    is a whole number.
    """
    per_value = df.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("rows"), F.min(position).alias("first"), F.max(position).alias("last")
    )
    best = F.min_by(
        F.struct(value, "rows", "first", "last"),
        F.struct(-F.col("rows"), F.col("last") - F.col("first"), F.col(value)),
    )
    return (
        per_value.groupBy(*keys)
        .agg(best.alias("__best"))
        .select(*keys, "__best.*")
        .withColumn("span", F.col("last") - F.col("first") + 1)
    )


def threshold_crossing(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str,
    limit: object,
    hot_rows: int | None = None,
) -> DataFrame:
    """First row per key whose running total reaches ``limit`` (amounts of either sign)."""
    running = sc.scan(df, keys, order, hot_rows=hot_rows, running_total=sc.running_sum(amount))
    first = F.min_by(F.struct(*[c for c in running.columns if c not in keys]), F.struct(*order))
    return (
        running.where(F.col("running_total") >= F.lit(limit))
        .groupBy(*keys)
        .agg(first.alias("__row"))
        .select(*keys, "__row.*")
    )
