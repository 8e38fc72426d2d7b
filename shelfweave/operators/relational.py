"""Relational building blocks the document jobs share."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of declared rows as a local relation, without Python workers at run time."""
    struct = T._parse_datatype_string(schema)
    table = pa.Table.from_pylist([dict(zip(struct.fieldNames(), r)) for r in rows], schema=to_arrow_schema(struct))
    return spark.createDataFrame(table, schema=struct)


def spread_rows(frame: DataFrame) -> DataFrame:
    """The frame over at least as many partitions as there are cores.

    Only an input with fewer splits than cores is moved, such as a single small file; large inputs
    have more splits than that and stay where they are.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame


def spread(rows: DataFrame, dimension: DataFrame, block_rows: int = 1_000, lanes: int = 32) -> DataFrame:
    """Every row once per row of a dimension (languages, shops) of any size.

    The dimension is dealt into blocks of about ``block_rows`` by hash, every row goes to each block once, and both meet in an equi-join on block
    and lane. Languages and shops are one block, which the planner sends to the tasks by its size, so the rows do not move; of a dimension too
    large for that, each block and lane is a task's own share.
    """
    blocks = dimension.agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.lit(1)).cast("int").alias("n")).scalar()
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    # Numbers tell rows apart at less cost than texts; nested values cannot all be hashed.
    keys = [c for c, kind in kinds.items() if isinstance(kind, T.NumericType)] or [c for c, kind in kinds.items() if isinstance(kind, T.StringType)]
    lane = F.pmod(F.xxhash64(*keys), F.lit(lanes)).cast("int") if keys else F.lit(0)
    dealt = rows.select("*", lane.alias("_lane"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_block"))
    block = F.pmod(F.xxhash64(*dimension.columns), blocks).cast("int")
    copied = dimension.select("*", block.alias("_block"), F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("_lane"))
    return dealt.join(copied, ["_block", "_lane"]).select(*rows.columns, *dimension.columns)


def hot_keys(rows: DataFrame, keys: Sequence[str], tracked: int = 4096, listed: int = 512) -> Column:
    """Hashes of the keys that hold more rows than an even share of a partition, as one array value (empty for few rows).

    Found by a mergeable frequency sketch: every task keeps ``tracked`` counters at most, and an estimate is off by no more than a ``tracked``-th of the
    rows or so. Keys above an even share of the shuffle partitions are fewer than there are partitions.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = rows.select(F.xxhash64(*keys).alias("_h")).agg(F.expr(f"approx_top_k(_h, {listed}, {tracked})").alias("_top"), F.count(F.lit(1)).alias("_n"))
    return counted.select(F.expr(f"transform(filter(_top, x -> x.count * {parts} > _n), x -> x.item)").alias("hot")).scalar()


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", hot: Column | None = None, splits: int | None = None,
               by: Sequence[str] = ()) -> DataFrame:
    """An equi-join that deals the left rows of hot keys out over ``splits`` tasks, to each of which the right rows of those keys are copied.

    Only hot keys (``hot_keys`` of the left side unless given) are dealt and copied; all others are joined as ever. The right side should have few
    rows a key. ``how`` may be any kind that keeps left rows (inner, left, left_semi, left_anti). With ``by`` rows are dealt by the hash of these columns instead
    of all, and the join runs in ``splits`` tasks, however few bytes they read.
    """
    n = splits or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(left, keys) if hot is None else hot
    key = F.xxhash64(*keys)
    lane = F.when(F.array_contains(hot, key), F.pmod(F.hash(*(by or left.columns), F.lit("lane")), F.lit(n))).otherwise(F.lit(0))
    lanes = F.when(F.array_contains(hot, key), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.withColumn("_lane", lane)
    if by:
        dealt = dealt.repartition(n, *keys, "_lane")
    return dealt.join(right.withColumn("_lane", F.explode(lanes)), [*keys, "_lane"], how).drop("_lane")


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], keep_last: bool = False) -> DataFrame:
    """The first (or last) row of each key in the given order.

    A ``min_by``/``max_by`` aggregate, so each task reduces its rows before the shuffle and
    a hot key costs no more than one row per task.
    """
    payload = [c for c in rows.columns if c not in keys]
    pick = F.max_by if keep_last else F.min_by
    best = rows.groupBy(*keys).agg(pick(F.struct(*payload), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in payload])


#: A window of running counts holds at most so many rows, and as many such steps as 64-bit ids need reach the top.
_STEP = 16


def numbered(rows: DataFrame, id_column: str, groups: Sequence[str] = (), ties: Sequence[str] = (), span: int = 1 << _STEP, name: str = "row_no") -> DataFrame:
    """Exact 1-based position of each row in its group, ordered by ``id_column`` then ``ties``.

    No window ever holds a whole group: rows are numbered within id ranges of width ``span``, ranges within ranges of ranges, and so on up; each
    gives those inside it their offset. A step holds 2^16 ranges at most, however sparse the ids are, and any 64-bit id has its place. The id must be a
    whole number that is unique per (group, ties).
    """
    cell = lambda k: f"_cell{k}"
    keyed = rows.withColumn(cell(0), F.floor(F.col(id_column) / F.lit(span)).cast("bigint") if span & (span - 1) else F.shiftright(F.col(id_column).cast("bigint"), span.bit_length() - 1))
    steps = [keyed.groupBy(*groups, cell(0)).agg(F.count(F.lit(1)).alias("_n"))]
    width = span
    while width < 1 << 48:
        k = len(steps)
        below = steps[-1].withColumn(cell(k), F.shiftright(cell(k - 1), _STEP))
        steps[-1] = below
        steps.append(below.groupBy(*groups, cell(k)).agg(F.sum("_n").alias("_n")))
        width <<= _STEP
    earlier = (Window.unboundedPreceding, -1)
    top = len(steps) - 1
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    offsets = steps[top].withColumn("_before", F.coalesce(F.sum("_n").over(whole.orderBy(cell(top)).rowsBetween(*earlier)), F.lit(0)))
    for k in range(top - 1, -1, -1):
        inside = Window.partitionBy(*groups, cell(k + 1)).orderBy(cell(k)).rowsBetween(*earlier)
        local = steps[k].withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        joined = _null_safe(local, offsets.select(*groups, cell(k + 1), "_before"), [*groups, cell(k + 1)])
        offsets = joined.withColumn("_before", F.col("_before") + F.col("_inside")).select(*groups, cell(k), "_before")
    place = F.row_number().over(Window.partitionBy(*groups, cell(0)).orderBy(id_column, *ties))
    return _null_safe(keyed, offsets, [*groups, cell(0)]).withColumn(name, (F.col("_before") + place).cast("bigint")).select(*rows.columns, name)


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An inner equi-join in which null keys meet; the keys come from the left."""
    side = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(side, same).drop(*[f"_r_{k}" for k in keys])


def top_per_group(rows: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The best ``k`` rows per group. The literal limit lets Spark cut each task to k rows per group before the shuffle."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= F.lit(k))


def containing_intervals(points: DataFrame, point: str, intervals: DataFrame, low: str, high: str, bits: int = 8, levels: int = 6) -> DataFrame:
    """All (point row, interval row) pairs with ``low <= point <= high``, as an equi-join.

    The number line is cut into aligned cells of width ``2**(bits*level)``. An interval becomes the
    few cells that tile it exactly, a point the one cell per level it lies in; a pair meets in
    exactly one cell. Values must lie in ``0 .. 2**(bits*(levels+1)) - 1``.
    """
    top = 1 << (bits * (levels + 1))

    def cells(first: str, end: str) -> str:
        return f"filter(sequence({first}, {end}), x -> x < {end})"

    def edge(value: str, level: str) -> str:
        # First cell of a level that starts at or after the value.
        return f"shiftright({value} + shiftleft(1L, {bits} * ({level})) - 1, {bits} * ({level}))"

    first, end = edge(low, "l"), f"shiftright({high} + 1, {bits} * l)"
    inner_first = f"shiftleft({edge(low, 'l + 1')}, {bits})"
    inner_end = f"shiftleft(shiftright({high} + 1, {bits} * (l + 1)), {bits})"
    # A level gives only what the next coarser one cannot cover.
    tiles = (
        f"flatten(transform(sequence(0, {levels}), l -> transform("
        f"CASE WHEN l < {levels} AND {inner_first} < {inner_end} "
        f"THEN concat({cells(first, inner_first)}, {cells(inner_end, end)}) ELSE {cells(first, end)} END, "
        f"c -> struct(l AS level, c AS cell))))"
    )
    checked = f"CASE WHEN {low} >= 0 AND {high} < {top} THEN {tiles} ELSE raise_error('interval bound out of range') END"
    spots = f"transform(sequence(0, {levels}), l -> struct(l AS level, shiftright({point}, {bits} * l) AS cell))"
    tiled = intervals.select("*", F.explode(F.expr(checked)).alias("_cell"))
    placed = points.select("*", F.explode(F.expr(spots)).alias("_cell"))
    return placed.join(tiled, "_cell").drop("_cell")
