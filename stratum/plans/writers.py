"""Write strategies on plain Parquet.

* ``append``             plain append; *not* idempotent (kept to show it)
* ``replace_slice``      one batch partition replaced, also by no rows
* ``replace_partitions`` dynamic overwrite of the partitions a source produces
* ``merged``             update matched keys, insert the rest, never delete
* ``upserted``           keyed upsert; by order (replay-safe) or incoming wins
* ``inserted``           keyed insert-if-absent; existing rows are kept

The keyed strategies are DataFrame -> DataFrame. ``SlicedTable`` keeps their result
as one Hive partition per batch: a write replaces its own batch's partition
with one row per key, and a reader keeps, per key, the row that wins over all
batches. So a write costs its batch, whatever the table holds; a batch that is
written again, or was cut short by a crash, ends in the same partition; and the
result depends on no order of writing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import DateType, StructType

from stratum.plans import storage
from stratum.session import scratch_dir


class SchemaDriftError(ValueError):
    """Source columns or types differ from the target's (``on_schema_change=fail``)."""


class DuplicateKeyError(ValueError):
    """A merge source holds more than one row for a key."""


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # folder of NULL


# --- guards ------------------------------------------------------------------------

def _shape(schema: StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def check_schema(df: DataFrame, target: StructType | dict[str, str]) -> None:
    """Raise when column names or types differ from the target schema
    (column order is free: rows are always combined by name)."""
    have, want = _shape(df.schema), target if isinstance(target, dict) else _shape(target)
    if have != want:
        extra = sorted(set(have.items()) - set(want.items()))
        missing = sorted(set(want.items()) - set(have.items()))
        raise SchemaDriftError(f"schema drift: new/changed {extra}, missing/changed {missing}")


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if any key occurs twice (one aggregation, stops at the first hit)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"source has duplicate key {[dup[0][k] for k in keys]}")


DUPLICATE = "source has duplicate key"


def failing_on_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``; whoever reads it fails where a key occurs twice. So a write is checked without a second pass."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    found = F.concat(F.lit(f"{DUPLICATE} "), F.to_json(F.struct(*keys)))
    return df.withColumn("_n", n).where(F.when(F.col("_n") == 1, True).otherwise(F.raise_error(found).cast("boolean"))).drop("_n")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on ``keys`` in which NULL equals NULL: a replayed row
    with a NULL key must find itself."""
    side = right.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r{i}"))
    return left.join(side, cond, how)


# --- plain directory writes ------------------------------------------------------

def observed(obs: Observation, fallback) -> dict:
    """Metrics of an observed write. When AQE proves an input empty at
    runtime it removes the whole subtree, observation included; then the
    ``fallback`` (a callable) recomputes the metrics from what was written."""
    try:
        return dict(obs.get)
    except Exception:
        return fallback()


def append(df: DataFrame, path: str) -> int:
    """Plain append. Returns rows written (from an ``Observation`` of the
    write itself — no second pass)."""
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return int(observed(obs, lambda: {"rows": 0})["rows"])  # removed only when provably empty


def replace_partitions(df: DataFrame, path: str, partition_cols: Sequence[str],
                       sort_within: Sequence[str] = (), metrics: Sequence[Column] = (),
                       cluster: bool = True) -> int | dict:
    """Delete+insert of exactly the partitions present in ``df``.

    With ``cluster`` the rows are rebalanced on the partition columns first
    (the ``rebalance`` hint: AQE splits an oversized partition over several
    tasks and packs small ones), so each partition gets few, well-sized
    files instead of one file per task and partition. A write of a single
    partition needs no clustering. Returns rows written, or all observed
    ``metrics`` as a dict when some are given (collected during the write,
    no second pass).
    """
    held = schema_of(df.sparkSession, path)
    if held is not None:
        check_schema(df, held)
    obs = Observation()
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics)
    if cluster:
        out = out.hint("rebalance", *partition_cols)
    if sort_within:
        out = out.sortWithinPartitions(*partition_cols, *sort_within)
    # an option of this write: other threads write with the same session
    try:
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path)
    except PySparkException as exc:
        if DUPLICATE in str(exc):  # of ``failing_on_duplicates``
            raise DuplicateKeyError(str(exc)) from exc
        raise
    got = observed(obs, lambda: {"rows": 0})  # removed only when the input was provably empty
    return got if metrics else int(got["rows"])


def replace_slice(df: DataFrame, path: str, col: str, value, inner: Sequence[str] = (), cluster: bool = True) -> int:
    """Delete+insert of the one partition ``col=value``: whatever it held is
    gone, also when ``df`` has no rows. ``inner`` columns partition the slice
    further; without ``cluster`` each task writes its own files of them. Running it again after a crash at any point gives the same slice."""
    spark = df.sparkSession
    held = schema_of(spark, path)
    if held is not None:
        check_schema(df, StructType([f for f in held.fields if f.name != col]))
    obs = Observation()
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if inner and cluster:
        out = out.hint("rebalance", *inner)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*inner) if inner else writer).parquet(f"{path}/{col}={value}")
    return int(observed(obs, lambda: {"rows": 0})["rows"])  # removed only when provably empty


def slice_values(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of the partition folders ``col=value`` directly under ``path``, sorted."""
    return sorted(n[len(col) + 1:] for n in storage.list_names(spark, path) if n.startswith(f"{col}="))


# Schemas of tables partitioned by days, as first read in a session: every write is checked against them, so
# they stay. (Folders of other kinds may change the type that Spark finds for the column.)
_SCHEMAS: dict[tuple[str, str], StructType] = {}


def _by_days_only(spark: SparkSession, path: str, schema: StructType) -> bool:
    folders = [n for n in storage.list_names(spark, path) if "=" in n]
    while folders:
        if schema[folders[0].split("=")[0]].dataType != DateType():
            return False
        path = f"{path}/{folders[0]}"
        folders = [n for n in storage.list_names(spark, path) if "=" in n]
    return True


def read_if_exists(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    known = (spark.sparkContext.applicationId, path)
    if not storage.exists(spark, path):
        _SCHEMAS.pop(known, None)
        return None
    schema = schema or _SCHEMAS.get(known)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    try:
        df = spark.read.parquet(path)
    except AnalysisException as exc:
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):  # folder without data files yet
            return None
        raise
    if any("=" in n for n in storage.list_names(spark, path)) and _by_days_only(spark, path, df.schema):
        _SCHEMAS[known] = df.schema
    return df


def schema_of(spark: SparkSession, path: str) -> StructType | None:
    """Schema of the table at ``path``; if it is known, none of the files are listed for it."""
    known = (spark.sparkContext.applicationId, path)
    if known in _SCHEMAS and storage.exists(spark, path):
        return _SCHEMAS[known]
    df = read_if_exists(spark, path)
    return None if df is None else df.schema


def read_slice(spark: SparkSession, path: str, col: str, value, schema: StructType | None = None) -> DataFrame | None:
    """The partition ``col=value`` without that column. Of a table of day partitions only this folder is listed, however
    many others there are."""
    folder = f"{path}/{col}={value}"
    held = schema or (schema_of(spark, path) and _SCHEMAS.get((spark.sparkContext.applicationId, path)))
    if held is not None and storage.exists(spark, folder):
        return spark.read.schema(StructType([f for f in held.fields if f.name != col])).parquet(folder)
    df = read_if_exists(spark, path, schema)
    return df if df is None else df.where(F.col(col) == F.lit(value)).drop(col)


# --- keyed strategies, DataFrame -> DataFrame ------------------------------------------

def merged(target: DataFrame | None, src: DataFrame, keys: Sequence[str],
           keep_only: DataFrame | None = None) -> DataFrame:
    """Matched keys take the source row, unmatched source rows are inserted,
    target rows without a source row stay (a merge never deletes).

    A small source's keys are broadcast by Catalyst's size check, making the
    pass over the target map-only. ``keep_only`` (a frame with the key
    columns) drops target rows whose key is no longer live there.
    """
    if target is None:
        return src
    kept = null_safe(target, src, keys, "left_anti")
    if keep_only is not None:
        kept = null_safe(kept, keep_only, keys, "left_semi")
    return kept.unionByName(src)


def collapse(batch: DataFrame, keys: str | Sequence[str], order: Sequence[str],
             keep: str = "last", total: bool = False) -> DataFrame:
    """One row per key: the greatest (``last``) or smallest (``first``)
    ``order``, the remaining columns as a total tie-break (NULL smallest). With ``total`` the order
    tells all rows of a key apart, so a reader of few columns moves these only.

    ``row_number() = 1`` lets Catalyst keep one row per key and task before
    the shuffle (partial ``WindowGroupLimit``); measured faster than a max
    over a struct of all columns, which needs a sort-based aggregate.
    """
    from stratum.operators.latest import top1_per_key

    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [] if total else [c for c in batch.columns if c not in keys and c not in order]
    cols = [F.col(c) for c in list(order) + rest]
    ranking = [c.desc_nulls_last() for c in cols] if keep == "last" else [c.asc_nulls_first() for c in cols]
    return top1_per_key(batch, keys, ranking).select(*batch.columns)


def upserted(target: DataFrame | None, batch: DataFrame, keys: str | Sequence[str], order: Sequence[str],
             keep: str = "last", guarded: bool = True) -> DataFrame:
    """Keyed upsert.

    Guarded (default): per key the greatest (``keep="last"``) or smallest
    (``keep="first"``) ``order`` among the target row and the incoming rows
    wins, so the result does not depend on delivery order and replaying any
    batch is a no-op. Unguarded: the incoming row always wins
    (``ON CONFLICT DO UPDATE``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if target is None:
        return collapse(batch, keys, order, keep)
    if not guarded:
        return merged(target, collapse(batch, keys, order, keep), keys)
    return collapse(target.unionByName(batch), keys, order, keep)


def inserted(target: DataFrame | None, batch: DataFrame, keys: str | Sequence[str],
             order: Sequence[str]) -> DataFrame:
    """``ON CONFLICT DO NOTHING``: keys not yet in the target are added
    (earliest in-batch row); existing rows are kept."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    incoming = collapse(batch, keys, order, "first")
    return incoming if target is None else target.unionByName(null_safe(incoming, target, keys, "left_anti"))


# --- tables of batch slices -------------------------------------------------------------

SLICE = "_slice"
SHARED_KEYS = 500_000  # keys of several slices, up to which they are looked up by a (broadcast) join


@dataclass
class SlicedTable:
    """Rows with a key, one partition ``<slice_col>=<value>`` per batch.

    ``order`` decides which row of a key is read: the greatest (``keep="last"``) or the
    smallest (``"first"``), the other columns as a tie-break. It may name the slice
    column: then the last batch wins, as in a merge. ``fold`` puts old slices together.
    """

    spark: SparkSession
    root: str
    keys: Sequence[str]
    order: Sequence[str]
    keep: str = "last"
    slice_col: str = SLICE

    def __post_init__(self) -> None:
        self.keys = [self.keys] if isinstance(self.keys, str) else list(self.keys)

    def put(self, value, rows: DataFrame, collapsed: bool = False) -> int:
        """The slice ``value`` becomes ``rows``, one per key. ``collapsed``: they are that already."""
        order = [c for c in self.order if c != self.slice_col]
        return replace_slice(rows if collapsed else collapse(rows, self.keys, order, self.keep), self.root, self.slice_col, value)

    def slices(self) -> DataFrame | None:
        """All rows of all slices, with the slice column."""
        df = read_if_exists(self.spark, self.root)
        # as text: names of slices sort as text, whatever they look like
        return df if df is None else df.withColumn(self.slice_col, F.col(self.slice_col).cast("string"))

    def read(self, until: str | None = None, keys: DataFrame | None = None) -> DataFrame | None:
        """The winning row of every key; of the slices up to ``until`` (partition pruning) and of ``keys`` only.

        Only rows of keys that several slices hold are compared. Those keys are found first, by moving keys alone; while
        they are few, all other rows are read where they lie."""
        df = self.slices()
        if df is None:
            return None
        if until is not None:
            df = df.where(F.col(self.slice_col) <= F.lit(until))
        if keys is not None:
            return self._winners(null_safe(df, keys, self.keys, "left_semi"))
        held = [v for v in slice_values(self.spark, self.root, self.slice_col) if until is None or v <= until]
        if len(held) < 2:  # a slice has one row per key
            return df.drop(self.slice_col)
        path = scratch_dir(self.spark, "shared-keys")
        n = append(df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*self.keys), path)
        if n == 0:
            return df.drop(self.slice_col)
        if n > SHARED_KEYS:
            return self._winners(df)
        shared = self.spark.read.schema(df.select(*self.keys).schema).parquet(path)
        return null_safe(df, shared, self.keys, "left_anti").drop(self.slice_col).unionByName(
            self._winners(null_safe(df, shared, self.keys, "left_semi")))

    def _winners(self, df: DataFrame) -> DataFrame:
        """One row per key of ``df``. A slice has one row per key: few rows are to go, so the rows are sorted only after
        they moved, and the slice is a total order."""
        total = self.slice_col in self.order
        return collapse(df.repartition(*self.keys), self.keys, self.order, self.keep, total).drop(self.slice_col)

    def fold(self, upto: str) -> int:
        """Puts the slices up to ``upto`` together in one, named to sort right after the last of them. A reader sees the
        same rows at any point of it, so it may be cut short and run again. Batches folded in are not to be replayed."""
        old = [v for v in slice_values(self.spark, self.root, self.slice_col) if v <= upto]
        if len(old) < 2:
            return 0
        df = self.slices().where(F.col(self.slice_col).isin(old))
        n = replace_slice(self._winners(df), self.root, self.slice_col, f"{old[-1]}~")
        for value in old:
            storage.delete(self.spark, f"{self.root}/{self.slice_col}={value}")
        return n


def merge_into_table(src: DataFrame, table_name: str, keys: Sequence[str]) -> None:
    """Merge by key into a catalog table of a v2 table format (Delta,
    Iceberg, ...) with ``DataFrame.mergeInto``: update matched rows, insert
    the rest, never delete. The format rewrites only the files that hold
    matched keys instead of the whole table. Needs such a format on the
    class path; plain Parquet tables use ``SlicedTable``.
    """
    cond = " AND ".join(f"{table_name}.{k} = _src.{k}" for k in keys)
    (src.alias("_src").mergeInto(table_name, F.expr(cond))
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
        .merge())
