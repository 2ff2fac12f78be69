"""Zone-aware paths, table reads and the write patterns of lakehouse jobs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Used where a session has no spark.checkpoint.dir, which cannot be set once it runs.
STAGING_KEY = "spark.braidlake.staging"
_SCOPES: list[list[tuple[SparkSession, str]]] = []


@dataclass(frozen=True)
class Lake:
    """Paths of a lake: <base>/<zone>[/<country>]/<path>."""

    base: str
    zones: Mapping[str, str] = field(default_factory=dict)

    def resolve(self, zone: str, path: str, country: str | None = None) -> str:
        parts = [self.base.rstrip("/"), self.zones.get(zone, zone), country, path.strip("/")]
        return "/".join(p for p in parts if p)

    def read(
        self,
        spark: SparkSession,
        zone: str,
        path: str,
        country: str | None = None,
        format: str = "parquet",
        **options: str,
    ) -> DataFrame:
        return read(spark, self.resolve(zone, path, country), format, **options)


def read(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    """Load a path. ``delta`` works when the session has the Delta package on its class path."""
    return spark.read.format(format).options(**options).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table or view, with one, two or three name parts."""
    return spark.read.table(name)


def read_sql(spark: SparkSession, text: str, **args: object) -> DataFrame:
    """SQL text as a source; parameters are bound (``:name``), never pasted into the text."""
    return spark.sql(text, args=args or None)


def constants(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small inline relation, kept in the plan as literals."""
    fields = T.StructType.fromDDL(schema).fields
    literals = [
        F.struct(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)]
        )
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*literals)))


@dataclass(frozen=True)
class Sink:
    """Where and how a frame is written."""

    path: str | None = None
    table: str | None = None
    format: str = "parquet"
    mode: str = "overwrite"
    partition_by: Sequence[str] = ()
    spread: bool = True


def write(df: DataFrame, sink: Sink) -> None:
    """Write a frame; partitioned output is shuffled by partition first, with skew split.

    Without that, every task would open a file per partition value. REBALANCE lets AQE cut a
    partition value that holds much of the data into several files. ``spread=False`` leaves it out, for
    small results that a grouping has just shuffled.
    """
    _put(_dealt(df, sink), sink)


def _dealt(df: DataFrame, sink: Sink) -> DataFrame:
    if sink.partition_by and sink.spread:
        return df.hint("rebalance", *[F.col(c) for c in sink.partition_by])
    return df


def _put(df: DataFrame, sink: Sink) -> None:
    writer = df.write.format(sink.format).mode(sink.mode)
    if sink.partition_by:
        writer = writer.partitionBy(*sink.partition_by)
    if sink.table:
        writer.saveAsTable(sink.table)
    elif sink.path:
        writer.save(sink.path)
    else:
        raise ValueError("a sink needs a path or a table")


class TotalsDiffer(RuntimeError):
    """What was read back from a sink is not what was written to it."""


def write_checked(df: DataFrame, sink: Sink, totals: Mapping[str, Column]) -> dict[str, object]:
    """Write a frame, taking control totals on the way, and compare them with what the sink then holds.

    ``totals`` are aggregates (a count, sums). They are taken by the tasks that write, so the frame is
    computed once; only the sink is read again, and only the columns of the totals. Returns them.
    """
    from pyspark.sql import Observation

    seen = Observation(f"totals-{uuid.uuid4().hex}")
    _put(_dealt(df, sink).observe(seen, *[c.alias(n) for n, c in totals.items()]), sink)
    taken = seen.get
    verify(df.sparkSession, sink, totals, taken)
    return taken


def verify(spark: SparkSession, sink: Sink, totals: Mapping[str, Column], taken: Mapping[str, object]) -> None:
    """Raise ``TotalsDiffer`` where a sink's totals are not those taken when it was written."""
    held = read_table(spark, sink.table) if sink.table else read(spark, sink.path, sink.format)
    found = held.agg(*[c.alias(n) for n, c in totals.items()]).first().asDict()
    wrong = {n: (taken[n], found[n]) for n in totals if taken[n] != found[n]}
    if wrong:
        raise TotalsDiffer(", ".join(f"{n}: wrote {w}, read {r}" for n, (w, r) in wrong.items()))


def commit(df: DataFrame, sinks: Sequence[Sink]) -> None:
    """Write one frame to several sinks, computing it once.

    It is staged in the shared folder and read from there for each sink, so a lost executor costs
    no recomputation and nothing has to fit on executors' disks. The staged copy goes afterwards.
    """
    if len(sinks) == 1:
        write(df, sinks[0])
        return
    with staging():
        shared = stage(df, "commit")
        for sink in sinks:
            write(shared, sink)


def commit_all(base: DataFrame, outputs: Sequence[tuple[Callable[[DataFrame], DataFrame], Sink]]) -> None:
    """Write several frames derived from one input (curated, gold, audit), computing it once."""
    with staging():
        shared = stage(base, "commit")
        for derive, sink in outputs:
            write(derive(shared), sink)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame of moderate size for a block; lost blocks are recomputed from lineage."""
    kept = df.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def overwrite_window(df: DataFrame, path: str, partition_by: Sequence[str], format: str = "parquet"):
    """Replace only the partitions present in ``df``; every other partition stays untouched."""
    (
        df.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.format(format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )


def delete_window(
    spark: SparkSession, path: str, partition_col: str, start, format: str = "parquet"
) -> DataFrame:
    """Rows left after deleting ``partition_col >= start``; a partition filter, not a scan."""
    kept = F.col(partition_col).isNull() | (F.col(partition_col) < F.lit(start))
    return read(spark, path, format).filter(kept)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``, else ``STAGING_KEY``; never a guess."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(STAGING_KEY, None)
    if not root:
        raise ValueError(f"set spark.checkpoint.dir or {STAGING_KEY} to a folder every executor can reach")
    return root.rstrip("/")


def _path(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@contextmanager
def staging() -> Iterator[None]:
    """Block at whose end everything staged inside it is deleted: for jobs that write their results."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for spark, path in _SCOPES.pop():
            hadoop, fs = _path(spark, path)
            fs.delete(hadoop, True)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = (), spread: bool = True) -> DataFrame:
    """Materialise an intermediate as a table in the shared folder and read it back.

    Cuts the lineage of long chains; survives the loss of executors because the files are shared.
    The copy is deleted at the end of the enclosing ``staging()`` block, or else, since a caller
    may still read the result, when the application ends.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    write(df, Sink(path=path, partition_by=partition_by, spread=spread))
    return spark.read.parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """Fresh path in the shared folder, deleted as ``stage`` says."""
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop, fs = _path(spark, path)
    if _SCOPES:
        _SCOPES[-1].append((spark, path))
    else:
        fs.deleteOnExit(hadoop)
    return path


def bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Stage a frame as a table dealt out by ``keys`` into ``buckets`` files.

    Tables staged with the same keys and number of buckets are joined on them without another
    shuffle, however many there are and however often. One exchange deals the frame out; a
    hot key fills one bucket, so this is for inputs with few rows a key, such as grouped ones.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *[F.col(k) for k in keys])
    writer = dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", scratch(spark, name)).saveAsTable(table)
    return spark.read.table(table)


def join_spine(spine: DataFrame, inputs: Mapping[str, DataFrame], keys: Sequence[str], buckets: int) -> DataFrame:
    """A spine with the columns of many inputs, each of at most one row per key, joined on equal keys.

    Spine and inputs are staged in buckets, so that the chain of left joins has no exchange: each input
    is dealt out once, instead of the growing row being shuffled where partition counts differ. Buckets are
    merged: each input is just small enough to be broadcast, but all of them together fill the driver.
    """
    out = bucketed(spine, "spine", keys, buckets)
    for name, df in inputs.items():
        out = out.join(bucketed(df, name, keys, buckets).hint("merge"), list(keys), "left")
    return out


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Put ``df`` in the place of the table at ``path``, which it may read from.

    The new state is written beside the old one, once; then the two change places by renaming. Up
    to that moment a failure leaves the table as it was, and a failing second rename puts the old
    one back. Only then is the old state deleted.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    live, fs = _path(spark, path.rstrip("/"))
    fresh, _ = _path(spark, f"{path.rstrip('/')}.next-{mark}")
    old, _ = _path(spark, f"{path.rstrip('/')}.old-{mark}")
    write(df, Sink(path=fresh.toString(), mode="error", partition_by=partition_by))
    had = fs.exists(live)
    if had and not fs.rename(live, old):
        raise OSError(f"{path} could not be set aside")
    if not fs.rename(fresh, live):
        if had:
            fs.rename(old, live)
        raise OSError(f"the new state of {path} could not be moved into place")
    if had:
        fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def drop_staged(spark: SparkSession, name: str) -> int:
    """Delete the staged copies of an intermediate; returns how many there were."""
    pattern, fs = _path(spark, f"{staging_root(spark)}/{name}-*")
    found = fs.globStatus(pattern) or []
    for status in found:
        fs.delete(status.getPath(), True)
    return len(found)


def use_catalog(spark: SparkSession, name: str) -> str:
    """Switch the current catalog and return its name."""
    spark.catalog.setCurrentCatalog(name)
    return spark.catalog.currentCatalog()
