"""MERGE for partitioned Parquet tables: only the partitions in which something changes are rewritten.

A merge finds the source rows that change the table, writes the new state of the partitions they
touch beside the table's own and then puts each in the place of the old one by renaming. A
commit list, itself put in place by one rename, says which partitions change places. Whatever is
interrupted before it is undone, whatever comes after it is carried on, by ``recover``: the table is
left in its old or its new state, never between. Folders of a merge start with an underscore, which
readers skip; partitions outside the list keep their files.

One merge runs on a table at a time. Renaming a folder must be one step, as it is on HDFS and local
disks; object stores need a table format for that.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.functions.keys import all_equal, differs_by_sentinel
from braidlake.sources import lake

PREFIX = "_merge-"
LIST = "COMMIT"
# Up to so many partitions are written without a shuffle: every task then opens a file in each.
FEW = 16


@dataclass(frozen=True)
class Merged:
    """Rows that a merge added and changed, and the partition folders that changed places."""

    inserted: int
    updated: int
    rewritten: tuple[str, ...]


# ---- folders ---------------------------------------------------------------------------------


def _rename(fs, old, new) -> None:
    if not fs.exists(new.getParent()):
        fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{old} could not be renamed to {new}")


def _folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders below ``path``, as relative paths of ``depth`` names."""
    root, fs = lake._path(spark, path)
    if not fs.exists(root):
        return []
    found = [""]
    for _ in range(depth):
        below = []
        for name in found:
            here, _ = lake._path(spark, f"{path}/{name}" if name else path)
            for status in fs.listStatus(here):
                own = status.getPath().getName()
                if status.isDirectory() and "=" in own:
                    below.append(f"{name}/{own}" if name else own)
        found = below
    return sorted(found)


def _swap(spark: SparkSession, path: str, work: str, steps: Sequence[tuple[str, str]]) -> None:
    """Put every listed partition in place; may be repeated from any point at which it stopped.

    ``add``: there was no such folder; ``drop``: no row is left for it; ``swap``: the new folder takes
    the place of the old one, which is set aside first.
    """
    for kind, name in steps:
        (live, fs), (fresh, _), (old, _) = (
            lake._path(spark, f"{where}/{name}") for where in (path, f"{work}/new", f"{work}/old")
        )
        if kind != "add" and fs.exists(live) and not fs.exists(old):
            _rename(fs, live, old)
        if kind != "drop" and fs.exists(fresh):
            _rename(fs, fresh, live)


def _read_list(spark: SparkSession, work: str) -> list[tuple[str, str]]:
    hadoop, fs = lake._path(spark, f"{work}/{LIST}")
    stream = fs.open(hadoop)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [tuple(line.split(" ", 1)) for line in text.split("\n") if line]


def _commit(spark: SparkSession, path: str, work: str, names: Sequence[str], depth: int) -> tuple[str, ...]:
    """Let the listed partitions change places with what ``work``/new holds for them."""
    live, new = set(_folders(spark, path, depth)), set(_folders(spark, f"{work}/new", depth))
    steps = [("add" if n not in live else "swap" if n in new else "drop", n) for n in names if n in live | new]
    _write_list(spark, work, steps)
    _swap(spark, path, work, steps)
    root, fs = lake._path(spark, work)
    fs.delete(lake._path(spark, f"{work}/{LIST}")[0], False)
    fs.delete(root, True)
    spark.catalog.refreshByPath(path)
    return tuple(n for _, n in steps)


def _write_list(spark: SparkSession, work: str, steps: Sequence[tuple[str, str]]) -> None:
    draft, fs = lake._path(spark, f"{work}/{LIST}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write("\n".join(f"{kind} {name}" for kind, name in steps).encode())
    finally:
        stream.close()
    _rename(fs, draft, lake._path(spark, f"{work}/{LIST}")[0])


def recover(spark: SparkSession, path: str) -> str:
    """Carry on or undo what an interrupted merge has left: ``finished``, ``undone`` or ``nothing``."""
    path = path.rstrip("/")
    pattern, fs = lake._path(spark, f"{path}/{PREFIX}*")
    state = "nothing"
    for status in fs.globStatus(pattern) or []:
        work = status.getPath().toString()
        if fs.exists(lake._path(spark, f"{work}/{LIST}")[0]):
            _swap(spark, path, work, _read_list(spark, work))
            state = "finished"
        elif state == "nothing":
            state = "undone"
        # The list goes first: without it the rest is only waste.
        fs.delete(lake._path(spark, f"{work}/{LIST}")[0], False)
        fs.delete(status.getPath(), True)
    if state != "nothing":
        spark.catalog.refreshByPath(path)
    return state


# ---- the merge -------------------------------------------------------------------------------


def read_as(spark: SparkSession, path: str, types: T.StructType, partition_by: Sequence[str]) -> DataFrame:
    """The table, its partition columns in the types of ``types`` instead of guessed ones."""
    stored = spark.read.parquet(path).schema
    named = {f.name: f.dataType for f in types}
    fields = [T.StructField(f.name, named[f.name] if f.name in partition_by else f.dataType) for f in stored]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _among(partition_by: Sequence[str], tuples: Sequence[tuple]) -> Column:
    """Condition on partition columns only, so that the scan skips the other folders."""
    if len(partition_by) == 1:
        name = partition_by[0]
        values = [r[0] for r in tuples if r[0] is not None]
        held = F.col(name).isin(values) if values else F.lit(False)
        return held | F.col(name).isNull() if len(values) < len(tuples) else held
    each = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partition_by, r)]) for r in tuples]
    return reduce(lambda a, b: a | b, each, F.lit(False))


def find_changes(
    stored: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    hash_col: str,
    kept: Sequence[str],
) -> DataFrame:
    """Source rows that add or change a row: their columns, ``_found``, and under ``_old`` the
    partition columns and the ``kept`` columns of the stored row, whose keys are those of the source row.

    Only keys, fingerprint, partition and kept columns of the stored rows are read and shuffled.
    """
    names = list(dict.fromkeys([*partition_by, *kept])) or list(keys)
    old = stored.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(hash_col).alias("_hash"),
        F.struct(*names).alias("_old"),
        F.lit(True).alias("_in"),
    )
    pair = source.join(old, all_equal([(F.col(k), F.col(f"_k{i}")) for i, k in enumerate(keys)]), "left")
    found = F.col("_in").isNotNull()
    return pair.filter(~found | differs_by_sentinel(F.col(hash_col), F.col("_hash"))).select(
        *[source[c] for c in source.columns], "_old", found.alias("_found")
    )


def merge_partitions(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    hash_col: str,
    now: Column,
    scope: Column | None = None,
    inserted: str | None = "inserted_at",
    changed: str | None = "changed_at",
) -> Merged:
    """Insert new keys and overwrite rows whose fingerprint differs, in the partitions concerned only.

    ``source`` holds one row per key (check with ``select.assert_unique``) and every column of the table but the
    stamps. ``scope`` is a condition on stored rows, best on partition columns: rows outside it are not
    matched. A changed row whose partition columns differ moves to another partition. Where the keys
    include the partition columns, only partitions that occur in the source are read.

    The source is computed once and its changed rows are staged, so a source that answers differently
    when computed again cannot split the decision from the write.
    """
    spark, path = source.sparkSession, path.rstrip("/")
    root, fs = lake._path(spark, path)
    stamps = [c for c in (inserted, changed) if c]
    if not fs.exists(root):
        first = source.withColumns({c: now for c in stamps})
        lake.write(first, lake.Sink(path, mode="error", partition_by=partition_by))
        rows = read_as(spark, path, source.schema, partition_by).count()
        return Merged(rows, 0, tuple(_folders(spark, path, len(partition_by))))
    recover(spark, path)

    table = read_as(spark, path, source.schema, partition_by)
    columns = [c for c in table.columns if c not in stamps]
    types = {f.name: f.dataType for f in table.schema}
    work = f"{path}/{PREFIX}{uuid.uuid4().hex}"
    source = source.select(*[F.col(c).cast(types[c]).alias(c) for c in columns])
    stored = table if scope is None else table.filter(scope)
    if set(partition_by) <= set(keys):
        # Read twice, for its partitions and for its rows.
        source.write.parquet(f"{work}/source")
        source = spark.read.schema(T.StructType([table.schema[c] for c in columns])).parquet(f"{work}/source")
        stored = stored.filter(_among(partition_by, source.select(*partition_by).distinct().collect()))

    kept = [inserted] if inserted else []
    find_changes(stored, source, keys, partition_by, hash_col, kept).write.parquet(f"{work}/changes")
    changes = spark.read.parquet(f"{work}/changes")
    n = changes.agg(F.count_if("_found").alias("old"), F.count_if(~F.col("_found")).alias("new")).first()
    if not n["old"] + n["new"]:
        fs.delete(lake._path(spark, work)[0], True)
        return Merged(0, 0, ())

    # Names of partitions, not rows, come to the driver.
    old, new = ([F.col(f"{at}{c}").alias(c) for c in partition_by] for at in ("_old.", ""))
    places = changes.filter("_found").select(F.lit(True).alias("_left"), *old).union(changes.select(F.lit(False), *new))
    rows = places.distinct().collect()
    named = dict(zip(rows, spell(spark, f"{work}/touched", partition_by, table.schema, [tuple(r)[1:] for r in rows])))
    live = set(_folders(spark, path, len(partition_by)))
    if odd := {name for r, name in named.items() if r[0] and name not in live}:
        fs.delete(lake._path(spark, work)[0], True)
        raise ValueError(f"partition folders of {path} are not spelled as Spark does: no {sorted(odd)[:3]}")
    names, touched = sorted(set(named.values())), list(dict.fromkeys(tuple(r)[1:] for r in rows))

    # A stored row goes if it is the one that a changed row was matched with.
    replaced = changes.filter("_found").select(
        *[F.col(f"_old.{c}" if c in partition_by else c).alias(f"_o_{c}") for c in dict.fromkeys([*keys, *partition_by])]
    )
    same = all_equal([(F.col(c), F.col(f"_o_{c}")) for c in dict.fromkeys([*keys, *partition_by])])
    stay = table.filter(_among(partition_by, touched)).join(replaced, same, "left_anti")
    stamped = {}
    if inserted:
        stamped[inserted] = F.when(F.col("_found"), F.col(f"_old.{inserted}")).otherwise(now.cast(types[inserted]))
    if changed:
        stamped[changed] = now.cast(types[changed])
    fresh = changes.withColumns(stamped).select(*table.columns)
    sink = lake.Sink(f"{work}/new", mode="error", partition_by=partition_by, spread=len(touched) > FEW)
    lake.write(stay.unionByName(fresh), sink)

    return Merged(n["new"], n["old"], _commit(spark, path, work, names, len(partition_by)))


def spell(spark: SparkSession, work: str, partition_by: Sequence[str], schema: T.StructType, tuples: Sequence[tuple]) -> list[str]:
    """Folder names of partitions as Spark spells them: a row of each is written as the table is."""
    if not tuples:
        return []
    types = T.StructType([T.StructField("_no", T.IntegerType()), *[schema[c] for c in partition_by]])
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(tuples)], types).withColumn("_row", F.lit(1))
    rows.coalesce(1).write.partitionBy("_no", *partition_by).parquet(work)
    found = dict(f.removeprefix("_no=").split("/", 1) for f in _folders(spark, work, len(partition_by) + 1))
    return [found[str(i)] for i in range(len(tuples))]


def replace_partitions(source: DataFrame, path: str, partition_by: Sequence[str], scope: Column) -> tuple[str, ...]:
    """Delete every row in ``scope``, a condition on partition columns, and put ``source`` in their place.

    All rows of ``source`` must lie in the scope. Partitions of the scope that the source lacks go; others keep
    their files; the change is one commit list, as in ``merge_partitions``. Returns the folders
    that changed.
    """
    spark, path = source.sparkSession, path.rstrip("/")
    root, fs = lake._path(spark, path)
    if not fs.exists(root):
        lake.write(source, lake.Sink(path, mode="error", partition_by=partition_by))
        return tuple(_folders(spark, path, len(partition_by)))
    recover(spark, path)
    table = read_as(spark, path, source.schema, partition_by)
    gone = [tuple(r) for r in table.filter(scope).select(*partition_by).distinct().collect()]  # partitions, not rows
    work = f"{path}/{PREFIX}{uuid.uuid4().hex}"
    fresh = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema])
    lake.write(fresh, lake.Sink(f"{work}/new", mode="error", partition_by=partition_by))
    new = _folders(spark, f"{work}/new", len(partition_by))
    old = spell(spark, f"{work}/touched", partition_by, table.schema, gone)
    if outside := set(new) & set(_folders(spark, path, len(partition_by))) - set(old):
        fs.delete(lake._path(spark, work)[0], True)
        raise ValueError(f"the source has rows outside the scope: {sorted(outside)[:3]}")
    return _commit(spark, path, work, sorted({*old, *new}), len(partition_by))
