"""Upserts, type-1 and type-2 dimension loads and source/target reconciliation.

Parquet has no MERGE or DELETE. Every load here is a join that returns the whole new state; write
it with ``sources.lake.replace_table``, which never overwrites the files it is reading. Sources
must hold one row per key: check with ``select.assert_unique``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions.keys import all_equal, any_differs, differs_by_sentinel

KEY_BUCKETS = 4096


def _paired(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on null-safe keys; columns come out as t.* and s.*."""
    t = target.select("*", F.lit(True).alias("_in")).alias("t")
    s = source.select("*", F.lit(True).alias("_in")).alias("s")
    return t.join(s, all_equal([(F.col(f"t.{k}"), F.col(f"s.{k}")) for k in keys]), "full")


def _in_target() -> Column:
    return F.col("t._in").isNotNull()


def _in_source() -> Column:
    return F.col("s._in").isNotNull()


def upsert_scd1(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    hash_col: str,
    now: Column,
    scope: Column | None = None,
    inserted: str = "inserted_at",
    changed: str = "changed_at",
) -> DataFrame:
    """Insert new keys, overwrite rows whose fingerprint differs, leave the rest as they are.

    ``scope`` is a condition on target columns (for example a month window): target rows outside
    it are passed through without being shuffled, and a date condition on a partition column
    prunes the scan of the joined part. The source must lie inside the scope as well.
    """
    outside = None
    if scope is not None:
        inside = F.coalesce(scope, F.lit(False))
        outside, target = target.filter(~inside), target.filter(inside)
    pair = _paired(target, source, keys)
    fresh = _in_source() & ~_in_target()
    stale = (
        _in_source()
        & _in_target()
        & differs_by_sentinel(F.col(f"s.{hash_col}"), F.col(f"t.{hash_col}"))
    )
    out = []
    for c in target.columns:
        if c == inserted:
            out.append(F.when(fresh, now).otherwise(F.col(f"t.{c}")).alias(c))
        elif c == changed:
            out.append(F.when(fresh | stale, now).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(
                F.when(fresh | stale, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            )
    merged = pair.select(*out)
    return merged if outside is None else outside.unionByName(merged)


def classify_changes(
    source: DataFrame,
    active: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    hash_col: str,
    action: str = "action",
) -> DataFrame:
    """Source rows that change something, tagged insert / version / update.

    A tracked column that differs (NULL equal to NULL only) asks for a new version; any other
    difference in the fingerprint is updated in place; equal fingerprints are left out.
    """
    a = active.select(
        *[F.col(c).alias(f"_a_{c}") for c in dict.fromkeys([*keys, *tracked, hash_col])],
        F.lit(True).alias("_in"),
    )
    on = all_equal([(source[k], a[f"_a_{k}"]) for k in keys])
    moved = any_differs([(source[c], a[f"_a_{c}"]) for c in tracked])
    return (
        source.join(a, on, "left")
        .filter(
            a["_in"].isNull() | differs_by_sentinel(source[hash_col], a[f"_a_{hash_col}"])
        )
        .select(
            source["*"],
            F.when(a["_in"].isNull(), "insert")
            .when(moved, "version")
            .otherwise("update")
            .alias(action),
        )
    )


def expand_actions(changes: DataFrame, action: str = "action") -> DataFrame:
    """One extra ``close`` row for every ``version`` row, flagged active for matching."""
    steps = F.when(F.col(action) == "version", F.array(F.lit("close"), F.lit("version"))).otherwise(
        F.array(F.col(action))
    )
    others = [c for c in changes.columns if c != action]
    return changes.select(*others, F.explode(steps).alias(action))


def allocate_keys(
    df: DataFrame, natural: Sequence[str], start: Column, name: str, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Unique long keys above ``start`` without numbering the table in one task.

    Natural keys are spread over buckets by their md5; bucket b hands out start + b + 1,
    start + b + 1 + buckets, and so on. Rows must be unique on ``natural``, so no bucket is hot.
    The result is the same on every run, so a lost task recomputes the same keys.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural])
    bucket = F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))
    window = Window.partitionBy("_bucket").orderBy(*natural)
    return (
        df.withColumn("_bucket", bucket)
        .withColumn(
            name,
            (
                F.coalesce(start, F.lit(0)).cast("bigint")
                + F.col("_bucket")
                + 1
                + (F.row_number().over(window) - 1).cast("bigint") * buckets
            ),
        )
        .drop("_bucket")
    )


def upsert_scd2(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    hash_col: str,
    now: Column,
    surrogate: str = "sk",
    active: str = "is_active",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    inserted: str = "inserted_at",
    changed: str = "changed_at",
) -> DataFrame:
    """New state of a type-2 dimension.

    * no active row: insert with a new surrogate key;
    * a tracked column differs: the active row is closed and a version with the same surrogate
      key is added; validity ends and starts one day before ``now``;
    * only the fingerprint differs: update in place;
    * equal fingerprint, or key absent from the source: unchanged.

    One full outer join of source and active rows decides everything; closed rows and versions
    come from one ``explode`` of the step list instead of a second pass over both tables. Only
    keys that have no active row are numbered; the numbers come back to the source by a join on
    the keys.
    """
    current = target.filter(F.col(active) == 1)
    history = target.filter(~F.col(active).eqNullSafe(1))
    edge = now - F.expr("INTERVAL 1 DAY")
    moved = any_differs([(F.col(f"s.{c}"), F.col(f"t.{c}")) for c in tracked])
    stale = differs_by_sentinel(F.col(f"s.{hash_col}"), F.col(f"t.{hash_col}"))
    steps = (
        F.when(_in_source() & ~_in_target(), F.array(F.lit("insert")))
        .when(_in_source() & stale & moved, F.array(F.lit("close"), F.lit("version")))
        .when(_in_source() & stale, F.array(F.lit("update")))
        .otherwise(F.array(F.lit("keep")))
    )
    unseen = source.select(*keys).join(
        current.select(*[F.col(k).alias(f"_t_{k}") for k in keys]),
        all_equal([(F.col(k), F.col(f"_t_{k}")) for k in keys]),
        "left_anti",
    )
    handed = allocate_keys(unseen, keys, target.agg(F.max(surrogate)).scalar(), "_new_key").select(
        *[F.col(k).alias(f"_n_{k}") for k in keys], "_new_key"
    )
    numbered = source.join(handed, all_equal([(F.col(k), F.col(f"_n_{k}")) for k in keys]), "left").select(
        *source.columns, "_new_key"
    )
    pair = _paired(current, numbered, keys).withColumn("_step", F.explode(steps))
    step = F.col("_step")
    new_row = step.isin("insert", "version")
    from_source = step.isin("insert", "version", "update")
    special = {
        surrogate: F.when(step == "insert", F.col("s._new_key")).otherwise(
            F.col(f"t.{surrogate}")
        ),
        active: F.when(step == "close", F.lit(0)).when(new_row, F.lit(1)).otherwise(
            F.col(f"t.{active}")
        ),
        valid_from: F.when(new_row, edge).otherwise(F.col(f"t.{valid_from}")),
        valid_to: F.when(step == "close", edge).when(~new_row, F.col(f"t.{valid_to}")),
        inserted: F.when(new_row, now).otherwise(F.col(f"t.{inserted}")),
        changed: F.when(step != "keep", now).otherwise(F.col(f"t.{changed}")),
    }
    types = {f.name: f.dataType for f in target.schema.fields}
    out = [
        special.get(
            c,
            F.when(from_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
            if c in source.columns
            else F.col(f"t.{c}"),
        ).cast(types[c]).alias(c)
        for c in target.columns
    ]
    return history.unionByName(pair.select(*out))


def reload_window(target: DataFrame, source: DataFrame, date_col: str, start) -> DataFrame:
    """Drop the target rows from ``start`` on and take that window from the source.

    On a table partitioned by ``date_col`` write only the window instead:
    ``sources.lake.overwrite_window``.
    """
    old = target.filter(F.col(date_col).isNull() | (F.col(date_col) < F.lit(start)))
    new = source.filter(F.col(date_col) >= F.lit(start))
    return old.unionByName(new, allowMissingColumns=True)


def reconcile(
    source: DataFrame, target: DataFrame, keys: Sequence[str], status: str = "status"
) -> DataFrame:
    """One pass over both sides: ``new``, ``active`` (in both) or ``inactive`` (target only).

    Rows present in the source carry the source's values, the others the target's.
    """
    pair = _paired(target, source, keys)
    cols = [
        F.when(_in_source(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
        for c in source.columns
    ]
    state = (
        F.when(~_in_target(), "new").when(_in_source(), "active").otherwise("inactive").alias(status)
    )
    extra = [F.col(f"t.{c}") for c in target.columns if c not in source.columns]
    return pair.select(*cols, *extra, state)
