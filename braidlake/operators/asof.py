"""As-of lookups, freeze snapshots and system roll-out splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions.keys import all_equal


def asof_latest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    payload: Sequence[str],
    tie_break: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Each left row with the payload of the newest right row at or before its time.

    ``strict`` asks for a right row strictly before. Right rows on the same instant are ordered
    by ``tie_break``. Rows without a match keep NULLs; left rows without a key or a time cannot
    match and are passed by, so they are never gathered anywhere.

    Both sides are stacked and reduced to one row per key and instant, in one grouping: the newest
    right row of the instant, and whether a left row asks for it. The instants are read in time
    order per (key, hour), so a key that holds all rows of a day still has 24 groups, and a group
    has no more rows than an hour has instants. What an hour inherits from earlier ones is the
    newest right row of each hour, found by a window over a table of one row per key and hour.
    The answers are then joined back to the left rows; that join can be split where one instant
    has many of them. No pairs of rows are formed.
    """
    held = F.struct(*dict.fromkeys([right_ts, *tie_break, *payload]))
    known = F.col(left_ts).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    asking = left.filter(known).select(*keys, F.col(left_ts).alias("_ts"), F.lit(True).alias("_asked"))
    telling = right.dropna(subset=[*keys, right_ts]).select(*keys, F.col(right_ts).alias("_ts"), held.alias("_held"))
    instants = (
        asking.unionByName(telling, allowMissingColumns=True)
        .groupBy(*keys, "_ts")
        .agg(F.max("_held").alias("_held"), F.max("_asked").alias("_asked"))
        .withColumn("_hour", F.date_trunc("HOUR", F.col("_ts")))
    )
    group = [*keys, "_hour"]
    inside = (
        Window.partitionBy(*group)
        .orderBy("_ts")
        .rowsBetween(Window.unboundedPreceding, -1 if strict else Window.currentRow)
    )
    found = (
        instants.withColumn("_hit", F.last("_held", ignorenulls=True).over(inside))
        .filter("_asked")
        .select(*group, "_ts", "_hit")
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_hour")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    per_hour = instants.groupBy(*group).agg(F.max("_held").alias("_held"))
    carried = per_hour.select(
        *[F.col(c).alias(f"_c_{c}") for c in group],
        F.last("_held", ignorenulls=True).over(earlier).alias("_carry"),
    ).filter(F.col("_carry").isNotNull())
    answers = found.join(carried, [found[c] == carried[f"_c_{c}"] for c in group], "left").select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_ts"),
        F.coalesce("_hit", "_carry").alias("_answer"),
    )
    on = [left[k] == answers[f"_k_{k}"] for k in keys] + [left[left_ts] == answers["_ts"]]
    matched = left.filter(known).join(answers, on, "left")
    names = {c: c if c not in left.columns else f"asof_{c}" for c in payload}
    types = {f.name: f.dataType for f in right.schema.fields}
    out = matched.select(*[left[c] for c in left.columns], *[F.col(f"_answer.{c}").alias(n) for c, n in names.items()])
    unasked = left.filter(~known).select(
        "*", *[F.lit(None).cast(types[c]).alias(n) for c, n in names.items()]
    )
    return out.unionByName(unasked)


def status_at(
    df: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    created: str,
    closing: str,
    payload: Sequence[str],
) -> DataFrame:
    """Payload of the newest version created between a row's own creation and its closing date.

    The newest version at or before the closing date is looked up; when it is older than the row
    itself there is none in the interval.
    """
    marked = versions.withColumn("_version_created", F.col(created))
    out = asof_latest(df, marked, keys, closing, created, [*payload, "_version_created"])
    names = [c if c not in df.columns else f"asof_{c}" for c in payload]
    inside = F.col("_version_created") >= F.col(created)
    return out.withColumns({c: F.when(inside, F.col(c)) for c in names}).drop("_version_created")


def freeze_snapshot(df: DataFrame, keys: Sequence[str], created: str, freeze: str) -> DataFrame:
    """Rows whose creation is the newest of their key strictly before the row's own freeze date.

    Rows without a freeze date are dropped.
    """
    asked = df.select(*keys, freeze).dropna().distinct()
    known = df.select(*keys, created)
    frozen = asof_latest(
        asked, known.withColumn("_frozen", F.col(created)), keys, freeze, created, ["_frozen"],
        strict=True,
    ).select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(freeze).alias("_f"), "_frozen")
    on = all_equal(
        [(df[k], frozen[f"_k_{k}"]) for k in keys]
        + [(df[freeze], frozen["_f"]), (df[created], frozen["_frozen"])]
    )
    return df.join(frozen, on, "left_semi")


def rollout_split(
    df: DataFrame,
    rollout: DataFrame,
    unit: str,
    start: str,
    rollout_date: str,
    origin: str,
    old: str,
    new: str,
) -> DataFrame:
    """Old-system rows not yet rolled out on their start, and new-system rows that are.

    A roll-out on or before the start exists exactly when the unit's first one is, so one join to
    the first roll-out of each unit serves both systems and cannot multiply rows. Units are few, so
    the table of their first roll-outs is broadcast and the rows stay where they are.
    """
    first = rollout.groupBy(F.col(unit).alias("_unit")).agg(F.min(rollout_date).alias("_first"))
    out = F.coalesce(F.col("_first") <= F.col(start), F.lit(False))
    keep = ((F.col(origin) == old) & ~out) | ((F.col(origin) == new) & out)
    return df.join(F.broadcast(first), df[unit] == first["_unit"], "left").filter(keep).select(df["*"])


def append_history(
    main: DataFrame, history: DataFrame, keys: Sequence[str], keep_repeats: bool = False
) -> DataFrame:
    """Append rows of an older set; columns either side lacks come back as NULL.

    History rows already in ``main`` are left out unless ``keep_repeats``.
    """
    if not keep_repeats:
        history = history.join(main.select(*keys).distinct(), list(keys), "left_anti")
    return main.unionByName(history, allowMissingColumns=True)
