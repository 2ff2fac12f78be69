"""Table contracts: declared columns, types, required fields and partitioning."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.functions.casts import safe_cast


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    comment: str = ""


@dataclass(frozen=True)
class Contract:
    name: str
    fields: Sequence[Field]
    partition_by: Sequence[str] = ()
    comment: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        """Spark schema; comments travel as column metadata."""
        return T.StructType(
            [
                T.StructField(
                    f.name,
                    T.DataType.fromDDL(f.type),
                    not f.required,
                    {"comment": f.comment} if f.comment else None,
                )
                for f in self.fields
            ]
        )

    def create_schema(self) -> str | None:
        """CREATE SCHEMA text for the schema that the table's name lies in."""
        schema, _, _ = self.name.rpartition(".")
        return f"CREATE SCHEMA IF NOT EXISTS {schema}" if schema else None

    def create_table(self, location: str | None = None, provider: str = "parquet") -> str:
        """CREATE TABLE text for ``spark.sql``."""
        cols = ",\n  ".join(
            f"`{f.name}` {f.type}"
            + (" NOT NULL" if f.required else "")
            + (f" COMMENT {quoted(f.comment)}" if f.comment else "")
            for f in self.fields
        )
        parts = [f"CREATE TABLE IF NOT EXISTS {self.name} (\n  {cols}\n)", f"USING {provider}"]
        if self.partition_by:
            parts.append(f"PARTITIONED BY ({', '.join(self.partition_by)})")
        if location:
            parts.append(f"LOCATION {quoted(location)}")
        if self.comment:
            parts.append(f"COMMENT {quoted(self.comment)}")
        if self.properties:
            props = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in self.properties.items())
            parts.append(f"TBLPROPERTIES ({props})")
        return "\n".join(parts)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Declared columns in order and type; values that do not fit become NULL, absent columns too.

    Rows that leave a required field NULL are dropped here and reported by ``violations``.
    """
    required = [f.name for f in contract.fields if f.required]
    typed = _typed(df, contract)
    return typed.dropna(subset=required) if required else typed


def _value(df: DataFrame, f: Field) -> Column:
    return safe_cast(F.col(f.name), f.type, df.schema[f.name].dataType)


def _typed(df: DataFrame, contract: Contract) -> DataFrame:
    return df.select(
        *[
            (_value(df, f) if f.name in df.columns else F.lit(None).cast(f.type)).alias(f.name)
            for f in contract.fields
        ]
    )


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per broken rule: column, rule (required / type) and the number of rows.

    All columns are checked in one pass over the data.
    """
    checks = []
    for f in contract.fields:
        col = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.required:
            checks.append((f.name, "required", col.isNull()))
        if f.name in df.columns:
            checks.append((f.name, "type", col.isNotNull() & _value(df, f).isNull()))
    counts = df.agg(
        *[F.count(F.when(bad, 1)).alias(f"_{i}") for i, (_, _, bad) in enumerate(checks)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(r).alias("rule"), F.col(f"_{i}").alias("n_rows")
            )
            for i, (c, r, _) in enumerate(checks)
        ]
    )
    return counts.select(F.explode(rows).alias("_r")).select("_r.*").filter("n_rows > 0")


def violating_rows(df: DataFrame, contract: Contract, name: str = "violations") -> DataFrame:
    """Rows that break the contract, each with the list of rules it breaks."""
    found = []
    for f in contract.fields:
        col = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.required:
            found.append(F.when(col.isNull(), F.lit(f"required:{f.name}")))
        if f.name in df.columns:
            wrong = col.isNotNull() & _value(df, f).isNull()
            found.append(F.when(wrong, F.lit(f"type:{f.name}")))
    broken = reduce(lambda a, b: a | b, [c.isNotNull() for c in found])
    return df.filter(broken).withColumn(name, F.concat_ws(",", *found))


# ---- change of a contract --------------------------------------------------------------------

WIDER = ("tinyint", "smallint", "int", "bigint")
CHECKED = ("drop", "narrow", "tighten", "partition")


@dataclass(frozen=True)
class Change:
    """One difference: ``add``, ``drop``, ``widen``, ``narrow``, ``tighten``, ``loosen``, ``comment``, ``partition`` or ``property``."""

    kind: str
    column: str
    before: str = ""
    after: str = ""

    @property
    def breaks(self) -> bool:
        """Readers or stored rows may not survive it."""
        return self.kind in CHECKED


class Refused(ValueError):
    """A migration with changes that were not allowed."""


def widens(before: str, after: str) -> bool:
    """True when every value of the first type is one of the second."""
    a, b = T.DataType.fromDDL(before), T.DataType.fromDDL(after)
    x, y = a.simpleString(), b.simpleString()
    if x == y or y == "string":
        return True
    if isinstance(b, T.DecimalType):
        digits = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}.get(x)
        whole, scale = (a.precision - a.scale, a.scale) if isinstance(a, T.DecimalType) else (digits, 0)
        return whole is not None and b.precision - b.scale >= whole and b.scale >= scale
    if x in WIDER:
        return y in WIDER[WIDER.index(x) :] or (y == "double" and x != "bigint") or (y == "float" and x in WIDER[:2])
    return (x, y) in (("float", "double"), ("date", "timestamp_ntz"))


def compare(before: Contract, after: Contract) -> list[Change]:
    """What has to change for a table of the first contract to follow the second."""
    old, new = ({f.name: f for f in c.fields} for c in (before, after))
    out = [Change("drop", n, old[n].type) for n in old if n not in new]
    for n, f in new.items():
        if n not in old:
            out.append(Change("add", n, "", f.type))
            if f.required:
                out.append(Change("tighten", n, "absent", "required"))
            continue
        was = old[n]
        if T.DataType.fromDDL(was.type) != T.DataType.fromDDL(f.type):
            out.append(Change("widen" if widens(was.type, f.type) else "narrow", n, was.type, f.type))
        if f.required != was.required:
            out.append(Change("tighten" if f.required else "loosen", n, *(("optional", "required") if f.required else ("required", "optional"))))
        if f.comment != was.comment:
            out.append(Change("comment", n, was.comment, f.comment))
    if list(before.partition_by) != list(after.partition_by):
        out.append(Change("partition", "", ",".join(before.partition_by), ",".join(after.partition_by)))
    if before.comment != after.comment:
        out.append(Change("comment", "", before.comment, after.comment))
    for k in sorted({*before.properties, *after.properties}):
        if before.properties.get(k) != after.properties.get(k):
            out.append(Change("property", k, before.properties.get(k, ""), after.properties.get(k, "")))
    return out


def create(spark: SparkSession, contract: Contract, location: str | None = None, provider: str = "parquet") -> None:
    """Schema and table of a contract, with its comments in the catalog."""
    if schema := contract.create_schema():
        spark.sql(schema)
    spark.sql(contract.create_table(location, provider))


def migrate(spark: SparkSession, before: Contract, after: Contract, allow: Sequence[str] = ()) -> list[Change]:
    """Bring the table of ``before`` to ``after``, which has the same name, and return what was changed.

    Columns are added, comments and properties set in the catalog. Other changes rewrite the table
    beside the old one, which then gives up its name. What breaks readers or rows (dropping,
    narrowing, tightening, other partitions) is refused unless its kind is in ``allow``; even then
    a rewrite is refused where stored rows do not fit the new contract, rather than losing them.
    """
    changes = compare(before, after)
    if held := [c for c in changes if c.breaks and c.kind not in allow]:
        raise Refused("; ".join(f"{c.kind} {c.column or 'table'}: {c.before} -> {c.after}" for c in held))
    rewrite = {"drop", "widen", "narrow", "tighten", "loosen", "partition"}
    if any(c.kind in rewrite for c in changes):
        _rewrite(spark, before, after)
        return changes
    fields = {f.name: f for f in after.fields}
    for c in changes:
        if c.kind == "add":
            note = f" COMMENT {quoted(fields[c.column].comment)}" if fields[c.column].comment else ""
            spark.sql(f"ALTER TABLE {after.name} ADD COLUMNS (`{c.column}` {c.after}{note})")
        elif c.kind == "comment" and c.column:
            spark.sql(f"ALTER TABLE {after.name} ALTER COLUMN `{c.column}` COMMENT {quoted(c.after)}")
        elif c.kind == "comment":
            spark.sql(f"COMMENT ON TABLE {after.name} IS {quoted(c.after)}")
        elif c.after:
            spark.sql(f"ALTER TABLE {after.name} SET TBLPROPERTIES ({quoted(c.column)} = {quoted(c.after)})")
        else:
            spark.sql(f"ALTER TABLE {after.name} UNSET TBLPROPERTIES IF EXISTS ({quoted(c.column)})")
    return changes


def _rewrite(spark: SparkSession, before: Contract, after: Contract) -> None:
    stored = spark.read.table(before.name)
    if bad := violations(stored, after).collect():  # one row per broken rule
        raise Refused("; ".join(f"{r['n_rows']} rows break {r['rule']} of {r['column']}" for r in bad))
    mark = uuid.uuid4().hex
    fresh = replace(after, name=f"{after.name}_{mark}")
    create(spark, fresh)
    # partition columns come last in a table
    conform(stored, after).select(*spark.table(fresh.name).columns).write.insertInto(fresh.name)
    old = f"{before.name}_old_{mark}"
    spark.sql(f"ALTER TABLE {before.name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh.name} RENAME TO {after.name}")
    spark.sql(f"DROP TABLE {old}")
