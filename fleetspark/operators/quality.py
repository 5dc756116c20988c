"""Validation, deduplication and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in their types; a missing or unreadable value is null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema], *[x for x in ("_drift", "_seq") if x in have])


def errors(df: DataFrame, required: list[str], types: dict[str, str] | None = None, enums: dict[str, list[str]] | None = None) -> Column:
    """What is wrong with a row: a list of messages."""
    found = [F.when(F.col(k).isNull(), F.lit(f"{k}: required")) for k in required]
    found += [F.when(F.col(k).isNotNull() & F.col(k).try_cast(t).isNull(), F.lit(f"{k}: not {t}")) for k, t in (types or {}).items()]
    found += [F.when(~F.col(k).isin(allowed), F.lit(f"{k}: not allowed")) for k, allowed in (enums or {}).items()]
    return F.array_compact(F.array(*found))


def validate(df: DataFrame, required: list[str], types: dict[str, str] | None = None, enums: dict[str, list[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with ``error`` and the ``raw`` row as JSON."""
    marked = df.withColumn("_errors", errors(df, required, types, enums))
    valid = marked.where(F.size("_errors") == 0).drop("_errors")
    invalid = marked.where(F.size("_errors") > 0).select(F.array_join("_errors", "; ").alias("error"), F.to_json(F.struct(*df.columns)).alias("raw"))
    return valid, invalid


def undeclared(record: str | Column, declared: list[str]) -> Column:
    """Undeclared keys of a map, sorted."""
    return F.sort_array(F.array_except(F.map_keys(record), F.array(*[F.lit(d) for d in declared])))


def drift(record: str | Column, declared: list[str], keys: Column | None = None) -> Column:
    """Undeclared keys of a map of JSON values, sorted, as JSON; null if there are none. ``keys`` are the undeclared ones where a caller has them."""
    r = F.col(record) if isinstance(record, str) else record
    extra = undeclared(r, declared) if keys is None else keys
    entries = F.transform(extra, lambda k: F.struct(k, F.element_at(r, k)))
    return F.when(F.size(extra) > 0, F.to_json(F.map_from_entries(entries)))


def coerce_containers(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text."""
    kinds = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, kinds) else F.col(f.name) for f in df.schema])


def key_text(columns: list[str]) -> Column:
    """The values joined by colons; null reads ``None``."""
    return F.concat_ws(":", *[F.coalesce(F.col(x).cast("string"), F.lit("None")) for x in columns])


def dedup_key(columns: list[str]) -> Column:
    """SHA-256 of the key's text."""
    return F.sha2(key_text(columns), 256)


def _ranked(df: DataFrame, by: list[Column], order: list[Column]) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. The rank is limited before the shuffle, so a hot key sends one row a task."""
    return _ranked(df, [key_text(key)], [F.col(o).asc_nulls_last() for o in order])


def keep_last(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, as upserts want it."""
    return _ranked(df, [F.col(k) for k in key], [F.col(o).desc_nulls_last() for o in order])


def run_stats(df: DataFrame, key: list[str], is_valid: Column, drifted: Column) -> DataFrame:
    """One row: kept, duplicates, invalid, drifted."""
    valid = df.where(is_valid)
    counts = df.agg(F.count_if(~is_valid).alias("invalid"), F.count_if(is_valid).alias("valid"), F.count_if(is_valid & drifted).alias("drifted"))
    kept = valid.select(key_text(key).alias("k")).distinct().agg(F.count("*").alias("kept"))
    return counts.crossJoin(F.broadcast(kept)).select("kept", (F.col("valid") - F.col("kept")).alias("duplicates"), "invalid", "drifted")  # one row each


def orphans(checks: list[tuple[str, DataFrame, str, DataFrame, str, bool]], rows: str | None = None) -> DataFrame:
    """``check_name, orphans``: rows whose key has no parent. (name, child, key, parent, key, optional): null passes if optional.

    A row of a child stands for one, or for as many as its column ``rows`` says.
    """
    out = None
    for name, child, key, parent, parent_key, optional in checks:
        keys = child.select(F.col(key).alias("k"), (F.col(rows) if rows else F.lit(1)).alias("n"))
        keys = keys.where("k IS NOT NULL") if optional else keys
        counts = keys.groupBy("k").agg(F.sum("n").alias("n"))  # a hot key is one row before the join
        lost = counts.join(parent.select(F.col(parent_key).alias("k")).distinct(), "k", "left_anti")
        row = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("orphans")).select(F.lit(name).alias("check_name"), "orphans")
        out = row if out is None else out.unionByName(row)
    return out


def reconcile_orphans(used: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct ids in use that no registry has."""
    return used.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key).distinct(), key, "left_anti")


def ghosts_dropped(packages: DataFrame, null_owner: str) -> DataFrame:
    """Packages without those of the null owner that have a twin of the same name and platform with a real owner."""
    owner = F.coalesce(F.col("owner_id"), F.lit(null_owner))
    real = packages.where(owner != null_owner).select(F.col("display_name").alias("_n"), F.col("platform").alias("_p")).distinct()
    ghost = packages.where(owner == null_owner)
    kept = ghost.join(real, F.col("display_name").eqNullSafe(F.col("_n")) & F.col("platform").eqNullSafe(F.col("_p")), "left_anti")
    return packages.where(owner != null_owner).unionByName(kept)
