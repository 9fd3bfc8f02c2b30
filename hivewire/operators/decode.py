"""Decode / validate / encode jobs.

A decode adds typed columns plus one ``reason`` column (NULL = good row); the
caller splits good rows from the quarantine with two filters on the same
plan, so a message log is parsed once per plan.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import json as J
from .devices import BATTERY, DEFAULT_REGISTRY, THERMOSTAT, DeviceType, Field, Registry, Staged

# Registration request record: four required string members.
REGISTER_INFO = DeviceType("RegisterInfo", (Field("groupId", "string"), Field("devId", "string"),
                                            Field("devType", "string"), Field("modulePath", "string")))

# Union of the reading columns of the default types (one row may be decoded
# as any of them); a custom registry adds its own.
READING_COLUMNS = ("deviceId", "value", "unit", "percentage", "status", "timestamp")


def reading_columns(registry: Registry = DEFAULT_REGISTRY) -> list[str]:
    """The reading columns of a registry: the default ones, then its own types' fields."""
    return list(dict.fromkeys([*READING_COLUMNS, *[f.name for t in registry.types for f in t.fields]]))


def reading_schema(registry: Registry = DEFAULT_REGISTRY) -> str:
    """DDL of ``reading_columns``; a field that no type of the registry has is text."""
    kinds = {f.name: f.kind for t in registry.types for f in t.fields}
    return ", ".join(f"`{n}` {'DOUBLE' if kinds.get(n) == 'number' else 'STRING'}" for n in reading_columns(registry))


def parse_with(df: DataFrame, parse: Callable[[Column], tuple[Column, dict[str, Column]]],
               payload: str = "payload") -> DataFrame:
    """Apply a user parse function (payload Column -> (reason, columns))
    to each message; ``reason`` NULL marks a good row."""
    reason, cols = parse(F.col(payload))
    return df.select("*", *[c.alias(n) for n, c in cols.items()], reason.alias("reason"))


def split(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P3 split: (good rows without ``reason``, quarantine rows with it)."""
    return decoded.where("reason IS NULL").drop("reason"), decoded.where("reason IS NOT NULL")


def decode_as(df: DataFrame, dtype: DeviceType, payload: str = "payload") -> DataFrame:
    st = Staged([f.name for f in dtype.fields])
    staged = st.stage(df, payload)
    reason, typed = dtype.decode(st)
    out = st.drop(J.once(staged, *[c.alias(n) for n, c in typed.items()], reason.alias("reason")))
    if "timestamp" in out.columns:
        out = out.withColumn("event_ts", F.expr("try_cast(timestamp AS TIMESTAMP_NTZ)"))
    return out


def decode_thermostat(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Strict thermostat decode (no range check on readings)."""
    return decode_as(df, THERMOSTAT, payload)


def decode_battery(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Strict battery decode; status in the enum, 0 <= percentage <= 100."""
    return decode_as(df, BATTERY, payload)


def decode_by_type(df: DataFrame, type_col: str = "dev_type", payload: str = "payload",
                   registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """Decode each row with the decoder of its device type (CASE over types)."""
    names = reading_columns(registry)
    st = Staged(names)
    staged = st.stage(df, payload)
    per = {t.name: t.decode(st) for t in registry.types}
    tcol = F.col(type_col)
    reason = registry.dispatch(tcol, lambda t: per[t.name][0])
    cols = []
    for n in names:
        c = None
        for t in registry.types:
            if n in per[t.name][1]:
                c = (F.when if c is None else c.when)(tcol == t.name, per[t.name][1][n])
        cols.append((c if c is not None else F.lit(None)).alias(n))
    reason = F.when(~F.coalesce(tcol.isin(*registry.names), F.lit(False)), F.lit("unknown type")).otherwise(reason)
    return st.drop(J.once(staged, *cols, reason.alias("reason"))).withColumn("event_ts", F.expr("try_cast(timestamp AS TIMESTAMP_NTZ)"))


def encode_by_type(df: DataFrame, type_col: str = "dev_type",
                   registry: Registry = DEFAULT_REGISTRY) -> Column:
    """Canonical JSON of a decoded row by its type (NULL: no encoder for the type)."""
    return registry.dispatch(F.col(type_col),
                             lambda t: t.encode({f.name: F.col(f.name) for f in t.fields}))


def decode_register(requests: DataFrame, payload: str = "payload") -> DataFrame:
    """P5: registration JSON -> group_id, dev_id, dev_type, module_path, reason."""
    d = decode_as(requests, REGISTER_INFO, payload)
    return (d.withColumnRenamed("groupId", "group_id").withColumnRenamed("devId", "dev_id")
            .withColumnRenamed("devType", "dev_type").withColumnRenamed("modulePath", "module_path"))


def filter_known_types(decoded: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """Accepted iff the type is registered; else 'INVALID DEVICE NAME'."""
    known = F.col("dev_type").isin(*registry.names)
    return (decoded.withColumn("accepted", known)
            .withColumn("error", F.when(~known, F.lit(K.INVALID_DEVICE_NAME))))
