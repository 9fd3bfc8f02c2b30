"""Device type registry (X1): per type, the reading schema, a strict decoder
with one reason per failure, a canonical encoder, an optional command
parser and an optional state rule (``fold``).  Everything is a Column
expression, so decoding stays inside whole-stage codegen; a type is plugged in
by adding a ``DeviceType``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import json as J
from .fold import READING, Lift, StateRule, is_kind, merged, stamped


@dataclass(frozen=True)
class Field:
    name: str
    kind: str                   # "string" | "number"
    check: Callable[[Column], Column] | None = None   # extra check on the typed value

    def valid(self, st: "Staged") -> Column:
        k = st.kind(self.name)
        ok = (k == "string") if self.kind == "string" else k.isin("number", "null")
        ok = F.coalesce(ok, F.lit(False))
        if self.check is not None:
            ok = ok & F.coalesce(self.check(self.typed(st)), F.lit(False))
        return ok

    def typed(self, st: "Staged") -> Column:
        k, raw = st.kind(self.name), st.raw(self.name)
        if self.kind == "string":
            return F.when(k == "string", F.try_variant_get(raw, "$", "string"))
        return F.when(k == "number", F.try_variant_get(raw, "$", "double"))


class Staged:
    """Column names of a staged parse: the payload is parsed once into ``_v``,
    each member extracted once into ``_raw_<f>`` with its kind ``_kind_<f>``.
    Staging keeps the parse out of every check (and the generated code small):
    Catalyst does not merge a projection whose costly outputs are used twice."""

    def __init__(self, names):
        self.names = list(dict.fromkeys(names))

    def columns(self, payload: Column) -> list[Column]:
        v = J.parse(payload)
        # parsed and written as {...}: an object (cheaper than inspecting the VARIANT)
        return [v.alias("_v"), F.ltrim(payload).startswith("{").alias("_obj")]

    def members(self) -> list[Column]:
        out = []
        for n in self.names:
            out.append(J.field(F.col("_v"), n).alias(f"_raw_{n}"))
        return out

    def kinds(self) -> list[Column]:
        return [J.scalar_kind(F.col(f"_raw_{n}")).alias(f"_kind_{n}") for n in self.names]

    def raw(self, n: str) -> Column:
        return F.col(f"_raw_{n}")

    def kind(self, n: str) -> Column:
        return F.col(f"_kind_{n}")

    def stage(self, df, payload: str):
        return (df.select("*", *self.columns(F.col(payload)))
                .select("*", *self.members()).select("*", *self.kinds()))

    def drop(self, df):
        return df.drop("_v", "_obj", *[f"_raw_{n}" for n in self.names], *[f"_kind_{n}" for n in self.names])


@dataclass(frozen=True)
class Command:
    """Parses one command VARIANT: returns (valid, reason, number, text)."""
    parse: Callable[[Column], tuple[Column, Column, Column, Column]]


@dataclass(frozen=True)
class DeviceType:
    name: str
    fields: tuple[Field, ...]
    # Constructor invariant checked after all fields decoded: (predicate, reason).
    invariant: tuple[Callable[[dict[str, Column]], Column], str] | None = None
    command: Command | None = None
    # What readings and executed commands make of the device (None: no state).
    state: StateRule | None = None

    def decode(self, st: Staged) -> tuple[Column, dict[str, Column]]:
        """Strict decode over staged members: (reason or NULL, typed columns).

        Reasons in decode order: 'malformed' (not a JSON object), then the
        first field that is missing or of the wrong type, then the invariant.
        Extra members are ignored; a JSON null number reads as NULL.
        """
        typed = {f.name: f.typed(st) for f in self.fields}
        reason = F.when(F.col("_v").isNull() | ~F.col("_obj"), F.lit("malformed"))
        for f in self.fields:
            reason = reason.when(~f.valid(st), F.lit(f.name))
        if self.invariant is not None:
            pred, why = self.invariant
            reason = reason.when(~F.coalesce(pred(typed), F.lit(False)), F.lit(why))
        return reason, typed

    def encode(self, typed: dict[str, Column]) -> Column:
        """Canonical compact JSON in field order.  A missing or non-finite
        number is written as JSON null (the reference's writer does the
        same), so every decoded row encodes."""
        cols = []
        for f in self.fields:
            c = typed[f.name]
            if f.kind == "number":
                c = F.when(~(F.isnan(c) | (F.abs(c) == float("inf"))), c)
            cols.append(c.alias(f.name))
        return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})

    @property
    def smart(self) -> bool:
        return self.command is not None


def _thermostat_command(v: Column) -> tuple[Column, Column, Column, Column]:
    name, value = J.field(v, "name"), J.field(v, "value")
    num = J.get_double(value)
    shape = J.is_object(v) & J.is_string(name) & (J.get_string(name) == K.SET) & J.is_number(value)
    in_range = num.between(K.THERMOSTAT_MIN, K.THERMOSTAT_MAX)
    reason = (F.when(~shape, F.lit("unsupported command"))
              .when(~in_range, F.lit(K.THERMOSTAT_RANGE_ERROR)))
    return reason.isNull(), reason, F.when(shape & in_range, num), F.lit(None).cast("string")


def _battery_command(v: Column) -> tuple[Column, Column, Column, Column]:
    name, value = J.field(v, "name"), J.field(v, "value")
    status = J.get_string(value)
    shape = J.is_object(v) & J.is_string(name) & (J.get_string(name) == K.CHANGE_STATUS)
    known = F.coalesce(status.isin(*K.BATTERY_STATUSES), F.lit(False))
    reason = (F.when(~shape, F.lit("unsupported command"))
              .when(~known, F.lit("unknown status")))
    return reason.isNull(), reason, F.lit(None).cast("double"), F.when(shape & known, status)


# A thermostat shows the value of its last event: a reading, or what a command set.
_THERMOSTAT_STATE = StateRule({"expected_value": lambda: F.coalesce("set_value", "value")})


def crossing(prev: Column) -> Column:
    """The status a battery switches to after a reading of ``prev`` (NULL: none)."""
    return F.when(prev <= K.BATTERY_LOW, F.lit(K.CHARGING)).when(prev >= K.BATTERY_HIGH, F.lit(K.DISCHARGING))


def _battery_status() -> Column:
    """'off' while the last command said so; else the later of the last command and
    the last crossing."""
    x, c = merged(K.BATTERY, "cross"), merged(K.BATTERY, "cmd")
    return (F.when(c.isNotNull() & (c.s == K.OFF), F.lit(K.OFF)).when(x.isNotNull() & (c.isNull() | (x.o > c.o)), x.s)
            .when(c.isNotNull(), c.s).otherwise(F.lit(K.BATTERY_INITIAL_STATUS)))


def _battery_percentage() -> Column:
    return F.coalesce("percentage", "expected_percentage")


_BATTERY_STATE = StateRule(
    {"expected_percentage": lambda: F.coalesce(merged(K.BATTERY, "pct"), F.lit(K.BATTERY_INITIAL_PERCENTAGE)),
     "expected_status": _battery_status},
    ((Lift("prev", _battery_percentage, inclusive=False),),
     (Lift("cross", lambda: F.when(is_kind(READING), stamped(crossing(F.coalesce(
         merged(K.BATTERY, "prev"), F.lit(K.BATTERY_INITIAL_PERCENTAGE)))))),
      # the status where an earlier fold ended acts as a command would
      Lift("cmd", lambda: stamped(F.coalesce("new_status", "expected_status"))),
      Lift("pct", _battery_percentage))))

THERMOSTAT = DeviceType(
    K.THERMOSTAT,
    (Field("deviceId", "string"), Field("value", "number"), Field("unit", "string"),
     Field("timestamp", "string")),
    command=Command(_thermostat_command),
    state=_THERMOSTAT_STATE,
)

BATTERY = DeviceType(
    K.BATTERY,
    (Field("deviceId", "string"), Field("percentage", "number"),
     Field("status", "string", lambda s: s.isin(*K.BATTERY_STATUSES)),
     Field("timestamp", "string")),
    invariant=(lambda t: (t["percentage"] >= 0) & (t["percentage"] <= 100), "range"),
    command=Command(_battery_command),
    state=_BATTERY_STATE,
)


@dataclass(frozen=True)
class Registry:
    types: tuple[DeviceType, ...] = field(default_factory=lambda: (THERMOSTAT, BATTERY))

    @property
    def names(self) -> list[str]:
        return [t.name for t in self.types]

    def by_name(self, name: str) -> DeviceType:
        return next(t for t in self.types if t.name == name)

    def dispatch(self, type_col: Column, per_type: Callable[[DeviceType], Column]) -> Column:
        """CASE type WHEN t1 THEN per_type(t1) ... END (NULL for unknown types)."""
        out = None
        for t in self.types:
            out = (F.when if out is None else out.when)(type_col == t.name, per_type(t))
        return out

    @property
    def smart_names(self) -> list[str]:
        return [t.name for t in self.types if t.smart]


DEFAULT_REGISTRY = Registry()
