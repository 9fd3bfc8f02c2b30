"""Device state as a fold over events, pluggable per device type.

A type's ``StateRule`` says, as Column expressions, what an event contributes
(``Lift``: a value and how values merge) and how the merged values give the
expected state (``finish``).  Merging is associative with NULL as the empty
value ("last", "sum", "min", "max"), so a run of events is a small summary, runs
compose, and the fold is the bucketed carry of ``carry``: partial summaries per
(device, time bucket), a prefix over those, the rows of a bucket last.  A hot
device is folded in as many parts as it has buckets, all JVM-side.

A later stage may lift from what earlier stages merged (a threshold crossing
needs the previous percentage).  An event of kind ``STATE`` is a device's state
where an earlier fold ended, with the rule's own outputs in its columns: a
stream continues from it as if it had seen all events.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .carry import DEFAULT_BUCKET_SECONDS, Carry, carry_forward

STATE, READING, COMMAND = -1, 0, 1
ORDER = ["ts", "_kind", "seq"]


@dataclass(frozen=True)
class Lift:
    """``value()`` of an event (NULL: nothing) merged over the device's events up to
    and with this one (``inclusive=False``: before it) as ``merged(name)``."""

    name: str
    value: Callable[[], Column]
    how: str = "last"
    inclusive: bool = True


@dataclass(frozen=True)
class StateRule:
    """``stages`` of lifts, then ``finish``: expected column -> expression."""

    finish: dict[str, Callable[[], Column]]
    stages: tuple[tuple[Lift, ...], ...] = ()


def merged(type_name: str, name: str) -> Column:
    """What the type's lift ``name`` merged to at this event."""
    return F.col(f"_s_{type_name}_{name}")


def is_kind(kind: int) -> Column:
    return F.col("_kind") == kind


def stamped(value: Column) -> Column:
    """A value with its event's place in the order, so that two of them tell which is later."""
    return F.when(value.isNotNull(), F.struct(F.struct(*ORDER).alias("o"), value.alias("s")))


def expected_columns(registry) -> list[str]:
    """Expected-state columns of the registry's types, each once."""
    return list(dict.fromkeys(c for t in registry.types if t.state for c in t.state.finish))


def fold_states(events: DataFrame, keys: list[str], registry, bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``events(keys, dev_type, ts, _kind, seq, ...)`` with the expected state after
    every event, by the rule of its device type (NULL without one)."""
    types = [t for t in registry.types if t.state]
    d, n = events, max([len(t.state.stages) for t in types], default=0)
    for i in range(n):
        carries, lifts = [], []
        for t in types:
            for x in t.state.stages[i] if i < len(t.state.stages) else ():
                lifts.append(F.when(F.col("dev_type") == t.name, x.value()).alias(f"_l_{t.name}_{x.name}"))
                carries.append(Carry(f"_l_{t.name}_{x.name}", f"_s_{t.name}_{x.name}", x.inclusive, x.how))
        d = carry_forward(d.select("*", *lifts), keys, ORDER, carries, ts="ts", bucket_seconds=bucket_seconds, keep_bucket=i < n - 1)
    out = []
    for c in expected_columns(registry):
        value = None
        for t in types:
            if c in t.state.finish:
                value = (F.when if value is None else value.when)(F.col("dev_type") == t.name, t.state.finish[c]())
        out.append(value.alias(c))
    return d.select(*keys, "dev_type", *ORDER, *out)
