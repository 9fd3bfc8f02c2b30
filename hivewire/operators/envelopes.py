"""Region envelopes and building documents.

A region document lists (building, body) pairs; a building body is a query
(queryId + groups of device ids) or a command list (groups of (deviceId,
command)).  Decoding is all-or-nothing per document: one bad element sends
the whole document to quarantine.  All work is row-local (higher-order
functions over the document's arrays), so no shuffle is needed until the
join with the building registry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json as J

QUERY_BODY = "groupList"
COMMAND_BODY = "cmdList"


def _entries(v: Column, bl: Column, body: str) -> tuple[Column, Column]:
    elem_ok = lambda e: (J.is_object(e) & J.is_string(J.field(e, "building"))
                         & J.field(e, body).isNotNull())
    ok = v.isNotNull() & J.is_object(v) & bl.isNotNull() & F.coalesce(F.forall(bl, elem_ok), F.lit(False))
    entries = F.transform(bl, lambda e, i: F.struct(
        i.cast("long").alias("pos"),
        J.get_string(J.field(e, "building")).alias("building"),
        J.field(e, body).alias("body")))
    return ok, entries


def last_wins_entries(entries: Column) -> Column:
    """Keep, per building, the entry at the highest position (row-local, n log n)."""
    sorted_ = F.array_sort(entries, lambda l, r: F.when(l.building < r.building, -1)
                          .when(l.building > r.building, 1)
                          .otherwise(F.signum(l.pos - r.pos).cast("int")))
    # the sorted entries as a variable, so that they are sorted once and not per entry
    kept = F.transform(F.array(sorted_), lambda by_key: F.filter(by_key, lambda x, i: (
        (i == F.size(by_key) - 1) | (F.element_at(by_key, i + 2).getField("building") != x.building))))[0]
    return F.array_sort(kept, lambda l, r: F.signum(l.pos - r.pos).cast("int"))


def decode_envelope(docs: DataFrame, body: str, payload: str = "payload") -> DataFrame:
    """Adds ``env_ok`` and ``entries`` (ARRAY<STRUCT<pos, building, body VARIANT>>)."""
    staged = (docs.withColumn("_v", J.parse(F.col(payload)))
              .withColumn("_bl", J.as_array(J.field(F.col("_v"), "buildings"))))
    ok, entries = _entries(F.col("_v"), F.col("_bl"), body)
    return J.once(staged, ok.alias("env_ok")).withColumn("entries", F.when(F.col("env_ok"), entries)).drop("_v", "_bl")


def envelope_quarantine(decoded: DataFrame) -> DataFrame:
    return (decoded.where(~F.col("env_ok"))
            .drop("entries", "env_ok").withColumn("reason", F.lit("malformed envelope")))


def explode_envelope(docs: DataFrame, body: str, last_wins: bool = False,
                     payload: str = "payload", keep_text: bool = False) -> DataFrame:
    """One row per (document, building entry) of good documents.

    ``last_wins`` (A8) keeps the last entry of a building repeated inside one
    document, which is what turning the list into a map does.  ``keep_text``
    adds ``body_text``: each body's own text as sent (numbers keep their
    written form, which a VARIANT does not), from one more parse of the
    document, zipped into the entries before the explode.
    """
    return explode_decoded(decode_envelope(docs, body, payload), body, last_wins, payload, keep_text)


def explode_decoded(decoded: DataFrame, body: str, last_wins: bool = False,
                    payload: str = "payload", keep_text: bool = False) -> DataFrame:
    """``explode_envelope`` over documents that ``decode_envelope`` decoded."""
    d = decoded.where("env_ok")
    entries = F.col("entries")
    if keep_text:
        texts = F.from_json(F.col(payload), f"buildings ARRAY<STRUCT<`{body}`: STRING>>").getField("buildings")
        d = J.once(d, texts.alias("_texts"))
        entries = F.transform(entries, lambda e, i: e.withField(
            "body_text", F.element_at(F.col("_texts"), i + 1).getField(body)))
    if last_wins:
        entries = last_wins_entries(entries)
    keep = [c for c in decoded.columns if c not in (payload, "entries", "env_ok")]
    cols = ["e.pos", "e.building", "e.body"] + (["e.body_text"] if keep_text else [])
    return d.select(*keep, F.explode(entries).alias("e")).select(*keep, *cols)


def route_to_registered_buildings(entries: DataFrame, buildings: DataFrame) -> DataFrame:
    """Left-semi join with the building registry; unknown buildings vanish.

    The registry side is one row per building; AQE turns this into a
    broadcast join at run time when the measured side is small, otherwise it
    stays a shuffled semi-join, so nothing unbounded is broadcast.
    """
    return entries.join(buildings.select("building").distinct(), "building", "left_semi")


def route_as_of(entries: DataFrame, instants: DataFrame) -> DataFrame:
    """J1 over buildings that come to exist (``building, since``): an entry is routed
    if its building exists at the document's ``ts``."""
    since = instants.groupBy("building").agg(F.min("since").alias("_since"))
    return entries.join(since, "building").where(F.col("_since") <= F.col("ts")).select(*entries.columns)


# --- building query documents (P7) -----------------------------------------

def _query_ok(b: Column, groups: Column) -> Column:
    group_ok = lambda g: (J.is_object(g) & J.is_string(J.field(g, "group"))
                          & F.coalesce(F.forall(J.as_array(J.field(g, "devices")), J.is_string), F.lit(False)))
    return (J.is_object(b) & J.is_string(J.field(b, "queryId")) & groups.isNotNull()
            & F.coalesce(F.forall(groups, group_ok), F.lit(False)))


def parse_query(entries: DataFrame) -> DataFrame:
    """Adds ``query_ok``, ``query_id`` and ``groups`` ARRAY<STRUCT<group, devices>>."""
    b = F.col("body")
    staged = entries.withColumn("_groups", J.as_array(J.field(b, "groups")))
    groups = F.transform("_groups", lambda g: F.struct(
        J.get_string(J.field(g, "group")).alias("group"),
        F.transform(J.as_array(J.field(g, "devices")), lambda d: J.get_string(d)).alias("devices")))
    return (J.once(staged, _query_ok(b, F.col("_groups")).alias("query_ok"))
            .withColumn("query_id", F.when(F.col("query_ok"), J.get_string(J.field(b, "queryId"))))
            .withColumn("groups", F.when(F.col("query_ok"), groups)).drop("_groups"))


def explode_query_groups(entries: DataFrame) -> DataFrame:
    """One row per requested group (group_pos, group, devices); a query with
    no groups keeps one row with NULL group."""
    p = parse_query(entries).where("query_ok")
    keep = [c for c in entries.columns if c != "body"]
    return (p.select(*keep, "query_id", F.posexplode_outer("groups").alias("group_pos", "g"))
            .select(*keep, "query_id", F.col("group_pos").cast("long").alias("group_pos"),
                    F.col("g.group").alias("group"), F.col("g.devices").alias("devices")))


def explode_query_devices(entries: DataFrame) -> DataFrame:
    """(query_id, group_pos, group, device_pos, device); a group with an
    empty device list keeps one row with NULL device."""
    return devices_of_groups(explode_query_groups(entries))


def devices_of_groups(g: DataFrame) -> DataFrame:
    """P7 second level: one row per requested device of the group rows."""
    keep = [c for c in g.columns if c != "devices"]
    return (g.select(*keep, F.posexplode_outer("devices").alias("device_pos", "device"))
            .withColumn("device_pos", F.col("device_pos").cast("long")))


# --- building command documents (P9) ---------------------------------------

def _commands_ok(b: Column, cmds: Column) -> Column:
    dev_ok = lambda d: (J.is_object(d) & J.is_string(J.field(d, "deviceId"))
                        & J.field(d, "command").isNotNull())
    grp_ok = lambda g: (J.is_object(g) & J.is_string(J.field(g, "groupId"))
                        & F.coalesce(F.forall(J.as_array(J.field(g, "devices")), dev_ok), F.lit(False)))
    return J.is_object(b) & cmds.isNotNull() & F.coalesce(F.forall(cmds, grp_ok), F.lit(False))


def explode_commands(entries: DataFrame) -> DataFrame:
    """(group_pos, group_id, device_pos, device_id, command VARIANT); a
    group with no commands keeps one row with NULL device."""
    b = F.col("body")
    cmds = [J.as_array(J.field(b, "commands")).alias("_cmds")]
    if "body_text" in entries.columns:
        cmds.append(F.from_json("body_text", "commands ARRAY<STRUCT<devices: ARRAY<STRUCT<command: STRING>>>>")
                    .getField("commands").alias("_texts"))
        text_of = lambda gi, di: F.element_at(F.element_at(F.col("_texts"), gi + 1).getField("devices"),
                                              di + 1).getField("command")
    else:
        text_of = lambda gi, di: F.lit(None).cast("string")
    staged = J.once(entries, *cmds)
    groups = F.transform("_cmds", lambda g, gi: F.struct(
        J.get_string(J.field(g, "groupId")).alias("group_id"),
        F.transform(J.as_array(J.field(g, "devices")), lambda d, di: F.struct(
            J.get_string(J.field(d, "deviceId")).alias("device_id"),
            J.field(d, "command").alias("command"),
            F.coalesce(text_of(gi, di), F.to_json(J.field(d, "command"))).alias("command_text"))).alias("devices")))
    keep = [c for c in entries.columns if c not in ("body", "body_text")]
    p = staged.where(_commands_ok(b, F.col("_cmds"))).select(*keep, groups.alias("groups"))
    g = (p.select(*keep, F.posexplode_outer("groups").alias("group_pos", "g"))
         .select(*keep, F.col("group_pos").cast("long").alias("group_pos"),
                 F.col("g.group_id").alias("group_id"), F.col("g.devices").alias("devices")))
    return (g.select(*keep, "group_pos", "group_id", F.posexplode_outer("devices").alias("device_pos", "d"))
            .select(*keep, "group_pos", "group_id", F.col("device_pos").cast("long").alias("device_pos"),
                    F.col("d.device_id").alias("device_id"), F.col("d.command").alias("command"),
                    F.col("d.command_text").alias("command_text")))


def commands_quarantine(entries: DataFrame) -> DataFrame:
    staged = entries.withColumn("_cmds", J.as_array(J.field(F.col("body"), "commands")))
    return (staged.where(~_commands_ok(F.col("body"), F.col("_cmds"))).drop("body", "_cmds")
            .withColumn("reason", F.lit("malformed cmdList")))


def query_quarantine(entries: DataFrame) -> DataFrame:
    staged = entries.withColumn("_groups", J.as_array(J.field(F.col("body"), "groups")))
    return (staged.where(~_query_ok(F.col("body"), F.col("_groups"))).drop("body", "_groups")
            .withColumn("reason", F.lit("malformed groupList")))


def explode_command_groups(entries: DataFrame) -> DataFrame:
    """One row per group entry of a good command document (group_pos, group_id)."""
    b = F.col("body")
    staged = entries.withColumn("_cmds", J.as_array(J.field(b, "commands")))
    keep = [c for c in entries.columns if c != "body"]
    ids = F.transform("_cmds", lambda g: J.get_string(J.field(g, "groupId")))
    p = staged.where(_commands_ok(b, F.col("_cmds"))).select(*keep, ids.alias("_ids"))
    return (p.select(*keep, F.posexplode_outer("_ids").alias("group_pos", "group_id"))
            .withColumn("group_pos", F.col("group_pos").cast("long")))
