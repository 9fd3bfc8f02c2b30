"""Commands (P10, J7, A6, W3).

Dispatch (J7) and validity (P10) are independent: the building forwards any
command of a known device and reports success on publish; the device then
parses it and ignores what it cannot execute.  State is as of the command's
time, like queries.  Expected device state (W3) folds the executed commands
into the readings by the types' state rules (``fold``; no per-device window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import topics as T
from .carry import DEFAULT_BUCKET_SECONDS
from .decode import reading_columns
from .devices import DEFAULT_REGISTRY, Registry
from .envelopes import COMMAND_BODY, explode_commands, explode_envelope, route_to_registered_buildings
from .fold import COMMAND, READING, STATE, expected_columns, fold_states
from .latest import valid_readings
from .registry import DEVICE_KEY

DOC_KEY = ["event_id", "building"]
STATE_KINDS = {"expected_status": "string"}     # other expected columns are numbers


def routed_commands(commands_raw: DataFrame, buildings: DataFrame) -> DataFrame:
    """P8 -> A8 -> J1 for command envelopes."""
    return route_to_registered_buildings(
        explode_envelope(commands_raw, COMMAND_BODY, last_wins=True, keep_text=True), buildings)


def _group_exists(rows: DataFrame, groups: DataFrame) -> DataFrame:
    g = groups.select(F.col("building").alias("_gb"), F.col("group_id").alias("_g"),
                      F.col("created_ts").alias("_gts"), F.lit(True).alias("group_exists"))
    cond = (rows.building == g._gb) & (rows.group_id == g._g) & (g._gts <= rows.ts)
    return (rows.join(g, cond, "left").drop("_gb", "_g", "_gts")
            .withColumn("group_exists", F.coalesce("group_exists", F.lit(False))))


def _with_device(rows: DataFrame, registry_df: DataFrame) -> DataFrame:
    r = registry_df.select(F.col("building").alias("_rb"), F.col("group_id").alias("_rg"),
                           F.col("dev_id").alias("_rd"), "dev_type", "module_path", F.col("reg_ts").alias("_rts"))
    cond = ((rows.building == r._rb) & (rows.group_id == r._rg) & (rows.device_id == r._rd)
            & (r._rts <= rows.ts))
    return rows.join(r, cond, "left").drop("_rb", "_rg", "_rd", "_rts")


def command_rows(routed: DataFrame, groups: DataFrame, registry_df: DataFrame,
                 registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """Every command of every routed document with its group's existence and
    its dispatch (``ok``, ``message``, topic and payload); a group without
    commands keeps one row without a device.  The document is exploded once
    and joined once with the groups and once with the devices."""
    rows = _with_device(_group_exists(explode_commands(routed), groups), registry_df)
    smart = F.col("dev_type").isin(*registry.smart_names)
    cmd_text = F.col("command_text")
    message = (F.when(~F.col("group_exists"), F.concat(F.lit(K.GROUP_PREFIX), F.col("group_id"), F.lit(K.DOES_NOT_EXIST)))
               .when(F.col("device_id").isNull(), F.lit(None))
               .when(F.col("dev_type").isNull(),
                     F.concat(F.lit(K.DEVICE_PREFIX), F.col("device_id"), F.lit(K.DOES_NOT_EXIST)))
               .when(~smart, F.concat(F.lit(K.FAILED_TO_PUBLISH), cmd_text, F.lit(" for "), F.col("device_id"),
                                      F.lit(K.NOT_SUPPORTED)))
               .otherwise(F.concat(F.lit(K.PUBLISHED), F.col("device_id"))))
    ok = F.coalesce(F.col("group_exists") & F.col("dev_type").isNotNull() & smart, F.lit(False))
    return rows.select(*DOC_KEY, "ts", "group_pos", "group_id", "group_exists", "device_pos", "device_id",
                       ok.alias("ok"), message.alias("message"),
                       F.when(ok, T.command_topic(F.col("module_path"))).alias("cmd_topic"),
                       F.when(ok, cmd_text).alias("cmd_payload"))


def command_dispatch_status(routed: DataFrame, groups: DataFrame, registry_df: DataFrame,
                            registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """One status per command (and one per missing group).

    Missing group -> 'Group X does not exist' (device_pos NULL); unknown device
    -> 'Device X does not exist'; a type without commands -> 'Failed to
    publish ... Function not Supported'; else published on ``{path}/cmd``.
    """
    return dispatch_statuses(command_rows(routed, groups, registry_df, registry))


def dispatch_statuses(rows: DataFrame) -> DataFrame:
    """J7 over ``command_rows``."""
    exists = F.col("group_exists")
    one_per_group = F.col("device_pos").isNull() | (F.col("device_pos") == 0)
    return (rows.where((exists & F.col("device_id").isNotNull()) | (~exists & one_per_group))
            .withColumn("device_pos", F.when(exists, F.col("device_pos")))
            .withColumn("device_id", F.when(exists, F.col("device_id"))).drop("group_exists"))


def validate_commands(routed: DataFrame, groups: DataFrame, registry_df: DataFrame,
                      registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """P10: per command to a known device, the device-side parse by type:
    thermostat 'set' with a number in [-10, 40]; battery 'change-status'
    with a known status; other types cannot take commands."""
    cmds = explode_commands(routed).where("device_id IS NOT NULL")
    dev = _with_device(cmds, registry_df).where("dev_type IS NOT NULL")
    staged = dev.withColumn("_cmd", F.col("command"))
    parsed = {t.name: t.command.parse(F.col("_cmd")) for t in registry.types if t.smart}
    pick = lambda i: registry.dispatch(F.col("dev_type"), lambda t: parsed[t.name][i] if t.smart else F.lit(None))
    return staged.select(
        *DOC_KEY, "ts", "group_pos", "group_id", "device_pos", "device_id", "dev_type",
        F.coalesce(pick(0), F.lit(False)).alias("valid"),
        F.coalesce(pick(1), F.when(~F.col("dev_type").isin(*registry.smart_names),
                                   F.lit("Function not Supported"))).alias("reason"),
        pick(2).alias("set_value"), pick(3).alias("new_status"))


def gather_command_status(rows: DataFrame) -> DataFrame:
    """A6 over ``command_rows``: device statuses -> one status per group -> one
    per building document.

    Texts keep the reply wording as ``Success(...)`` / ``Error(...)`` items,
    ordered by position; existing groups without commands report
    ``Success([])``."""
    item = F.when(F.col("ok"), F.concat(F.lit("Success("), F.col("message"), F.lit(")"))) \
        .otherwise(F.concat(F.lit("Error("), F.col("message"), F.lit(")")))
    of_device = F.col("group_exists") & F.col("device_id").isNotNull()
    grp = (rows.groupBy(*DOC_KEY, "group_pos", "group_id", "group_exists")
           .agg(F.array_sort(F.collect_list(F.when(of_device, F.struct("device_pos", item.alias("t"))))).alias("items"),
                F.count(F.when(of_device & F.col("ok"), 1)).alias("n_ok"),
                F.count(F.when(of_device & ~F.col("ok"), 1)).alias("n_err")))
    gtext = F.when(~F.col("group_exists"),
                   F.concat(F.lit("Error(" + K.GROUP_PREFIX), F.col("group_id"), F.lit(K.DOES_NOT_EXIST + ")"))) \
        .otherwise(F.concat(F.lit("Success(["), F.array_join(F.transform("items", lambda s: s["t"]), ", "), F.lit("])")))
    return (grp.groupBy(*DOC_KEY)
            .agg(F.array_sort(F.collect_list(F.struct("group_pos", gtext.alias("t")))).alias("g"),
                 F.count(F.lit(1)).alias("n_groups"),
                 F.count(F.when(~F.col("group_exists"), 1)).alias("n_missing_groups"),
                 F.sum("n_ok").alias("n_published"), F.sum("n_err").alias("n_failed"))
            .select(*DOC_KEY, "n_groups", "n_missing_groups", "n_published", "n_failed",
                    F.concat(F.lit("Success(["), F.array_join(F.transform("g", lambda s: s["t"]), ", "),
                             F.lit("])")).alias("status")))


def device_events(valid: DataFrame, validated: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """One log of the devices' valid readings and executed commands, as ``fold`` reads it."""
    readings = valid.select(*DEVICE_KEY, "dev_type", "ts", F.lit(READING).alias("_kind"), F.col("msg_offset").alias("seq"),
                            *reading_columns(registry))
    executed = validated.where("valid").select(
        "building", "group_id", F.col("device_id").alias("dev_id"), "dev_type", "ts",
        F.lit(COMMAND).alias("_kind"), F.col("event_id").alias("seq"), "set_value", "new_status")
    return readings.unionByName(executed, allowMissingColumns=True)


def expected_states(events: DataFrame, registry: Registry = DEFAULT_REGISTRY, state: DataFrame | None = None,
                    bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Expected state after every one of ``events``, continuing from ``state``
    (``DEVICE_KEY, dev_type, ts`` no later than any event of the device, and the
    expected columns; None: from the start)."""
    columns = expected_columns(registry)
    u = events.select("*", *[F.lit(None).cast(STATE_KINDS.get(c, "double")).alias(c) for c in columns])
    if state is not None:
        u = u.unionByName(state.select(*DEVICE_KEY, "dev_type", "ts", F.lit(STATE).alias("_kind"), F.lit(-1).cast("long").alias("seq"),
                                       *columns), allowMissingColumns=True)
    out = fold_states(u, DEVICE_KEY, registry, bucket_seconds).where(F.col("_kind") != STATE)
    return out.select(*DEVICE_KEY, "dev_type", "ts", F.when(F.col("_kind") == READING, F.lit("reading")).otherwise(
        F.lit("command")).alias("kind"), "seq", *columns)


def reconcile_commands(telemetry: DataFrame, routed: DataFrame, groups: DataFrame,
                       registry_df: DataFrame, registry: Registry = DEFAULT_REGISTRY,
                       bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Expected device state after every reading and executed command, by the
    state rule of the device's type.

    Thermostat: the state is the row's own value (a reading, or the 'set'
    value).  Battery: percentage = last reading (100 before any); status =
    'off' while the last command was 'off'; else the last threshold crossing
    after the last command (previous reading <= 20 -> charging, >= 80 ->
    discharging), else the last command's status, else 'discharging'.
    """
    events = device_events(valid_readings(telemetry, registry_df, registry),
                           validate_commands(routed, groups, registry_df, registry), registry)
    return expected_states(events, registry, bucket_seconds=bucket_seconds)
