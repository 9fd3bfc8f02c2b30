"""DuckDB oracle SQL, one statement per registered query.

Feeds use the very same SQL text as the Spark feeds; everything after that
is written independently with DuckDB's own JSON functions (``json_valid``,
``json_type``, ``json_extract``), windows and ``ASOF JOIN``.  Lists are
compared as text joined in position order.
"""

from __future__ import annotations

from ..functions import constants as K
from ..sources import feeds as FD

TYPES = (K.THERMOSTAT, K.BATTERY)
TYPES_X = (K.THERMOSTAT, K.BATTERY, "toaster")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def kind(j: str, path: str = "$") -> str:
    return (f"(CASE json_type({j}, '{path}') WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'number' "
            f"WHEN 'UBIGINT' THEN 'number' WHEN 'HUGEINT' THEN 'number' WHEN 'DOUBLE' THEN 'number' "
            f"WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'bool' WHEN 'OBJECT' THEN 'object' "
            f"WHEN 'ARRAY' THEN 'array' END)")


def jstr(j: str, path: str) -> str:
    return f"(CASE WHEN {kind(j, path)} = 'string' THEN json_extract_string({j}, '{path}') END)"


def jnum(j: str, path: str) -> str:
    return f"(CASE WHEN {kind(j, path)} = 'number' THEN CAST(json_extract({j}, '{path}') AS DOUBLE) END)"


def is_obj(j: str, path: str = "$") -> str:
    return f"coalesce(json_type({j}, '{path}') = 'OBJECT', false)"


def is_arr(j: str, path: str = "$") -> str:
    return f"coalesce(json_type({j}, '{path}') = 'ARRAY', false)"


def alen(j: str, path: str) -> str:
    return f"CAST(CASE WHEN {is_arr(j, path)} THEN json_array_length({j}, '{path}') ELSE 0 END AS BIGINT)"


def elem(j: str, path: str, idx: str) -> str:
    return f"json_extract({j}, concat('{path}[', {idx}, ']'))"


def valid_json(col: str) -> str:
    return f"(CASE WHEN json_valid({col}) THEN {col} END)"


# field specs: (name, 'string'|'number', extra predicate on the typed value or None)
THERMO_FIELDS = (("deviceId", "string", None), ("value", "number", None), ("unit", "string", None),
                 ("timestamp", "string", None))
BATTERY_FIELDS = (("deviceId", "string", None), ("percentage", "number", None),
                  ("status", "string", "{v} IN ('charging', 'discharging', 'off')"), ("timestamp", "string", None))
BATTERY_INVARIANT = "{percentage} BETWEEN 0 AND 100"
TOASTER_FIELDS = (("deviceId", "string", None), ("value", "number", None), ("timestamp", "string", None))
REGISTER_FIELDS = (("groupId", "string", None), ("devId", "string", None), ("devType", "string", None),
                   ("modulePath", "string", None))


def typed(j: str, name: str, k: str) -> str:
    return jstr(j, f"$.{name}") if k == "string" else jnum(j, f"$.{name}")


def reason(j: str, fields, invariant: str | None = None) -> str:
    parts = [f"WHEN {j} IS NULL OR NOT {is_obj(j)} THEN 'malformed'"]
    for name, k, extra in fields:
        kk = kind(j, f"$.{name}")
        ok = f"{kk} = 'string'" if k == "string" else f"{kk} IN ('number', 'null')"
        if extra:
            ok = f"({ok}) AND coalesce({extra.format(v=typed(j, name, k))}, false)"
        parts.append(f"WHEN NOT coalesce({ok}, false) THEN '{name}'")
    if invariant:
        inv = invariant.format(percentage=typed(j, "percentage", "number"))
        parts.append(f"WHEN NOT coalesce({inv}, false) THEN 'range'")
    return "(CASE " + " ".join(parts) + " END)"


def by_type(types, per) -> str:
    """CASE dev_type WHEN t THEN per(t) ... END."""
    return "(CASE dev_type " + " ".join(f"WHEN '{t}' THEN {per(t)}" for t in types) + " END)"


FIELDS_OF = {K.THERMOSTAT: THERMO_FIELDS, K.BATTERY: BATTERY_FIELDS, "toaster": TOASTER_FIELDS}
INVARIANT_OF = {K.BATTERY: BATTERY_INVARIANT}


def type_reason(types, j="j") -> str:
    inner = by_type(types, lambda t: reason(j, FIELDS_OF[t], INVARIANT_OF.get(t)))
    return f"(CASE WHEN dev_type NOT IN ({', '.join(q(t) for t in types)}) THEN 'unknown type' ELSE {inner} END)"


def type_field(types, name, j="j") -> str:
    parts = []
    for t in types:
        for n, k, _ in FIELDS_OF[t]:
            if n == name:
                parts.append(f"WHEN '{t}' THEN {typed(j, n, k)}")
    if not parts:
        return "NULL"
    return "(CASE dev_type " + " ".join(parts) + " END)"


READING_COLS = ("deviceId", "value", "unit", "percentage", "status", "timestamp")


def ctes(types=TYPES) -> str:
    """Common CTEs: feeds, decoded registrations, registry, groups, readings,
    routed query and command documents."""
    tl = ", ".join(q(t) for t in types)
    reading_cols = ", ".join(f"{type_field(types, c)} AS {c}" for c in READING_COLS)
    return f"""
rr AS ({FD.REGISTER_REQUESTS.sql()}),
tr AS ({FD.TELEMETRY_RAW.sql()}),
qr AS ({FD.QUERIES_RAW.sql()}),
cr AS ({FD.COMMANDS_RAW.sql()}),
bl AS ({FD.BUILDINGS_SQL}),
rj AS (SELECT *, {valid_json('payload')} AS j FROM rr),
rd AS (SELECT event_id, ts, building, topic,
              {typed('j', 'groupId', 'string')} AS group_id, {typed('j', 'devId', 'string')} AS dev_id,
              {typed('j', 'devType', 'string')} AS dev_type, {typed('j', 'modulePath', 'string')} AS module_path,
              {reason('j', REGISTER_FIELDS)} AS reason FROM rj),
rgood AS (SELECT * FROM rd WHERE reason IS NULL),
reg AS (SELECT building, group_id, dev_id, dev_type, module_path, ts AS reg_ts, event_id AS reg_event_id
        FROM (SELECT *, row_number() OVER (PARTITION BY building, group_id, dev_id ORDER BY ts, event_id) AS rn
              FROM rgood WHERE dev_type IN ({tl})) WHERE rn = 1),
grp AS (SELECT building, group_id, min(ts) AS created_ts FROM rgood GROUP BY building, group_id),
tj AS (SELECT t.msg_offset, t.ts, t.topic, t.payload, r.building, r.group_id, r.dev_id, r.dev_type, r.reg_ts
       FROM tr t JOIN reg r ON t.topic = r.module_path),
tdec AS (SELECT * EXCLUDE (j) FROM (SELECT *, {reading_cols}, {type_reason(types)} AS reason
         FROM (SELECT *, {valid_json('payload')} AS j FROM tj))),
tvalid AS (SELECT * FROM tdec WHERE reason IS NULL),
j3 AS (SELECT *, false AS retained FROM tdec WHERE ts > reg_ts
       UNION ALL BY NAME
       SELECT * EXCLUDE (rn), true AS retained FROM (
         SELECT *, row_number() OVER (PARTITION BY building, group_id, dev_id ORDER BY ts DESC, msg_offset DESC) AS rn
         FROM tdec WHERE ts <= reg_ts) WHERE rn = 1),
j3valid AS (SELECT * FROM j3 WHERE reason IS NULL),
{envelope_ctes('q', 'qr', 'groupList')},
{envelope_ctes('c', 'cr', 'cmdList')},
qgrp0 AS (SELECT event_id, ts, pos, building, body, gp AS group_pos, {elem('body', '$.groups', 'gp')} AS g
          FROM (SELECT *, unnest(range({alen('body', '$.groups')})) AS gp FROM qroute)),
qdev0 AS (SELECT event_id, ts, pos, building, group_pos, dp AS device_pos, {elem('g', '$.devices', 'dp')} AS d
          FROM (SELECT *, unnest(range({alen('g', '$.devices')})) AS dp FROM qgrp0)),
qbad AS (SELECT DISTINCT event_id, pos FROM (
           SELECT event_id, pos FROM qroute WHERE NOT ({is_obj('body')} AND {kind('body', '$.queryId')} = 'string'
                                                      AND {is_arr('body', '$.groups')})
           UNION ALL SELECT event_id, pos FROM qgrp0 WHERE NOT ({is_obj('g')} AND {kind('g', '$.group')} = 'string'
                                                                 AND {is_arr('g', '$.devices')})
           UNION ALL SELECT event_id, pos FROM qdev0 WHERE coalesce({kind('d')} <> 'string', true))),
qgood AS (SELECT r.*, json_extract_string(body, '$.queryId') AS query_id FROM qroute r
          ANTI JOIN qbad b USING (event_id, pos)),
qgroups AS (SELECT g.event_id, g.ts, g.building, q.query_id, g.group_pos, json_extract_string(g.g, '$.group') AS "group", g.g
            FROM qgrp0 g JOIN qgood q USING (event_id, pos)),
qdevs AS (SELECT g.event_id, g.ts, g.building, g.query_id, g.group_pos, g."group", d.device_pos,
                 json_extract_string(d.d, '$') AS device
          FROM qgroups g JOIN qdev0 d USING (event_id, group_pos)
          UNION ALL
          SELECT event_id, ts, building, query_id, group_pos, "group", NULL, NULL FROM qgroups
          WHERE {alen('g', '$.devices')} = 0),
cgrp0 AS (SELECT event_id, ts, pos, building, body, gp AS group_pos, {elem('body', '$.commands', 'gp')} AS g
          FROM (SELECT *, unnest(range({alen('body', '$.commands')})) AS gp FROM croute)),
cdev0 AS (SELECT event_id, ts, pos, building, group_pos, dp AS device_pos, {elem('g', '$.devices', 'dp')} AS d
          FROM (SELECT *, unnest(range({alen('g', '$.devices')})) AS dp FROM cgrp0)),
cbad AS (SELECT DISTINCT event_id, pos FROM (
           SELECT event_id, pos FROM croute WHERE NOT ({is_obj('body')} AND {is_arr('body', '$.commands')})
           UNION ALL SELECT event_id, pos FROM cgrp0 WHERE NOT ({is_obj('g')} AND {kind('g', '$.groupId')} = 'string'
                                                                 AND {is_arr('g', '$.devices')})
           UNION ALL SELECT event_id, pos FROM cdev0 WHERE NOT ({is_obj('d')} AND {kind('d', '$.deviceId')} = 'string'
                                                                 AND json_type(d, '$.command') IS NOT NULL))),
cgroups AS (SELECT g.event_id, g.ts, g.building, g.group_pos, json_extract_string(g.g, '$.groupId') AS group_id, g.g
            FROM cgrp0 g ANTI JOIN cbad b USING (event_id, pos)),
cgx AS (SELECT c.*, EXISTS (SELECT 1 FROM grp x WHERE x.building = c.building AND x.group_id = c.group_id
                                                    AND x.created_ts <= c.ts) AS group_exists FROM cgroups c),
cdevs AS (SELECT g.event_id, g.ts, g.building, g.group_pos, g.group_id, d.device_pos,
                 json_extract_string(d.d, '$.deviceId') AS device_id, json_extract(d.d, '$.command') AS command
          FROM cgroups g JOIN cdev0 d USING (event_id, group_pos)),
cknown AS (SELECT d.*, r.dev_type, r.module_path FROM cdevs d JOIN reg r
           ON r.building = d.building AND r.group_id = d.group_id AND r.dev_id = d.device_id AND r.reg_ts <= d.ts)
"""


def envelope_ctes(p: str, src: str, body: str) -> str:
    """{p}env (all good-document entries), {p}last (last wins), {p}route (+ known buildings)."""
    return f"""{p}j AS (SELECT event_id, ts, {valid_json('payload')} AS j FROM {src}),
{p}el AS (SELECT event_id, ts, i AS pos, {elem('j', '$.buildings', 'i')} AS e
          FROM (SELECT *, unnest(range({alen('j', '$.buildings')})) AS i FROM {p}j
                WHERE {is_obj('j')} AND {is_arr('j', '$.buildings')})),
{p}envbad AS (SELECT DISTINCT event_id FROM {p}el WHERE NOT ({is_obj('e')} AND {kind('e', '$.building')} = 'string'
                                                     AND json_type(e, '$.{body}') IS NOT NULL)),
{p}env AS (SELECT event_id, ts, pos, json_extract_string(e, '$.building') AS building,
                  json_extract(e, '$.{body}') AS body
           FROM {p}el ANTI JOIN {p}envbad USING (event_id)),
{p}last AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id, building ORDER BY pos DESC) AS rn
            FROM {p}env) WHERE rn = 1),
{p}route AS (SELECT * FROM {p}last WHERE building IN (SELECT building FROM bl))"""


def live(sql: str) -> str:
    """The same query with documents routed to the buildings that exist at their time."""
    sql = sql.replace(f"bl AS ({FD.BUILDINGS_SQL})", f"bl AS ({FD.LIVE_BUILDINGS_SQL})")
    for p in ("q", "c"):
        sql = sql.replace(f"{p}route AS (SELECT * FROM {p}last WHERE building IN (SELECT building FROM bl))",
                          f"{p}route AS (SELECT l.* FROM {p}last l JOIN bl ON bl.building = l.building AND bl.since <= l.ts)")
    return sql


def W(body: str, types=TYPES) -> str:
    return "WITH " + ctes(types).strip() + "\n" + body


def _known() -> str:
    return """known AS (SELECT d.*, r.dev_type FROM qdevs d JOIN reg r
             ON r.building = d.building AND r.group_id = d."group" AND r.dev_id = d.device AND r.reg_ts <= d.ts)"""


def _j6() -> str:
    return _known() + """,
j6 AS (SELECT k.*, v.msg_offset AS reading_offset, v.value, v.percentage, v.status, v.unit, v.deviceId, v.timestamp
       FROM known k ASOF LEFT JOIN j3valid v
       ON k.building = v.building AND k."group" = v.group_id AND k.device = v.dev_id AND k.ts >= v.ts),
items AS (SELECT event_id, building, query_id, group_pos, device_pos, 'data' AS kind, "group", device, reading_offset FROM j6
          UNION ALL
          SELECT g.event_id, g.building, g.query_id, g.group_pos, NULL, 'error', g."group", NULL, NULL FROM qgroups g
          WHERE EXISTS (SELECT 1 FROM grp x WHERE x.building = g.building AND x.group_id = g."group" AND x.created_ts <= g.ts)
            AND NOT EXISTS (SELECT 1 FROM known k WHERE k.event_id = g.event_id AND k.building = g.building
                            AND k.group_pos = g.group_pos))"""


def _dispatch(types) -> str:
    smart = (K.THERMOSTAT, K.BATTERY)
    sl = ", ".join(q(t) for t in smart)
    return f"""st AS (
  SELECT event_id, building, group_pos, group_id, CAST(NULL AS BIGINT) AS device_pos, CAST(NULL AS VARCHAR) AS device_id,
         false AS ok, concat('Group ', group_id, ' does not exist') AS message, CAST(NULL AS VARCHAR) AS cmd_topic
  FROM cgx WHERE NOT group_exists
  UNION ALL
  SELECT d.event_id, d.building, d.group_pos, d.group_id, d.device_pos, d.device_id,
         coalesce(r.dev_type IN ({sl}), false) AS ok,
         CASE WHEN r.dev_type IS NULL THEN concat('Device ', d.device_id, ' does not exist')
              WHEN r.dev_type NOT IN ({sl}) THEN concat('Failed to publish command ', CAST(d.command AS VARCHAR),
                   ' for ', d.device_id, '. Reason: Function not Supported')
              ELSE concat('Command published sucessfully for ', d.device_id) END AS message,
         CASE WHEN r.dev_type IN ({sl}) THEN concat(r.module_path, '/cmd') END AS cmd_topic
  FROM cdevs d JOIN cgx g USING (event_id, building, group_pos)
  LEFT JOIN reg r ON r.building = d.building AND r.group_id = d.group_id AND r.dev_id = d.device_id AND r.reg_ts <= d.ts
  WHERE g.group_exists)"""


def _validate() -> str:
    c = "command"
    t_shape = (f"({is_obj(c)} AND {kind(c, '$.name')} = 'string' AND json_extract_string({c}, '$.name') = 'set' "
               f"AND {kind(c, '$.value')} = 'number')")
    t_num = jnum(c, "$.value")
    b_shape = (f"({is_obj(c)} AND {kind(c, '$.name')} = 'string' "
               f"AND json_extract_string({c}, '$.name') = 'change-status')")
    b_known = f"coalesce({jstr(c, '$.value')} IN ('charging', 'discharging', 'off'), false)"
    return f"""pv AS (
  SELECT event_id, ts, building, group_id, group_pos, device_pos, device_id, dev_type,
    CASE dev_type WHEN 'thermostat' THEN {t_shape} AND {t_num} BETWEEN -10 AND 40
                  WHEN 'battery' THEN {b_shape} AND {b_known} ELSE false END AS valid,
    CASE dev_type WHEN 'thermostat' THEN CASE WHEN NOT {t_shape} THEN 'unsupported command'
                                              WHEN NOT ({t_num} BETWEEN -10 AND 40) THEN {q(K.THERMOSTAT_RANGE_ERROR)} END
                  WHEN 'battery' THEN CASE WHEN NOT {b_shape} THEN 'unsupported command'
                                           WHEN NOT {b_known} THEN 'unknown status' END
                  ELSE 'Function not Supported' END AS reason,
    CASE WHEN dev_type = 'thermostat' AND {t_shape} AND {t_num} BETWEEN -10 AND 40 THEN {t_num} END AS set_value,
    CASE WHEN dev_type = 'battery' AND {b_shape} AND {b_known} THEN {jstr(c, '$.value')} END AS new_status
  FROM cknown)"""


def _status_of_w1() -> str:
    return f"""w1 AS (SELECT d.event_id, d.ts, d.building, d.group_id, d.dev_id, d.dev_type,
        concat('/', d.building, '/register/', d.dev_id) AS reply_topic,
        CASE WHEN r.reg_ts IS NULL OR (d.ts, d.event_id) < (r.reg_ts, r.reg_event_id)
             THEN {q(K.COULD_NOT_CREATE + K.INVALID_DEVICE_NAME)}
             WHEN d.event_id = r.reg_event_id THEN 'REGISTERED' ELSE 'DEVICE ALREADY RUNNING' END AS status
      FROM rgood d LEFT JOIN reg r USING (building, group_id, dev_id))"""


def _encode() -> str:
    thermo = ("json_object('deviceId', deviceId, 'value', value, 'unit', unit, 'timestamp', timestamp)")
    batt = ("json_object('deviceId', deviceId, 'percentage', percentage, 'status', status, 'timestamp', timestamp)")
    return f"""enc AS (SELECT msg_offset, building, group_id, dev_id, concat('Data-', building) AS out_topic,
        CAST(CASE dev_type WHEN 'thermostat' THEN {thermo} WHEN 'battery' THEN {batt} END AS VARCHAR) AS json
      FROM j3 WHERE reason IS NULL)"""


def _items_text() -> str:
    return """gq AS (SELECT k.event_id, k.building, k.query_id,
        CAST(count(i.kind) AS BIGINT) AS n_items,
        coalesce(string_agg(concat_ws(':', i.kind, i."group", coalesce(i.device, ''),
                                      coalesce(CAST(i.reading_offset AS VARCHAR), '-')), ';'
                            ORDER BY i.group_pos, i.device_pos) FILTER (WHERE i.kind IS NOT NULL), '') AS items
      FROM qgood k LEFT JOIN items i USING (event_id, building, query_id)
      GROUP BY k.event_id, k.building, k.query_id)"""


def _inventory() -> str:
    doc = "j"
    dev_ok = (f"({is_obj('x')} AND {kind('x', '$.dataSendingPeriod')} IN ('number', 'null') AND {kind('x', '$.deviceType')} = 'string' "
              f"AND {kind('x', '$.deviceId')} = 'string' AND {kind('x', '$.module')} = 'string' "
              f"AND {kind('x', '$.publishingTopic')} = 'string')")
    return f"""dl AS ({FD.DEVICE_LISTS.sql()}),
dj AS (SELECT event_id, {valid_json('payload')} AS j FROM dl),
dx AS (SELECT event_id, j, i AS device_pos, {elem(doc, '$.devices', 'i')} AS x
       FROM (SELECT *, unnest(range({alen(doc, '$.devices')})) AS i FROM dj
             WHERE {is_obj(doc)} AND {kind(doc, '$.buildingId')} = 'string' AND {is_arr(doc, '$.devices')})),
dbad AS (SELECT DISTINCT event_id FROM dx WHERE NOT {dev_ok}),
inv AS (SELECT event_id, json_extract_string(j, '$.buildingId') AS building, device_pos,
               json_extract_string(x, '$.deviceType') AS device_type, json_extract_string(x, '$.deviceId') AS device_id,
               json_extract_string(x, '$.module') AS module, json_extract_string(x, '$.publishingTopic') AS publishing_topic,
               {jnum('x', '$.dataSendingPeriod')} AS period_s
        FROM dx ANTI JOIN dbad USING (event_id))"""


def _battery_w2() -> str:
    return """bw AS (SELECT *, coalesce(last_value(percentage IGNORE NULLS) OVER (
                 PARTITION BY building, group_id, dev_id ORDER BY ts, msg_offset
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 100) AS prev_percentage
      FROM tvalid WHERE dev_type = 'battery'),
bx AS (SELECT *, CASE WHEN prev_percentage <= 20 THEN 'charging' WHEN prev_percentage >= 80 THEN 'discharging' END AS xcross
      FROM bw),
bz AS (SELECT *, coalesce(last_value(xcross IGNORE NULLS) OVER (
                 PARTITION BY building, group_id, dev_id ORDER BY ts, msg_offset
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'discharging') AS expected_status FROM bx)"""


def _w3() -> str:
    part = "PARTITION BY building, group_id, dev_id ORDER BY ts, k, seq"
    return _validate() + f""",
u AS (SELECT building, group_id, dev_id, dev_type, ts, 0 AS k, msg_offset AS seq, value, percentage,
             CAST(NULL AS DOUBLE) AS set_value, CAST(NULL AS VARCHAR) AS new_status FROM tvalid
      UNION ALL
      SELECT building, group_id, device_id, dev_type, ts, 1, event_id, NULL, NULL, set_value, new_status
      FROM pv WHERE valid),
u1 AS (SELECT *, row_number() OVER ({part}) AS o,
              last_value(percentage IGNORE NULLS) OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_pct
       FROM u),
u2 AS (SELECT *, CASE WHEN k = 0 THEN CASE WHEN coalesce(prev_pct, 100) <= 20 THEN 'charging'
                                            WHEN coalesce(prev_pct, 100) >= 80 THEN 'discharging' END END AS xcross FROM u1),
u3 AS (SELECT *,
         max(CASE WHEN xcross IS NOT NULL THEN o END) OVER ({part} ROWS UNBOUNDED PRECEDING) AS xo,
         last_value(xcross IGNORE NULLS) OVER ({part} ROWS UNBOUNDED PRECEDING) AS xs,
         max(CASE WHEN new_status IS NOT NULL THEN o END) OVER ({part} ROWS UNBOUNDED PRECEDING) AS co,
         last_value(new_status IGNORE NULLS) OVER ({part} ROWS UNBOUNDED PRECEDING) AS cs,
         last_value(percentage IGNORE NULLS) OVER ({part} ROWS UNBOUNDED PRECEDING) AS lp
       FROM u2)"""


def _w4() -> str:
    t = FD.GATHER_TIMEOUT_HOURS * 3600
    return f"""greq AS ({FD.GATHER_REQUESTS_SQL}),
grep AS (SELECT r.user_id, r.event_id, r.ts, q.request_ts FROM ({FD.GATHER_REPLIES_SQL}) r JOIN greq q USING (user_id)
         WHERE r.ts > q.request_ts),
gf AS (SELECT *, row_number() OVER w AS rn, lag(ts) OVER w AS prev_ts FROM grep
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
gg AS (SELECT user_id, min(rn) FILTER (WHERE (epoch_us(ts) - epoch_us(coalesce(prev_ts, request_ts))) / 1e6 > {t}) AS first_late,
              count(*) AS n_first FROM gf WHERE rn <= {FD.GATHER_EXPECTED} GROUP BY user_id),
gw AS (SELECT q.user_id, q.request_ts, CAST(coalesce(coalesce(g.first_late - 1, g.n_first), 0) AS BIGINT) AS accepted
       FROM greq q LEFT JOIN gg g USING (user_id))"""


def _two_level() -> str:
    """Idle gathers by windows: a reply is in while no gap up to it was too long."""
    def rule(src: str, name: str, by: str, order: str, seconds: int) -> str:
        return f"""{name}_gap AS (SELECT *, epoch_us(due) - epoch_us(coalesce(lag(due) OVER (PARTITION BY {by} ORDER BY {order}), ts)) AS gap
              FROM {src}),
{name}_in AS (SELECT * FROM (SELECT *, max(gap) OVER (PARTITION BY {by} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS worst FROM {name}_gap)
              WHERE worst <= {seconds} * 1000000)"""
    key = "event_id, building, query_id"
    return f"""resp AS (SELECT j.*, j.ts + to_milliseconds((j.device_pos + 1) * d.delay_ms) AS due
         FROM j6 j JOIN ({FD.REPLY_DELAYS.sql()}) d USING (event_id) WHERE d.delay_ms IS NOT NULL),
{rule("resp", "dev", key + ", group_pos", "due, device_pos", 5)},
ga AS (SELECT {key}, group_pos, count(*) AS n, max(due) AS last FROM dev_in GROUP BY ALL),
ge AS (SELECT {key}, group_pos, count(*) AS n FROM known GROUP BY ALL),
gc AS (SELECT g.{key.replace(", ", ", g.")}, g.ts, g.group_pos, g."group", coalesce(ge.n, 0) AS expected,
              CASE WHEN ge.n IS NULL THEN g.ts WHEN ga.n = ge.n THEN ga.last ELSE coalesce(ga.last, g.ts) + INTERVAL 5 SECOND END AS due
       FROM qgroups g LEFT JOIN ge USING ({key}, group_pos) LEFT JOIN ga USING ({key}, group_pos)
       WHERE EXISTS (SELECT 1 FROM grp x WHERE x.building = g.building AND x.group_id = g."group" AND x.created_ts <= g.ts)),
{rule("gc", "grp", key, "due, group_pos", 10)},
parts AS (SELECT i.{key.replace(", ", ", i.")}, i.group_pos, d.device_pos, concat('data:', d."group", ':', d.device, ':',
                 coalesce(CAST(d.reading_offset AS VARCHAR), '-')) AS text FROM grp_in i JOIN dev_in d USING ({key}, group_pos)
          UNION ALL SELECT {key}, group_pos, NULL, concat('error:', "group", '::-') FROM grp_in WHERE expected = 0),
pt AS (SELECT {key}, count(*) AS n_items, string_agg(text, ';' ORDER BY group_pos, device_pos) AS items FROM parts GROUP BY ALL),
ba AS (SELECT {key}, count(*) AS n, max(due) AS last FROM grp_in GROUP BY ALL),
be AS (SELECT k.{key.replace(", ", ", k.")}, k.ts, count(g.group_pos) AS n FROM qgood k LEFT JOIN qgroups g USING ({key}) GROUP BY ALL),
answered AS (SELECT {key}, CASE WHEN ba.n = be.n THEN ba.last ELSE coalesce(ba.last, be.ts) + INTERVAL 10 SECOND END AS answered_at,
             be.n AS expected_groups, coalesce(ba.n, 0) AS received_groups, coalesce(ba.n = be.n, false) AS complete,
             coalesce(n_items, 0) AS n_items, coalesce(items, '') AS items
             FROM be LEFT JOIN ba USING ({key}) LEFT JOIN pt USING ({key}))"""


def _attempts() -> str:
    seconds = f"INTERVAL {FD.REGISTER_TIMEOUT_SECONDS} SECOND"
    return f"""er AS ({FD.EDGE_REQUESTS.sql()}),
rp AS (SELECT w.event_id, w.building, w.dev_id, w.status IN ('REGISTERED', 'DEVICE ALREADY RUNNING') AS good,
              w.ts + to_milliseconds(e.delay_ms) AS due FROM w1 w JOIN er e USING (event_id) WHERE e.delay_ms IS NOT NULL),
rs AS (SELECT building, dev_id, min(due) AS since FROM rp WHERE good GROUP BY ALL)
SELECT building, dev_id, min(e.ts) AS first_request_ts, any_value(rs.since) AS running_since,
       count(*) FILTER (WHERE since IS NULL OR e.ts < since) AS n_attempts,
       count(*) FILTER (WHERE NOT rp.good AND (since IS NULL OR rp.due < since)) AS n_rejected,
       count(*) FILTER (WHERE (since IS NULL OR e.ts + {seconds} < since) AND (rp.due IS NULL OR rp.due > e.ts + {seconds})) AS n_timeouts,
       CASE WHEN any_value(rs.since) IS NULL THEN 'registering' ELSE 'running' END AS state
FROM er e LEFT JOIN (SELECT event_id, good, due FROM rp) rp USING (event_id) LEFT JOIN rs USING (building, dev_id)
GROUP BY building, dev_id"""


def _plugin() -> str:
    """A type with a number field, a command and a state of its own."""
    c = "command"
    valid = (f"({is_obj(c)} AND {kind(c, '$.name')} = 'string' AND json_extract_string({c}, '$.name') = 'set' "
             f"AND {kind(c, '$.value')} = 'number' AND {jnum(c, '$.value')} BETWEEN 0 AND 100)")
    fields = (("deviceId", "string", None), ("power", "number", None), ("timestamp", "string", None))
    part = "PARTITION BY building, group_id, dev_id ORDER BY ts, k, key ROWS UNBOUNDED PRECEDING"
    feed = FD.TELEMETRY_RAW.sql()
    common = ctes(TYPES_X).strip().replace(f"tr AS ({feed})", f"tr AS (SELECT {', '.join(FD.POWERED_TELEMETRY)} FROM ({feed}))")
    return f"""WITH {common},
{_j6()},
px AS (SELECT *, {jnum('j', '$.power')} AS power, {reason('j', fields)} AS why
       FROM (SELECT msg_offset, ts, building, group_id, dev_id, reg_ts, {valid_json('payload')} AS j FROM tj WHERE dev_type = 'toaster')),
p3 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY building, group_id, dev_id, ts <= reg_ts
                                          ORDER BY ts DESC, msg_offset DESC) AS rn FROM px)
       WHERE (ts > reg_ts OR rn = 1) AND why IS NULL),
pe AS (SELECT building, group_id, dev_id, ts, 0 AS k, msg_offset AS key, power, CAST(NULL AS DOUBLE) AS lim FROM px WHERE why IS NULL
       UNION ALL SELECT building, group_id, device_id, ts, 1, event_id, NULL, {jnum(c, '$.value')} FROM cknown
       WHERE dev_type = 'toaster' AND coalesce({valid}, false))
SELECT 'latest' AS section, building, group_id, dev_id, msg_offset AS key, power AS a, CAST(NULL AS DOUBLE) AS b,
       CAST(NULL AS DOUBLE) AS c, CAST(NULL AS VARCHAR) AS text
FROM (SELECT *, row_number() OVER (PARTITION BY building, group_id, dev_id ORDER BY ts DESC, msg_offset DESC) AS rn FROM p3) WHERE rn = 1
UNION ALL
SELECT 'value', k.building, k."group", k.device, k.event_id, v.power, CAST(v.msg_offset AS DOUBLE), NULL,
       concat_ws(':', k.query_id, k.group_pos, k.device_pos)
FROM (SELECT * FROM known WHERE dev_type = 'toaster') k ASOF LEFT JOIN p3 v
ON k.building = v.building AND k."group" = v.group_id AND k.device = v.dev_id AND k.ts >= v.ts
UNION ALL
SELECT 'result', k.building, NULL, NULL, k.event_id, CAST(count(i.kind) AS DOUBLE), NULL, NULL, k.query_id
FROM qgood k LEFT JOIN items i USING (event_id, building, query_id) GROUP BY k.event_id, k.building, k.query_id
UNION ALL
SELECT 'state', building, group_id, dev_id, key, coalesce(last_value(lim IGNORE NULLS) OVER ({part}), 100),
       coalesce(sum(power) OVER ({part}), 0), max(power) OVER ({part}), CASE WHEN k = 0 THEN 'reading' ELSE 'command' END FROM pe
"""


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["read_topic_log"] = FD.TELEMETRY_RAW.sql()
    o["subscribe_topics"] = (f"SELECT event_id, ts, topic FROM ({FD.REGISTER_REQUESTS.sql()}) "
                             f"WHERE topic IN (SELECT concat('/', building, '/register') FROM ({FD.BUILDINGS_SQL}))")
    o["route_to_topics"] = W(f"""SELECT event_id, pos, building, concat('Query-', building) AS out_topic,
        (CASE WHEN json_type(body, '$.queryId') = 'VARCHAR' THEN json_extract_string(body, '$.queryId') END) AS query_id,
        CAST(NULL AS BIGINT) AS n_groups FROM qroute
        UNION ALL SELECT event_id, pos, building, concat('Command-', building), CAST(NULL AS VARCHAR),
        CAST(CASE WHEN {is_arr('body', '$.commands')} THEN json_array_length(body, '$.commands') END AS BIGINT) FROM croute""")
    o["load_device_inventory"] = f"""WITH {_inventory()}
        SELECT event_id, building, device_pos, device_type, device_id, module, publishing_topic, period_s,
               CASE WHEN device_type IN ('thermostat', 'battery')
                    THEN concat('/', building, '/', module, '/', publishing_topic, '/', device_id) END AS topic,
               CASE WHEN device_type NOT IN ('thermostat', 'battery') THEN 'INVALID DEVICE NAME' END AS error
        FROM inv"""
    o["retained_snapshot"] = f"""SELECT topic, msg_offset, ts, payload FROM (
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY ts DESC, msg_offset DESC) AS rn
        FROM ({FD.TELEMETRY_RAW.sql()})) WHERE rn = 1"""
    o["first_message_per_topic"] = f"""SELECT topic, msg_offset, ts, payload FROM (
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY ts, msg_offset) AS rn
        FROM ({FD.TELEMETRY_RAW.sql()})) WHERE rn = 1"""
    o["decode_thermostat"] = f"""SELECT msg_offset, topic, {', '.join(f'{typed("j", n, k)} AS {n}' for n, k, _ in THERMO_FIELDS)},
        TRY_CAST({typed('j', 'timestamp', 'string')} AS TIMESTAMP) AS event_ts, {reason('j', THERMO_FIELDS)} AS reason
        FROM (SELECT *, {valid_json('payload')} AS j FROM ({FD.TELEMETRY_RAW.sql()}))"""
    o["decode_battery"] = f"""SELECT msg_offset, topic, {', '.join(f'{typed("j", n, k)} AS {n}' for n, k, _ in BATTERY_FIELDS)},
        {reason('j', BATTERY_FIELDS, BATTERY_INVARIANT)} AS reason
        FROM (SELECT *, {valid_json('payload')} AS j FROM ({FD.TELEMETRY_RAW.sql()}))"""
    o["quarantine_telemetry"] = W("SELECT msg_offset, topic, building, group_id, dev_id, dev_type, reason FROM j3 WHERE reason IS NOT NULL")
    o["encode_telemetry"] = "WITH " + ctes().strip() + ",\n" + _encode() + "\nSELECT * FROM enc"
    o["decode_register"] = W("SELECT event_id, building, group_id, dev_id, dev_type, module_path, reason FROM rd")
    o["filter_known_types"] = W("""SELECT event_id, building, dev_id, dev_type, dev_type IN ('thermostat', 'battery') AS accepted,
        CASE WHEN dev_type NOT IN ('thermostat', 'battery') THEN 'INVALID DEVICE NAME' END AS error FROM rgood""")
    o["build_topic_paths"] = W("""SELECT building, group_id, dev_id, module_path AS reading_topic,
        concat(module_path, '/cmd') AS command_topic, concat('/', building, '/register') AS register_topic,
        concat('/', building, '/register/', dev_id) AS register_reply_topic, concat('Data-', building) AS data_topic,
        concat('Query-', building) AS query_topic, concat('Command-', building) AS command_kafka_topic,
        concat('Query-results-', building) AS query_results_topic FROM reg""")
    qid = "(CASE WHEN json_type(body, '$.queryId') = 'VARCHAR' THEN json_extract_string(body, '$.queryId') END)"
    o["explode_query_envelope"] = W(f"SELECT event_id, pos, building, {qid} AS query_id FROM qenv")
    o["envelope_last_wins"] = W(f"SELECT event_id, pos, building, {qid} AS query_id FROM qlast")
    o["route_to_registered_buildings"] = W("SELECT event_id, pos, building FROM qroute")
    o["explode_query_devices"] = W('SELECT event_id, building, query_id, group_pos, "group", device_pos, device FROM qdevs')
    o["explode_command_envelope"] = W(f"""SELECT event_id, pos, building,
        CAST(CASE WHEN {is_arr('body', '$.commands')} THEN json_array_length(body, '$.commands') END AS BIGINT) AS n_groups
        FROM cenv""")
    o["explode_commands"] = W(f"""SELECT g.event_id, g.building, g.group_pos, g.group_id, d.device_pos, d.device_id,
        {jstr('d.command', '$.name')} AS cmd_name, {jnum('d.command', '$.value')} AS cmd_number,
        {jstr('d.command', '$.value')} AS cmd_text
        FROM cgroups g LEFT JOIN cdevs d USING (event_id, group_pos)""")
    o["validate_commands"] = "WITH " + ctes().strip() + ",\n" + _validate() + """
        SELECT event_id, building, group_pos, device_pos, device_id, dev_type, valid, reason, set_value, new_status FROM pv"""
    o["telemetry_of_registered"] = W("SELECT msg_offset, topic, building, group_id, dev_id, dev_type FROM tj")
    o["replay_since_registration"] = W("SELECT msg_offset, ts, topic, building, group_id, dev_id, retained FROM j3")
    o["query_known_devices"] = "WITH " + ctes().strip() + ",\n" + _known() + """
        SELECT event_id, building, query_id, group_pos, "group", device_pos, device, dev_type FROM known"""
    o["query_unknown_groups"] = W("""SELECT event_id, building, query_id, group_pos, "group" FROM qgroups g
        WHERE NOT EXISTS (SELECT 1 FROM grp x WHERE x.building = g.building AND x.group_id = g."group" AND x.created_ts <= g.ts)""")
    o["query_latest_values"] = "WITH " + ctes().strip() + ",\n" + _j6() + """
        SELECT event_id, building, query_id, group_pos, device_pos, device, dev_type, reading_offset,
               reading_offset IS NOT NULL AS has_data, value, percentage, status FROM j6"""
    o["command_dispatch_status"] = "WITH " + ctes().strip() + ",\n" + _dispatch(TYPES) + """
        SELECT * FROM st"""
    o["device_registry"] = W("SELECT * FROM reg")
    o["list_groups"] = W("SELECT * FROM grp")
    o["latest_per_device"] = W("""SELECT building, group_id, dev_id, dev_type, msg_offset, ts, value, unit, percentage, status
        FROM (SELECT *, row_number() OVER (PARTITION BY building, group_id, dev_id ORDER BY ts DESC, msg_offset DESC) AS rn
              FROM j3valid) WHERE rn = 1""")
    o["gather_query_results"] = "WITH " + ctes().strip() + ",\n" + _j6() + ",\n" + _items_text() + "\nSELECT * FROM gq"
    o["gather_completeness"] = W("""SELECT k.event_id, k.building, k.query_id, count(g."group") AS expected_groups,
        count(CASE WHEN EXISTS (SELECT 1 FROM grp x WHERE x.building = g.building AND x.group_id = g."group"
                                AND x.created_ts <= g.ts) THEN 1 END) AS received_groups,
        count(g."group") = count(CASE WHEN EXISTS (SELECT 1 FROM grp x WHERE x.building = g.building AND x.group_id = g."group"
                                AND x.created_ts <= g.ts) THEN 1 END) AND count(g."group") > 0 AS complete
        FROM qgood k LEFT JOIN qgroups g USING (event_id, building, query_id)
        GROUP BY k.event_id, k.building, k.query_id""")
    o["gather_command_status"] = "WITH " + ctes().strip() + ",\n" + _dispatch(TYPES) + """,
        pg AS (SELECT event_id, building, group_pos,
                      string_agg(CASE WHEN ok THEN concat('Success(', message, ')') ELSE concat('Error(', message, ')') END,
                                 ', ' ORDER BY device_pos) AS items,
                      count(*) FILTER (WHERE ok) AS n_ok, count(*) FILTER (WHERE NOT ok) AS n_err
               FROM st WHERE device_pos IS NOT NULL GROUP BY event_id, building, group_pos),
        gt AS (SELECT g.event_id, g.building, g.group_pos, g.group_exists,
                      CASE WHEN NOT g.group_exists THEN concat('Error(Group ', g.group_id, ' does not exist)')
                           ELSE concat('Success([', coalesce(p.items, ''), '])') END AS t, p.n_ok, p.n_err
               FROM cgx g LEFT JOIN pg p USING (event_id, building, group_pos))
        SELECT event_id, building, count(*) AS n_groups, count(*) FILTER (WHERE NOT group_exists) AS n_missing_groups,
               CAST(coalesce(sum(n_ok), 0) AS BIGINT) AS n_published, CAST(coalesce(sum(n_err), 0) AS BIGINT) AS n_failed,
               concat('Success([', string_agg(t, ', ' ORDER BY group_pos), '])') AS status
        FROM gt GROUP BY event_id, building"""
    o["list_buildings"] = f"SELECT DISTINCT region, building FROM ({FD.ALL_BUILDINGS_SQL})"
    o["registration_status"] = "WITH " + ctes().strip() + ",\n" + _status_of_w1() + """
        SELECT event_id, building, group_id, dev_id, reply_topic, status FROM w1"""
    o["device_lifecycle"] = "WITH " + ctes().strip() + ",\n" + _status_of_w1() + """
        SELECT building, dev_id, reply_topic, min(ts) AS first_request_ts,
               min(ts) FILTER (WHERE status IN ('REGISTERED', 'DEVICE ALREADY RUNNING')) AS running_since,
               count(*) AS n_replies,
               count(*) FILTER (WHERE status NOT IN ('REGISTERED', 'DEVICE ALREADY RUNNING')) AS n_rejected,
               CASE WHEN min(ts) FILTER (WHERE status IN ('REGISTERED', 'DEVICE ALREADY RUNNING')) IS NULL
                    THEN 'registering' ELSE 'running' END AS state
        FROM w1 GROUP BY building, dev_id, reply_topic"""
    o["battery_expected_status"] = "WITH " + ctes().strip() + ",\n" + _battery_w2() + """
        SELECT building, group_id, dev_id, msg_offset, percentage, status, prev_percentage, expected_status,
               status = expected_status AS matches FROM bz"""
    o["reconcile_commands"] = "WITH " + ctes().strip() + ",\n" + _w3() + """
        SELECT building, group_id, dev_id, dev_type, CASE WHEN k = 0 THEN 'reading' ELSE 'command' END AS kind, seq,
               CASE WHEN dev_type = 'thermostat' THEN coalesce(set_value, value) END AS expected_value,
               CASE WHEN dev_type = 'battery' THEN coalesce(lp, 100) END AS expected_percentage,
               CASE WHEN dev_type = 'battery' THEN
                 CASE WHEN cs = 'off' THEN 'off'
                      WHEN xs IS NOT NULL AND (co IS NULL OR xo > co) THEN xs
                      WHEN cs IS NOT NULL THEN cs ELSE 'discharging' END END AS expected_status
        FROM u3"""
    o["gather_idle_cutoff"] = f"""WITH {_w4()}
        SELECT user_id, request_ts, accepted, accepted = {FD.GATHER_EXPECTED} AS complete FROM gw"""
    o["gather_two_level"] = "WITH " + ctes().strip() + ",\n" + _j6() + ",\n" + _two_level() + "\nSELECT * FROM answered"
    o["device_attempts"] = "WITH " + ctes().strip() + ",\n" + _status_of_w1() + ",\n" + _attempts()
    o["union_building_feeds"] = "WITH " + ctes().strip() + ",\n" + _encode() + ",\n" + _j6() + ",\n" + _items_text() + """,
        u AS (SELECT building, out_topic, 'data' AS kind, msg_offset AS key FROM enc
              UNION ALL SELECT building, concat('Query-results-', building), 'query-results', event_id FROM gq)
        SELECT b.region, u.building, u.out_topic, u.kind, u.key FROM u JOIN bl b USING (building)"""
    o["merge_building_registry"] = f"""WITH breq AS ({FD.BUILDING_REQUESTS_SQL}), bl AS ({FD.BUILDINGS_SQL}),
        f AS (SELECT region, building, arg_min(event_id, ts) AS first_event_id FROM breq GROUP BY region, building)
        SELECT r.event_id, r.region, r.building,
               (s.building IS NULL AND r.event_id = f.first_event_id) AS ok,
               concat('Building ', r.building, CASE WHEN s.building IS NULL AND r.event_id = f.first_event_id
                      THEN ' registered successfully' ELSE ' is already registered' END) AS message
        FROM breq r JOIN f USING (region, building)
        LEFT JOIN (SELECT DISTINCT region, building FROM bl) s USING (region, building)"""
    o["device_type_registry"] = "WITH " + ctes(TYPES_X).strip() + ",\n" + _dispatch(TYPES_X) + """
        SELECT event_id, building, group_pos, device_pos, device_id, ok, message FROM st WHERE device_pos IS NOT NULL"""
    o["device_type_plugin"] = _plugin()
    o["parse_with"] = f"""SELECT msg_offset, {jstr('j', '$.deviceId')} AS device_id,
        CASE WHEN j IS NULL THEN 'malformed' WHEN coalesce({kind('j', '$.deviceId')} <> 'string', true) THEN 'no device' END AS reason
        FROM (SELECT *, {valid_json('payload')} AS j FROM ({FD.TELEMETRY_RAW.sql()}))"""
    o["gather_with"] = "WITH " + ctes().strip() + ",\n" + _j6() + """
        SELECT event_id, building, query_id,
               count(*) FILTER (WHERE kind = 'data' AND reading_offset IS NOT NULL) AS n_with_data,
               count(*) FILTER (WHERE kind = 'data' AND reading_offset IS NULL) AS n_no_data,
               count(*) FILTER (WHERE kind = 'error') AS n_errors
        FROM items GROUP BY event_id, building, query_id"""
    # Streaming jobs must equal the batch operator they continuously compute.
    same_as = {"committed_sink": "read_topic_log", "stream_ingest": "encode_telemetry",
               "stream_registration": "registration_status", "stream_latest": "latest_per_device",
               "stream_route_envelopes": "route_to_topics", "stream_gather": "gather_idle_cutoff",
               "stream_query_answers": "gather_query_results", "stream_command_status": "gather_command_status",
               "stream_device_state": "reconcile_commands", "stream_two_level_gather": "gather_two_level",
               "stream_device_attempts": "device_attempts"}
    for k, v in same_as.items():
        o[k] = o[v]
    # Streams of documents learn buildings as they register; a device runs from its registration on.
    for k in ("stream_route_envelopes", "stream_query_answers", "stream_command_status", "stream_device_state", "stream_two_level_gather"):
        o[k] = live(o[k])
    o["stream_region_view"] = live("WITH " + ctes().strip() + f""",
        rg AS (SELECT region, building, min(since) AS since FROM (
                 SELECT region, building, TIMESTAMP '0001-01-01' AS since FROM ({FD.BUILDINGS_SQL})
                 UNION ALL SELECT region, building, ts FROM ({FD.BUILDING_REQUESTS_SQL})) GROUP BY region, building),
        u AS (SELECT building, concat('Data-', building) AS out_topic, 'data' AS kind, msg_offset AS key, greatest(ts, reg_ts) AS at
              FROM j3valid
              UNION ALL SELECT building, concat('Query-results-', building), 'query-results', event_id, ts FROM qgood)
        SELECT rg.region, u.building, u.out_topic, u.kind, u.key FROM u JOIN rg ON rg.building = u.building AND rg.since <= u.at""")
    o["stream_device_state"] = o["stream_device_state"].replace("FROM tvalid\n", "FROM tvalid WHERE ts > reg_ts\n")
    return o
