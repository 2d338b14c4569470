"""SQL for DuckDB over the same tables, one text per registered query that SQL can express."""

from __future__ import annotations

NUMBERED = """
numbered AS (
  SELECT event_id, ts, user_id, event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq
  FROM events),
deliveries AS (
  SELECT *, event_id * 10 + CASE WHEN event_id % 31 = 0 THEN 4001 ELSE 0 END AS arrival
  FROM numbered WHERE event_id % 29 <> 0
  UNION ALL
  SELECT *, event_id * 10 + 5005 AS arrival FROM numbered WHERE event_id % 29 <> 0 AND event_id % 37 = 0)"""


def _readings(source: str, extra: str = "") -> str:
    return f"""
  SELECT concat('evt-', CAST(event_id AS VARCHAR)) AS event_id,
         concat('sensor-', CAST(user_id AS VARCHAR)) AS sensor_id,
         CASE WHEN event_id % 11 <> 0 THEN concat('rack-', event_type) END AS rack_id,
         CAST(seq AS DOUBLE) AS sequence, ts,
         value - 20 AS temperature_c,
         CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 100 AS DOUBLE) END AS humidity_pct,
         CAST(event_id % 53 AS DOUBLE) / 10 AS vibration_mm_s, arrival{extra}
  FROM {source}"""


LOG = f"{NUMBERED}, log AS ({_readings('deliveries')})"

MARKED = """
marked AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival) > 1 AS is_duplicate FROM log)"""

# All events, none lost.
NUMBERED_WHOLE = NUMBERED.replace("FROM numbered WHERE event_id % 29 <> 0\n", "FROM numbered\n").replace("event_id % 29 <> 0 AND ", "")
WHOLE = f"{NUMBERED_WHOLE}, log AS ({_readings('deliveries')})"


def _number(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')"


def _round(x: str, decimals: int) -> str:
    return f"(floor(({x}) * {10**decimals}.0 + 0.5) / {10**decimals}.0)"


def _reason(high: str = "80", low: str = "-10", vibration: str = "5") -> str:
    t, v = _number("temperature_c"), _number("vibration_mm_s")
    return f"""concat_ws('; ',
      CASE WHEN temperature_c > {high} THEN concat('temperatureC ', {t}, ' > {high}') END,
      CASE WHEN temperature_c < {low} THEN concat('temperatureC ', {t}, ' < {low}') END,
      CASE WHEN coalesce(vibration_mm_s, 0) > {vibration} THEN concat('vibrationMmS ', {v}, ' > {vibration}') END)"""


def _placed(source: str = "marked", key: str = "sensor_id", order: str = "arrival", duplicates: bool = True) -> str:
    """Previous sequence, status and missing of every record of `source`."""
    counted = "CASE WHEN NOT is_duplicate THEN sequence END" if duplicates else "sequence"
    duplicate = "WHEN is_duplicate THEN 'duplicate'" if duplicates else ""
    return f"""(SELECT *, CASE WHEN status = 'gap' THEN sequence - previous_sequence - 1 ELSE 0 END AS missing FROM (
    SELECT *, CASE {duplicate}
        WHEN previous_sequence <> 0 AND sequence < previous_sequence THEN 'out_of_order'
        WHEN previous_sequence <> 0 AND sequence > previous_sequence + 1 THEN 'gap'
        ELSE 'accepted' END AS status
    FROM (SELECT *, greatest(0, coalesce(max({counted}) OVER (PARTITION BY {key} ORDER BY {order}
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS previous_sequence FROM {source})))"""


LABELLED = f"""
labelled AS (SELECT *, {_reason()} AS reason, status <> 'duplicate' AS applied FROM {_placed()})"""


def _average(x: str) -> str:
    return _round(f"CAST(sum(CAST({x} AS DECIMAL(30,9))) FILTER (WHERE applied) AS DOUBLE) / count(*) FILTER (WHERE applied)", 2)


SENSORS = f"""
sensors AS (
  SELECT sensor_id,
    max_by(rack_id, arrival) FILTER (WHERE applied AND rack_id <> '') AS rack_id,
    count(*) FILTER (WHERE applied) AS readings,
    {_average('temperature_c')} AS avg_temperature_c,
    {_round('min(temperature_c) FILTER (WHERE applied)', 2)} AS min_temperature_c,
    {_round('max(temperature_c) FILTER (WHERE applied)', 2)} AS max_temperature_c,
    {_average('coalesce(humidity_pct, 0)')} AS avg_humidity_pct,
    {_round('greatest(0, max(coalesce(vibration_mm_s, 0)) FILTER (WHERE applied))', 3)} AS max_vibration_mm_s,
    greatest(0, max(sequence) FILTER (WHERE applied)) AS last_sequence,
    max_by(ts, arrival) FILTER (WHERE applied) AS last_event_ts,
    max_by(temperature_c, arrival) FILTER (WHERE applied) AS last_temperature_c,
    count(*) FILTER (WHERE status IN ('gap', 'out_of_order')) AS sequence_gaps,
    count(*) FILTER (WHERE NOT applied) AS duplicates,
    count(*) FILTER (WHERE applied AND reason <> '') AS anomalies
  FROM labelled GROUP BY sensor_id HAVING count(*) FILTER (WHERE applied) > 0)"""

TOTALS = """
totals AS (
  SELECT count(DISTINCT sensor_id) FILTER (WHERE applied) AS sensors,
    count(*) FILTER (WHERE applied) AS readings,
    count(*) FILTER (WHERE NOT applied) AS duplicates,
    count(*) FILTER (WHERE status = 'out_of_order') AS out_of_order,
    count(*) FILTER (WHERE status = 'gap') AS sequence_gaps,
    CAST(sum(missing) AS DOUBLE) AS missing_readings,
    count(*) FILTER (WHERE applied AND reason <> '') AS anomalies
  FROM labelled)"""


def _text(name: str, value: str, quote: str = "") -> str:
    return f"""coalesce(concat(',"{name}":{quote}') || {value} || '{quote}', '')"""


def _json(sequence: str, temperature: str) -> str:
    return f"""concat('{{"schemaVersion":1,"eventId":"', event_id, '","sensorId":"', sensor_id, '"',
      {_text('rackId', 'rack_id', '"')}, ',"sequence":', {sequence},
      ',"ts":"', strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '"', {temperature},
      {_text('humidityPct', 'CAST(humidity_pct AS VARCHAR)')},
      {_text('vibrationMmS', 'CAST(vibration_mm_s AS VARCHAR)')}, '}}')"""


FULL = _json("CAST(sequence AS VARCHAR)", """',"temperatureC":' || CAST(temperature_c AS VARCHAR)""")
INCOMPLETE = _json("""concat('"', CAST(sequence AS VARCHAR), '"')""", "''")

RAW = f"""{NUMBERED_WHOLE},
kinds AS (
  SELECT *, 'good' AS kind FROM deliveries
  UNION ALL SELECT *, event_id * 10 + 7, 'cut' FROM numbered WHERE event_id % 41 = 0
  UNION ALL SELECT *, event_id * 10 + 8, 'incomplete' FROM numbered WHERE event_id % 43 = 0
  UNION ALL SELECT *, event_id * 10 + 9, 'array' FROM numbered WHERE event_id % 47 = 0),
typed AS ({_readings('kinds', ', kind, user_id, event_id AS number')}),
raw AS (
  SELECT 'sensor-readings' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", arrival AS "offset", sensor_id,
    CASE kind WHEN 'good' THEN {FULL} WHEN 'cut' THEN left({FULL}, 20)
      WHEN 'incomplete' THEN {INCOMPLETE} ELSE '[1,2]' END AS payload, number
  FROM typed)"""


FIELDS = {
    "schemaVersion": ("schema_version", "number"),
    "eventId": ("event_id", "string"),
    "sensorId": ("sensor_id", "string"),
    "sequence": ("sequence", "number"),
    "ts": ("ts", "string"),
    "temperatureC": ("temperature_c", "number"),
}
OPTIONAL = {
    "rackId": ("rack_id", "string"),
    "humidityPct": ("humidity_pct", "number"),
    "vibrationMmS": ("vibration_mm_s", "number"),
}


def _checked(source: str) -> str:
    """Every record of `source` with its reason, its errors and its fields, worked out from the payload text."""
    types, values, errors = [], [], []

    def infinite(name: str, column: str, wanted: str) -> str:
        return f"WHEN isinf({column}) THEN '{name} must be a finite number'" if wanted == "number" else ""

    for name, (column, wanted) in {**FIELDS, **OPTIONAL}.items():
        types.append(
            f"""CASE json_type(doc, '$.{name}') WHEN 'NULL' THEN NULL WHEN 'VARCHAR' THEN 'string'
              WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'object'
              ELSE CASE WHEN json_type(doc, '$.{name}') IS NOT NULL THEN 'number' END END AS t_{column}"""
        )
        text = f"json_extract_string(doc, '$.{name}')"
        value = text if wanted == "string" else f"TRY_CAST({text} AS DOUBLE)"
        values.append(f"CASE WHEN t_{column} = '{wanted}' THEN {value} END AS {column}")
    for name, (column, wanted) in FIELDS.items():
        errors.append(
            f"""CASE WHEN t_{column} IS NULL THEN '{name} is required' WHEN t_{column} <> '{wanted}'
              THEN concat('{name} must be a {wanted}, received ', t_{column}) {infinite(name, column, wanted)} END"""
        )
    errors.append("CASE WHEN length(event_id) > 200 THEN 'eventId must be <= 200 characters' END")
    pattern = r"\d{4}-\d{2}-(0[1-9]|[12]\d|3[01])([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?"
    month = "TRY_CAST(concat(left(ts, 8), '01') AS DATE)"
    errors.append(
        f"""CASE WHEN ts IS NOT NULL AND NOT (regexp_full_match(ts, '{pattern}') AND {month} IS NOT NULL)
              THEN 'ts must be an ISO-8601 timestamp' END"""
    )
    # Repeated names: the last one counts, while SQL finds the first. Texts are built so that the repeat comes last.
    listed = f"list_filter([{', '.join(errors)}], lambda e: e IS NOT NULL)"
    return f"""(
  SELECT *, CASE WHEN doc IS NULL THEN 'invalid-json' WHEN len(errors) > 0 THEN 'schema-invalid' END AS reason FROM (
    SELECT *, CASE WHEN doc IS NULL THEN ['payload is not valid JSON']
        WHEN json_type(doc) <> 'OBJECT' THEN ['event must be a JSON object'] ELSE {listed} END AS errors
    FROM (SELECT * EXCLUDE (sensor_id), {', '.join(values)} FROM (
      SELECT *, {', '.join(types)} FROM (
        SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS doc FROM {source})))))"""


CHECKED = f"{RAW}, checked AS (SELECT * FROM {_checked('raw')})"

AUDIT = f"""{CHECKED},
log AS (SELECT *, "offset" AS arrival FROM checked WHERE reason IS NULL),
{MARKED},
audit AS (
  SELECT "partition", "offset", event_id, temperature_c, status, status <> 'duplicate' AND
    (temperature_c > 80 OR temperature_c < -10 OR coalesce(vibration_mm_s, 0) > 5) AS anomalous,
    NULL AS reason, NULL AS errors, NULL AS raw FROM {_placed()}
  UNION ALL
  SELECT "partition", "offset", NULL, NULL, reason, false, reason, array_to_string(errors, '; '), payload
  FROM checked WHERE reason IS NOT NULL)"""

FAILED = "status IN ('invalid-json', 'schema-invalid')"

COUNTED = f"""SELECT count(*) AS consumed, count(*) FILTER (WHERE NOT {FAILED}) AS processed,
  count(*) FILTER (WHERE status = 'duplicate') AS duplicates,
  count(*) FILTER (WHERE status = 'out_of_order') AS out_of_order, count(*) FILTER (WHERE status = 'gap') AS gaps,
  count(*) FILTER (WHERE {FAILED}) AS dead_lettered, count(*) FILTER (WHERE anomalous) AS anomalies_published,
  CAST(1 AS BIGINT) AS batches FROM audit"""


def _json_value(x: str) -> str:
    return f"coalesce({_number(x)}, 'null')"


def _json_string(x: str) -> str:
    return f"""coalesce('"' || {x} || '"', 'null')"""


ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def _anomaly_body(ts: str) -> str:
    return f"""'"eventId":', {_json_string('event_id')}, ',"sensorId":', {_json_string('sensor_id')},
      ',"rackId":', {_json_string('rack_id')}, ',"ts":"', {ts}, '","sequence":', {_json_value('sequence')},
      ',"temperatureC":', {_json_value('temperature_c')}, ',"vibrationMmS":', {_json_value('vibration_mm_s')},
      ',"reason":"', reason, '"'"""


def _object(pairs: dict[str, str]) -> str:
    parts = [f"""'{"," if i else ""}"{name}":', {text}""" for i, (name, text) in enumerate(pairs.items())]
    return f"concat('{{', {', '.join(parts)}, '}}')"


SENSOR_BODY = _object(
    {
        "sensorId": _json_string("sensor_id"),
        "rackId": _json_string("rack_id"),
        "readings": "readings",
        "avgTemperatureC": _json_value("avg_temperature_c"),
        "minTemperatureC": _json_value("min_temperature_c"),
        "maxTemperatureC": _json_value("max_temperature_c"),
        "avgHumidityPct": _json_value("avg_humidity_pct"),
        "maxVibrationMmS": _json_value("max_vibration_mm_s"),
        "lastSequence": _json_value("last_sequence"),
        "lastEventTs": f"""concat('"', {ISO.replace('ts,', 'last_event_ts,')}, '"')""",
        "sequenceGaps": "sequence_gaps",
        "duplicates": "duplicates",
        "anomalies": "anomalies",
    }
)

TOTALS_BODY = _object(
    {
        "sensors": "sensors",
        "readings": "readings",
        "duplicates": "duplicates",
        "outOfOrder": "out_of_order",
        "sequenceGaps": "sequence_gaps",
        "missingReadings": _json_value("missing_readings"),
        "anomalies": "anomalies",
    }
)


def _pad(x: str, width: int) -> str:
    text = _number(x)
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), ' ')"


# The column heads and the words of the last line.
HEAD = "sensor      readings  avgT(C)  minT(C)  maxT(C)  maxVib  gaps  anomalies"

LINE = f"""concat_ws(' ', rpad(sensor_id, CAST(greatest(11, length(sensor_id)) AS INTEGER), ' '), {_pad('readings', 8)},
    {_pad('avg_temperature_c', 7)}, {_pad('min_temperature_c', 8)}, {_pad('max_temperature_c', 8)},
    {_pad('max_vibration_mm_s', 7)}, {_pad('sequence_gaps', 5)}, {_pad('anomalies', 10)})"""

CLOSING = f"""concat('total: ', readings, ' readings, ', anomalies, ' anomalies, ', duplicates, ' duplicates, ',
    out_of_order, ' out-of-order, ', {_number('missing_readings')}, ' missing')"""


def _ordering(name: str, order: str) -> str:
    return f"""SELECT '{name}' AS arrival_order, count(*) FILTER (WHERE status <> 'duplicate') AS readings,
    count(*) FILTER (WHERE status = 'out_of_order') AS out_of_order, count(*) FILTER (WHERE status = 'gap') AS gaps,
    CAST(sum(missing) AS DOUBLE) AS missing FROM {_placed('spread', order=order)}"""


def _kinds() -> str:
    body = """concat('"eventId":"e', event_id, '","sensorId":"s', user_id, '","sequence":', event_id,
      ',"ts":"2026-09-30T10:00:00Z"')"""
    full = f"""concat('{{"schemaVersion":1,', {body}, ',"temperatureC":20.5')"""

    def repeated(name: str, text: str) -> str:
        """The full object with one of its fields given the text of the last repeat."""
        head = """'{"schemaVersion":1,"sensorId":"s', user_id, '","sequence":', event_id, ',"temperatureC":20.5'"""
        other = """',"ts":"2026-09-30T10:00:00Z"'""" if name == "eventId" else """',"eventId":"e', event_id, '"'"""
        return f"""concat({head}, {other}, ',"{name}":"', {text}, '"}}')"""

    return f"""list_value(
      concat({full}, '}}'),
      concat({full}, '}} x'),
      concat({full}, ',"tags":["a","b"],"extra":{{"k":[1]}}}} '),
      concat({full}, ',"tags":[1]}}]'),
      concat('{{', {body}, '}}'),
      concat('{{"schemaVersion":"1","eventId":', event_id, ',"sensorId":true,"sequence":{{}},"ts":[],"temperatureC":null}}'),
      {repeated('eventId', "repeat('x', 201)")},
      {repeated('eventId', "repeat('x', 200)")},
      {repeated('ts', "'yesterday'")},
      {repeated('ts', "'2026-02-30'")},
      {repeated('ts', "'2026-09-30T10:00:00+0200'")},
      {repeated('ts', "'2026-13-01T10:00:00Z'")},
      concat({full}, ',"rackId":7,"humidityPct":"50","vibrationMmS":null}}'),
      concat('"', event_id, '"'),
      CAST(event_id AS VARCHAR),
      'null',
      '',
      concat('[', {full}, '}}]'),
      concat('{{"schemaVersion":1,', {body}, ',"temperatureC":1e999}}'))"""


PADDED = "'sensor-' || lpad(CAST(user_id + 1 AS VARCHAR), CAST(greatest(2, length(CAST(user_id + 1 AS VARCHAR))) AS INTEGER), '0')"


def _padded_number(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), CAST(greatest(6, length(CAST({x} AS VARCHAR))) AS INTEGER), '0')"


ORACLE: dict[str, str] = {
    "dedup_exact": f"WITH {WHOLE}, {MARKED} SELECT event_id, arrival, is_duplicate FROM marked",
    "previous_sequence": f"""WITH {LOG}, {MARKED}
SELECT sensor_id, arrival, sequence, previous_sequence FROM {_placed()} WHERE NOT is_duplicate""",
    "continuity_status": f"""WITH {LOG}, {MARKED}
SELECT event_id, sensor_id, arrival, status, CAST(missing AS DOUBLE) AS missing FROM {_placed()}""",
    "missing_by_sensor": f"""WITH {LOG}, {MARKED}
SELECT sensor_id, CAST(sum(missing) AS DOUBLE) AS missing, count(*) FILTER (WHERE status = 'gap') AS gaps,
  count(*) FILTER (WHERE status = 'out_of_order') AS out_of_order FROM {_placed()} GROUP BY sensor_id""",
    "continuity_by_rack": f"""WITH {LOG}
SELECT rack_id, status, count(*) AS records, CAST(sum(missing) AS DOUBLE) AS missing
FROM {_placed('log', 'rack_id', duplicates=False)} GROUP BY rack_id, status""",
    "continuity_by_sensor_and_type": f"""WITH {LOG}, {MARKED}
SELECT event_id, sensor_id, rack_id, arrival, previous_sequence, status, CAST(missing AS DOUBLE) AS missing
FROM {_placed(key='sensor_id, rack_id')}""",
    "continuity_skewed": f"""WITH log AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE CAST(user_id AS VARCHAR) END AS sensor_id, event_id AS arrival,
    CASE WHEN event_id % 9 = 0 THEN 'again' ELSE concat('e', event_id - event_id % 5) END AS event_id,
    CAST(event_id + (event_id * 7) % 11 AS DOUBLE) AS sequence FROM events),
{MARKED}
SELECT arrival, sensor_id, is_duplicate, previous_sequence, status, CAST(missing AS DOUBLE) AS missing FROM {_placed()}""",
    "continuity_text_order": f"""WITH marked AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE CAST(user_id AS VARCHAR) END AS sensor_id, event_id AS arrival,
    CAST(event_id + (event_id * 7) % 11 AS DOUBLE) AS sequence, concat('line-', event_id * 7919 % 1000003) AS place,
    date_trunc('hour', ts) AS hour FROM events)
SELECT 'place' AS led_by, arrival, previous_sequence, status, CAST(missing AS DOUBLE) AS missing
FROM {_placed(order='place, arrival', duplicates=False)}
UNION ALL SELECT 'hour', arrival, previous_sequence, status, CAST(missing AS DOUBLE)
FROM {_placed(order='hour, place, arrival', duplicates=False)}""",
    "ordering_report": f"""WITH {LOG}, {MARKED},
spread AS (SELECT *, CAST(substr(event_id, 5) AS BIGINT) % 3 AS "partition" FROM marked)
{_ordering('arrival', 'arrival')} UNION ALL {_ordering('partition', '"partition", arrival')}
UNION ALL {_ordering('time', 'ts, arrival')}""",
    "partition_spread": f"""WITH {RAW}
SELECT sensor_id, count(DISTINCT number % 3) AS partitions FROM raw GROUP BY sensor_id
HAVING count(DISTINCT number % 3) > 1""",
    "anomalies": f"""WITH {WHOLE}, {MARKED}, flagged AS (SELECT *, {_reason()} AS reason FROM marked WHERE NOT is_duplicate)
SELECT event_id, sensor_id, rack_id, {ISO} AS ts, sequence, temperature_c, vibration_mm_s, reason
FROM flagged WHERE reason <> ''""",
    "anomalies_standalone": f"""WITH lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS event_id, CAST(l_suppkey AS VARCHAR) AS sensor_id,
    l_returnflag AS rack_id, CAST(l_shipdate AS VARCHAR) AS ts, CAST(l_linenumber AS DOUBLE) AS sequence,
    CAST(l_quantity AS DOUBLE) AS temperature_c,
    CASE WHEN l_discount > 0.03 THEN CAST(l_discount AS DOUBLE) END AS vibration_mm_s FROM lineitem),
flagged AS (SELECT *, {_reason('48', '2', '0.095')} AS reason FROM lines)
SELECT * FROM flagged WHERE reason <> ''""",
    "anomaly_records": f"""WITH {WHOLE}, {MARKED}, flagged AS (SELECT *, {_reason()} AS reason FROM marked WHERE NOT is_duplicate)
SELECT sensor_id AS key, concat('{{"type":"anomaly",', {_anomaly_body(ISO)}, ',"runId":', {_json_string('event_id')}, '}}') AS value,
  'sensor.anomaly' AS event_type FROM flagged WHERE reason <> ''""",
    "sensor_summary": f"""WITH {LOG}, {MARKED}, {LABELLED}, {SENSORS}
SELECT * REPLACE ({ISO.replace('ts,', 'last_event_ts,')} AS last_event_ts) FROM sensors""",
    "log_totals": f"WITH {LOG}, {MARKED}, {LABELLED}, {TOTALS} SELECT * FROM totals",
    "run_stats": f"WITH {AUDIT} {COUNTED}",
    "batch_outcomes": f"""WITH {AUDIT}
SELECT CAST(floor("offset" / 10000) AS BIGINT) AS batch_id, count(*) FILTER (WHERE NOT {FAILED}) AS processed,
  count(*) FILTER (WHERE {FAILED}) AS dead_lettered, count(*) FILTER (WHERE anomalous) AS anomalies,
  count(*) FILTER (WHERE status = 'duplicate') AS duplicates FROM audit GROUP BY 1""",
    "offset_ranges": f"""WITH {RAW}
SELECT topic, "partition", count(*) AS records, min("offset") AS first_offset, max("offset") AS last_offset
FROM raw GROUP BY topic, "partition\"""",
    "decode_payload": """SELECT event_id, CASE WHEN event_id % 53 = 0 THEN ''
  WHEN event_id % 5 = 0 THEN concat('é', event_type, '-', event_id, chr(65533), 'x')
  ELSE concat('é', event_type, '-', event_id) END AS payload FROM events""",
    "json_parse_split": f"""WITH {RAW}
SELECT "partition", "offset", json_valid(payload) AS parsed, CAST(length(payload) AS INTEGER) AS length FROM raw""",
    "validation_errors": f"""WITH {CHECKED}
SELECT "partition", "offset", reason, array_to_string(errors, '; ') AS errors FROM checked""",
    "validation_kinds": f"""WITH raw AS (
  SELECT event_id AS number, NULL AS sensor_id, list_extract({_kinds()}, event_id % 19 + 1) AS payload FROM events),
checked AS (SELECT * FROM {_checked('raw')})
SELECT number, reason, array_to_string(errors, '; ') AS errors, sensor_id, sequence, temperature_c, rack_id FROM checked""",
    "readings_parsed": f"""WITH {CHECKED}
SELECT "partition", "offset", schema_version, event_id, sensor_id, rack_id, sequence, ts, temperature_c, humidity_pct,
  vibration_mm_s FROM checked WHERE reason IS NULL""",
    "dead_letters": f"""WITH {CHECKED}
SELECT 'dead-letter' AS type, reason, array_to_string(errors, '; ') AS errors, topic, "partition", "offset",
  payload AS raw FROM checked WHERE reason IS NOT NULL""",
    "dead_letter_records": f"""WITH {CHECKED}
SELECT concat('p', "partition") AS key,
  concat('{{"type":"dead-letter","reason":"', reason, '","errors":["', array_to_string(errors, '","'),
    '"],"deadLetteredAt":"2026-09-30T10:00:00.000Z","source":{{"topic":"', topic, '","partition":', "partition",
    ',"offset":"', "offset", '"}},"raw":', to_json(payload), '}}') AS value,
  'sensor.reading.dlt' AS event_type, reason FROM checked WHERE reason IS NOT NULL""",
    "dead_letter_raw": """SELECT CASE WHEN json_valid(text) THEN 'schema-invalid' ELSE 'invalid-json' END AS reason,
  md5(text) AS digest, CAST(length(text) AS INTEGER) AS length FROM documents""",
    "audit_log": f"""WITH {AUDIT}
SELECT CASE WHEN {FAILED} THEN 'dead-letter' ELSE 'reading' END AS type,
  CASE WHEN NOT {FAILED} THEN 'sensor-readings' END AS topic,
  CASE WHEN NOT {FAILED} THEN "partition" END AS "partition",
  CASE WHEN NOT {FAILED} THEN CAST("offset" AS VARCHAR) END AS "offset",
  CASE WHEN NOT {FAILED} THEN status END AS status, event_id, temperature_c, reason, errors,
  CASE WHEN {FAILED} THEN "partition" END AS source_partition,
  CASE WHEN {FAILED} THEN CAST("offset" AS VARCHAR) END AS source_offset, raw FROM audit""",
    "message_keys": f"""WITH {WHOLE}
SELECT 'sensor' AS mode, arrival, sensor_id AS key FROM log UNION ALL SELECT 'roundrobin', arrival, NULL FROM log""",
    "message_keys_random": f"""WITH {WHOLE}
SELECT event_id, sensor_id, arrival, substr(md5('20260930-' || event_id), 1, 12) AS key FROM log""",
    "reading_records": f"""WITH {WHOLE}
SELECT sensor_id AS key, concat('{{"schemaVersion":1,"eventId":"', event_id, '","sensorId":"', sensor_id, '"',
    {_text('rackId', 'rack_id', '"')}, ',"sequence":', {_number('sequence')}, ',"ts":"', {ISO},
    '","temperatureC":', {_number('temperature_c')}, {_text('humidityPct', _number('humidity_pct'))},
    {_text('vibrationMmS', _number('vibration_mm_s'))}, '}}') AS value,
  'sensor.reading' AS event_type, '1' AS schema_version, 'telemetry' AS source FROM log""",
    "event_ids": f"""SELECT event_id AS number,
  strftime(ts, '%Y-%m-%dT%H-%M-%S-%g') || 'Z-' || {PADDED} || '-' || {_padded_number('event_id * 97')} AS event_id,
  {PADDED} AS sensor_id, 'rack-' || chr(CAST(65 + user_id % 26 AS INTEGER)) AS rack_id FROM events""",
    "readings_rounded": f"""SELECT CAST(1 AS DOUBLE) AS schema_version,
  'run1-' || {PADDED} || '-' || {_padded_number('event_id')} AS event_id, {PADDED} AS sensor_id,
  concat('rack-', event_type) AS rack_id, CAST(event_id AS DOUBLE) AS sequence, {ISO} AS ts,
  {_round('value / 7 - 20', 2)} AS temperature_c, {_round('value / 8 - 10', 2)} AS humidity_pct,
  {_round('value / 160', 3)} AS vibration_mm_s FROM events""",
    "summary_report": f"""WITH {LOG}, {MARKED}, {LABELLED}, {SENSORS}, {TOTALS}
SELECT 0 AS part, NULL AS sensor_id, '{HEAD}' AS line UNION ALL SELECT 1, sensor_id, {LINE} FROM sensors
UNION ALL SELECT 2, NULL, {CLOSING} FROM totals""",
    "summary_document": f"""WITH {LOG}, {MARKED}, {LABELLED}, {SENSORS}, {TOTALS}
SELECT 'totals' AS section, NULL AS sensor_id, NULL AS arrival, {TOTALS_BODY} AS body FROM totals
UNION ALL SELECT 'thresholds', NULL, NULL, '{{"anomalyHighC":80,"anomalyLowC":-10,"vibrationThresholdMmS":5}}'
UNION ALL SELECT 'sensors', sensor_id, NULL, {SENSOR_BODY} FROM sensors
UNION ALL SELECT 'anomalies', sensor_id, arrival, concat('{{', {_anomaly_body(ISO)}, '}}') FROM labelled
  WHERE applied AND reason <> ''""",
    "stream_summary": f"""WITH {CHECKED}, log AS (SELECT *, "offset" AS arrival FROM checked WHERE reason IS NULL),
{MARKED}, labelled AS (SELECT * EXCLUDE (reason), {_reason()} AS reason, status <> 'duplicate' AS applied FROM {_placed()}),
{SENSORS} SELECT * FROM sensors""",
    "stream_audit": f"""WITH {CHECKED}, log AS (SELECT *, "offset" AS arrival FROM checked WHERE reason IS NULL), {MARKED}
SELECT "partition", "offset", event_id, status, CAST(missing AS DOUBLE) AS missing, nullif({_reason()}, '') AS anomaly
FROM {_placed()}
UNION ALL SELECT "partition", "offset", event_id, reason, NULL, NULL FROM checked WHERE reason IS NOT NULL""",
    "stream_dedup": f"WITH {WHOLE} SELECT DISTINCT event_id FROM log",
}
# The same counters, from as many batches as the stream is cut into.
# Sequences, summaries and totals of each sensor and run.
RUNS = "CAST(substr(event_id, 5) AS BIGINT) // 2500 AS run"
ORACLE["sensor_summary_by_run"] = f"""WITH {LOG.replace(', log AS (', ', unnumbered AS (')}, log AS (SELECT *, {RUNS} FROM unnumbered), {MARKED},
{LABELLED.replace(_placed(), _placed(key='sensor_id, run'))}, {SENSORS.replace('SELECT sensor_id,', 'SELECT sensor_id, run,').replace('GROUP BY sensor_id', 'GROUP BY sensor_id, run')}
SELECT * REPLACE ({ISO.replace('ts,', 'last_event_ts,')} AS last_event_ts) FROM sensors"""

ORACLE["sensor_summary_bucketed"] = ORACLE["sensor_summary"]

ORACLE["summary_positions"] = f"""WITH {LOG}, {MARKED}, {LABELLED}, {SENSORS},
parts AS (SELECT 1 AS part, 'totals' AS section, NULL AS sensor_id, NULL AS arrival UNION ALL SELECT 2, 'thresholds', NULL, NULL
  UNION ALL SELECT 4, 'sensors', sensor_id, NULL FROM sensors
  UNION ALL SELECT 5, 'anomalies', sensor_id, arrival FROM labelled WHERE applied AND reason <> '')
SELECT section, sensor_id, arrival, row_number() OVER (ORDER BY part, CASE WHEN part = 4 THEN sensor_id END, arrival) AS position FROM parts"""

ORACLE["offset_range_scan"] = f"""WITH {RAW}, ends AS (SELECT min("offset") AS low, max("offset") AS high FROM raw)
SELECT "partition", "offset", md5(payload) AS digest FROM raw, ends
WHERE "offset" BETWEEN low + (high - low) // 4 AND low + (high - low) // 2"""

ORACLE["stream_revised"] = f"""WITH {CHECKED.replace('user_id % 3', 'number % 3')}, log AS (SELECT *, "offset" AS arrival FROM checked WHERE reason IS NULL), {MARKED}
SELECT "partition", "offset", event_id, previous_sequence, status, CAST(missing AS DOUBLE) AS missing FROM {_placed()}"""

ORACLE["stream_drop"] = ORACLE["stream_dedup"]

# Batches of a stream are thirds of the offsets.
ORACLE["stream_outcomes"] = f"""WITH {AUDIT},
ends AS (SELECT min("offset") AS low, max("offset") AS high FROM raw)
SELECT CAST(least(2, floor(("offset" - low) * 3 / (high - low + 1))) AS BIGINT) AS batch_id,
  count(*) FILTER (WHERE NOT {FAILED}) AS processed, count(*) FILTER (WHERE {FAILED}) AS dead_lettered,
  count(*) FILTER (WHERE anomalous) AS anomalies, count(*) FILTER (WHERE status = 'duplicate') AS duplicates
FROM audit, ends GROUP BY 1"""


def _any_size_average(x: str) -> str:
    """Sums by band as whole numbers, then one double of them, from the greatest band down."""
    far = f"(SELECT sensor_id, CAST(floor((floor(log2(abs({x}))) - 53) / 32) AS INTEGER) AS band, {x} AS x FROM log WHERE abs({x}) >= 1e12)"
    bands = f"SELECT sensor_id, band, CAST(sum(CAST(x / pow(2.0, band * 32) AS HUGEINT)) AS DOUBLE) * pow(2.0, band * 32) AS part FROM {far} GROUP BY sensor_id, band"
    return f"""(SELECT sensor_id, list_reduce(list_prepend(0::DOUBLE, list(part ORDER BY band DESC)), lambda a, b: a + b) AS far
    FROM ({bands}) GROUP BY sensor_id)"""


ORACLE["average_any_size"] = f"""WITH parts AS (
  SELECT concat('s', (event_id // 2) % 50) AS sensor_id,
    CASE WHEN event_id % 3 = 1 THEN value / pow(2.0::DOUBLE, CAST((event_id * 37) % 1981 - 990 AS DOUBLE)) ELSE value END AS small,
    CASE WHEN event_id % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END * pow(2.0::DOUBLE, CAST((event_id // 2) * 7 % 960 AS DOUBLE)) AS far FROM events),
log AS (SELECT sensor_id, small AS t, small * 3 AS h FROM parts UNION ALL SELECT sensor_id, far, far * 3 FROM parts),
near AS (SELECT sensor_id, count(*) AS readings,
  sum(CASE WHEN abs(t) < 1e12 THEN CAST(t AS DECIMAL(30,9)) END) AS t, sum(CASE WHEN abs(h) < 1e12 THEN CAST(h AS DECIMAL(30,9)) END) AS h
  FROM log GROUP BY sensor_id)
SELECT sensor_id, readings, {_round("(coalesce(a.far, 0) + CAST(t AS DOUBLE)) / readings", 2)} AS avg_temperature_c,
  {_round("(coalesce(b.far, 0) + CAST(h AS DOUBLE)) / readings", 2)} AS avg_humidity_pct
FROM near LEFT JOIN {_any_size_average('t')} a USING (sensor_id) LEFT JOIN {_any_size_average('h')} b USING (sensor_id)"""

ORACLE["stream_stats"] = ORACLE["run_stats"].replace("CAST(1 AS BIGINT) AS batches", "CAST(3 AS BIGINT) AS batches")

_COUNTERS = _object(
    {
        "consumed": "consumed",
        "processed": "processed",
        "duplicates": "duplicates",
        "outOfOrder": "out_of_order",
        "gaps": "gaps",
        "deadLettered": "dead_lettered",
        "anomaliesPublished": "anomalies_published",
        "batches": "batches",
    }
)
# The sections that the end of a stream leaves behind: times as the payloads have them, and the counters of the run.
ORACLE["stream_sections"] = f"""WITH {AUDIT},
labelled AS (SELECT * EXCLUDE (reason), {_reason()} AS reason, status <> 'duplicate' AS applied FROM {_placed()}),
{SENSORS}, {TOTALS},
stats AS ({COUNTED.replace("CAST(1 AS BIGINT) AS batches", "CAST(3 AS BIGINT) AS batches")})
SELECT 'totals' AS section, NULL AS sensor_id, NULL AS arrival, {TOTALS_BODY} AS body FROM totals
UNION ALL SELECT 'thresholds', NULL, NULL, '{{"anomalyHighC":80,"anomalyLowC":-10,"vibrationThresholdMmS":5}}'
UNION ALL SELECT 'consumer', NULL, NULL, {_COUNTERS} FROM stats
UNION ALL SELECT 'sensors', sensor_id, NULL, {SENSOR_BODY.replace(ISO.replace("ts,", "last_event_ts,"), "last_event_ts")} FROM sensors
UNION ALL SELECT 'anomalies', sensor_id, arrival, concat('{{', {_anomaly_body("ts")}, '}}') FROM labelled
  WHERE applied AND reason <> ''"""
