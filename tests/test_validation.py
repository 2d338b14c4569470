import json

import pytest
from conftest import raw_log, reading

from tallywire.operators.records import dead_letter_records, dead_letters
from tallywire.operators.validation import split_valid, validate

OBJECT = ["event must be a JSON object"]
NO_JSON = ["payload is not valid JSON"]


def test_each_problem(spark):
    cases = [
        ("null", OBJECT),
        ("[1,2]", OBJECT),
        ("7", OBJECT),
        ('"text"', OBJECT),
        ("", NO_JSON),
        (None, NO_JSON),
        ('{"sensorId": ', NO_JSON),
        (json.dumps(reading()) + " x", NO_JSON),
        (json.dumps(reading()) + "]", NO_JSON),
        (json.dumps(reading()).replace('"', "'"), NO_JSON),
        (json.dumps(reading()).replace("50", "NaN"), NO_JSON),
        (
            {"eventId": "e"},
            [
                "schemaVersion is required",
                "sensorId is required",
                "sequence is required",
                "ts is required",
                "temperatureC is required",
            ],
        ),
        (
            {"schemaVersion": "1", "eventId": 5, "sensorId": True, "sequence": {}, "ts": [], "temperatureC": None},
            [
                "schemaVersion must be a number, received string",
                "eventId must be a string, received number",
                "sensorId must be a string, received boolean",
                "sequence must be a number, received object",
                "ts must be a string, received object",
                "temperatureC is required",
            ],
        ),
        (json.dumps(reading()).replace('"temperatureC": 20', '"temperatureC": 1e999'), ["temperatureC must be a finite number"]),
        (reading(eventId="x" * 201, ts="yesterday"), ["eventId must be <= 200 characters", "ts must be an ISO-8601 timestamp"]),
        (reading(eventId="😀" * 101), ["eventId must be <= 200 characters"]),
        (reading(temperatureC="50"), ["temperatureC must be a number, received string"]),
        (reading(sensorId=12), ["sensorId must be a string, received number"]),
        ('{"eventId":"a","eventId":5,' + json.dumps(reading(eventId=...))[1:], ["eventId must be a string, received number"]),
    ]
    found = validate(raw_log(spark, [payload for payload, _ in cases])).orderBy("offset").collect()
    assert [row.errors for row in found] == [errors for _, errors in cases]
    expected = ["invalid-json" if errors == NO_JSON else "schema-invalid" for _, errors in cases]
    assert [row.reason for row in found] == expected


def test_good_records(spark):
    minimal = {k: v for k, v in reading().items() if k not in ("rackId", "humidityPct", "vibrationMmS")}
    cases = [
        (reading(), ("sensor-01-1", "sensor-01", "rack-A", 1.0, 20.0, 50.0, 0.1)),
        (minimal, ("sensor-01-1", "sensor-01", None, 1.0, 20.0, None, None)),
        (reading(eventId="", sensorId=""), ("", "", "rack-A", 1.0, 20.0, 50.0, 0.1)),
        (reading(eventId="x" * 200), ("x" * 200, "sensor-01", "rack-A", 1.0, 20.0, 50.0, 0.1)),
        (reading(eventId="12", sensorId="true"), ("12", "true", "rack-A", 1.0, 20.0, 50.0, 0.1)),
        (reading(eventId='a"b\\c'), ('a"b\\c', "sensor-01", "rack-A", 1.0, 20.0, 50.0, 0.1)),
        (reading(eventId="{[}]"), ("{[}]", "sensor-01", "rack-A", 1.0, 20.0, 50.0, 0.1)),
        (reading(sequence=1.5, extra={"eventId": 7}), ("sensor-01-1.5", "sensor-01", "rack-A", 1.5, 20.0, 50.0, 0.1)),
        (reading(humidityPct="50", rackId=7), ("sensor-01-1", "sensor-01", None, 1.0, 20.0, None, 0.1)),
        (reading(humidityPct=None, rackId=None), ("sensor-01-1", "sensor-01", None, 1.0, 20.0, None, 0.1)),
        (" \n" + json.dumps(reading(), indent=1) + "\n", ("sensor-01-1", "sensor-01", "rack-A", 1.0, 20.0, 50.0, 0.1)),
        ('{"eventId":5,' + json.dumps(reading())[1:], ("sensor-01-1", "sensor-01", "rack-A", 1.0, 20.0, 50.0, 0.1)),
    ]
    found = validate(raw_log(spark, [payload for payload, _ in cases])).orderBy("offset").collect()
    assert [row.errors for row in found] == [[]] * len(cases)
    columns = ("event_id", "sensor_id", "rack_id", "sequence", "temperature_c", "humidity_pct", "vibration_mm_s")
    assert [tuple(row[c] for c in columns) for row in found] == [expected for _, expected in cases]


def test_split_and_dead_letters(spark):
    long_text = "x" * 600
    good, bad = split_valid(raw_log(spark, [reading(), "", '{"sensorId": ', long_text, {"eventId": "e"}], partition=2))
    assert good.count() == 1
    letters = dead_letters(bad).orderBy("offset").collect()
    assert [r.reason for r in letters] == ["invalid-json"] * 3 + ["schema-invalid"]
    assert [r.raw for r in letters] == ["", '{"sensorId": ', long_text, '{"eventId": "e"}']
    records = dead_letter_records(dead_letters(bad)).collect()
    assert {r.key for r in records} == {"p2"}
    body = json.loads(next(r.value for r in records if "schema-invalid" in r.value))
    assert list(body) == ["type", "reason", "errors", "deadLetteredAt", "source", "raw"]
    assert body["source"] == {"topic": "t", "partition": 2, "offset": "4"}
    assert "temperatureC is required" in body["errors"] and "sequence is required" in body["errors"]
    headers = {h.key: bytes(h.value).decode() for h in records[0].headers}
    assert headers == {"event-type": "sensor.reading.dlt", "reason": records[0].value.split('"reason":"')[1].split('"')[0]}


def test_filter_on_verdict_parses_once(spark):
    """A filter on the verdict must not write the parsing into the plan a second time."""
    good, _ = split_valid(raw_log(spark, [reading()]))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 or plan.count("jsontostructs") == 1 or plan.count("JsonToStructs") == 1


@pytest.mark.parametrize("payload", [b"\xff\xfe", b'{"eventId":"\xff"}'])
def test_bytes_that_are_no_text(spark, payload):
    row = validate(raw_log(spark, [payload])).first()
    assert row.reason is not None
