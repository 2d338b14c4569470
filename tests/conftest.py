import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallywire import build_session  # noqa: E402

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{SMALLEST}/events.parquet")


def reading(sensor="sensor-01", sequence=1, **changes):
    """A good reading; a change to `...` removes the field."""
    made = {
        "schemaVersion": 1,
        "eventId": f"{sensor}-{sequence}",
        "sensorId": sensor,
        "rackId": "rack-A",
        "sequence": sequence,
        "ts": f"2026-09-30T10:00:{sequence:02d}.000Z" if isinstance(sequence, int) and 0 <= sequence < 60 else "2026-09-30",
        "temperatureC": 20,
        "humidityPct": 50,
        "vibrationMmS": 0.1,
        **changes,
    }
    return {k: v for k, v in made.items() if v is not ...}


def raw_log(spark, payloads, partition=0):
    """Payloads (objects, text, bytes or None) as records in order of arrival."""
    rows = []
    for offset, payload in enumerate(payloads):
        if isinstance(payload, (dict, list)):
            payload = json.dumps(payload)
        if isinstance(payload, str):
            payload = payload.encode()
        rows.append(("t", partition, offset, bytearray(payload) if payload is not None else None))
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary")


def typed_log(spark, readings):
    """Readings as a typed table in order of arrival."""
    columns = (
        "schemaVersion", "eventId", "sensorId", "rackId", "sequence", "ts", "temperatureC", "humidityPct", "vibrationMmS",
    )
    numbers = {"schemaVersion", "sequence", "temperatureC", "humidityPct", "vibrationMmS"}
    rows = []
    for offset, r in enumerate(readings):
        values = [r.get(c) for c in columns]
        rows.append((0, offset, *[float(v) if c in numbers and v is not None else v for c, v in zip(columns, values)]))
    return spark.createDataFrame(
        rows,
        "partition int, offset bigint, schema_version double, event_id string, sensor_id string, rack_id string, "
        "sequence double, ts string, temperature_c double, humidity_pct double, vibration_mm_s double",
    )
