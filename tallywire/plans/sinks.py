"""Writing the results: audit log, summary, and records for Kafka or files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.functions.clock import iso_text
from tallywire.operators.records import reading_json, source_struct
from tallywire.operators.summary import document_order, report_lines


def audit_log(audit: DataFrame) -> DataFrame:
    """The audit table in the layout of the audit file: readings of every status, and dead letters.

    One set of columns serves both kinds of record; `write_audit` leaves out those that are null. `event` is JSON text:
    the payload whole, with fields nobody knows, when it was kept; else what was read from it.
    """
    failed = F.col("reason").isNotNull()
    # A payload is known to be one JSON value, so line ends in it can only stand between its parts.
    event = F.translate("payload", "\n\r", "  ") if "payload" in audit.columns else reading_json()
    return audit.select(
        F.when(failed, "dead-letter").otherwise("reading").alias("type"),
        F.when(~failed, F.col("topic")).alias("topic"),
        F.when(~failed, F.col("partition")).alias("partition"),
        F.when(~failed, F.col("offset").cast("string")).alias("offset"),
        F.when(~failed, F.col("status")).alias("status"),
        F.when(~failed, event).alias("event"),
        "reason",
        F.when(failed, F.col("errors")).alias("errors"),
        F.when(failed, iso_text(F.col("dead_lettered_at"))).alias("deadLetteredAt"),
        F.when(failed, source_struct()).alias("source"),
        F.when(failed, F.col("raw")).alias("raw"),
    )


def write_audit(audit: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON line per record, the event as it came. A folder per batch with mode `overwrite` makes a retried batch
    harmless."""
    log = audit_log(audit)
    line = F.to_json(F.struct(*[c for c in log.columns if c != "event"]))
    with_event = F.concat(F.expr("substring(line, 1, length(line) - 1)"), F.lit(',"event":'), F.col("event"), F.lit("}"))
    lines = log.select(line.alias("line"), "event").select(F.coalesce(with_event, F.col("line")).alias("value"))
    lines.write.mode(mode).text(path)


def write_summary(sections: DataFrame, path: str) -> None:
    """The summary sections as JSON lines, replacing an earlier summary; sensors by id, anomalies by arrival."""
    ordered = document_order(sections).orderBy("part", "sensor", "arrival")
    ordered.select("section", F.try_parse_json("body").alias("body")).write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str) -> None:
    report_lines(report).write.mode("overwrite").text(path)


def write_kafka(records: DataFrame, topic: str, servers: str, options: dict[str, str] | None = None) -> None:
    """Publish `(key, value, headers)` records. Needs the Kafka connector on the class path."""
    writer = records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    writer.option("includeHeaders", "true").options(**(options or {})).save()


def write_records(records: DataFrame, path: str, mode: str = "append") -> None:
    """The same records as a table."""
    records.write.mode(mode).parquet(path)
