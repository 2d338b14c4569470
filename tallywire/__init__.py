"""Telemetry analytics over keyed record logs, written as Spark DataFrame jobs."""

from tallywire.session import build_session, prepare, work_dir

__all__ = ["build_session", "prepare", "work_dir"]
