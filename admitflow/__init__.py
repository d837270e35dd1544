"""Spark batch engine for application-process data: extracts in, checked star schema and outcome tables out."""
