"""Sinks: bronze landing, partitioned tables with upsert, control cursor."""
