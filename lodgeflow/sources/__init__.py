"""Sources: CSV, tables, landed JSON payloads; streams live in ``lodgeflow.streaming``."""
