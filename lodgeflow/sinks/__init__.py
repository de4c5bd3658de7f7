"""Sinks: table overwrite/replace, reports, views; streaming upsert lives in ``lodgeflow.streaming``."""
