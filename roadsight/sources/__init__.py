"""Scans and sinks: fixture adapters, CSV ingest, mart store, exports, log."""
