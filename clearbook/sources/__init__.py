"""Scans of report drops and tables, the ingest ledger, and sinks."""
