"""Market-settlement analytics as plain Spark DataFrame jobs.

The package is a set of functions ``DataFrame (+ parameters) -> DataFrame``:

* ``functions``  column expressions (dates, cleaning, order curves)
* ``operators``  relational steps (conform, filter, validate, dedup, join, aggregate)
* ``sources``    scans of CSV, ZIP and JSON drops, tables, ledger, sinks
* ``plans``      the ready-made jobs that put the steps together
* ``streaming``  incremental file ingest and re-merge
* ``registry``   named queries over the sample tables, each with its SQL twin
"""
