"""orrery: star-schema indicator analytics as Spark DataFrame jobs.

Sub-packages:

* ``sources``   - scans and sinks: landed payloads, run-partitioned raw zone, exports.
* ``functions`` - column expressions: country codes, period parsing, change maths.
* ``operators`` - DataFrame operators: windows, loads, audits, reshapes, dimensions.
* ``plans``     - composed jobs: stand-in star schema, marts, the batch pipeline,
                  and the registry of named queries.
* ``streaming`` - Structured Streaming jobs: incremental load, live KPI, dedupe.
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming"]
