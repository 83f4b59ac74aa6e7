"""demandlens: market-interest analytics as Spark DataFrame operators.

Layers:

* ``functions``  - Column expressions (rates, rounding, ISO durations, text/date parsing).
* ``operators``  - DataFrame -> DataFrame building blocks (latest-batch top-k, period growth,
  dense ids, keyed de-duplication, incremental selection, bounded broadcast, data checks).
* ``sources``    - readers and writers (CSV landing, sectioned interest exports, API responses,
  table and JDBC sinks).
* ``plans``      - the silver and gold models and the bronze -> silver -> gold pipeline.
* ``streaming``  - file-stream landing that feeds the same ingest operators.
"""

__version__ = "0.1.0"
