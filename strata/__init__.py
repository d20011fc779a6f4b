"""strata: lakehouse operators on open-source Apache Spark.

Every public function takes DataFrames / Columns and returns DataFrames /
Columns; nothing is collected to the driver. Sub-packages:

* ``functions``  column expressions (cleaning, dates, hashing, masks, dirt)
* ``operators``  DataFrame -> DataFrame operators (joins, aggregates,
  ranking, de-duplication, nested data, change data, quality, layout)
* ``sources``    batch / incremental ingestion, schema evolution, sinks
* ``streaming``  Structured Streaming operators
* ``plans``      the star schema, marts, dashboard datasets and the
  registered query catalogue over the driver's tables
* ``synth``      deterministic dirty-data generator built on ``spark.range``
"""

__version__ = "0.1.0"
