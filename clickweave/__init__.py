"""clickweave: clickstream analytics as plain Spark DataFrame transformations.

Layers (each module is a set of ``DataFrame -> DataFrame`` functions that compose with
``df.transform``):

* ``sources``   raw CSV and Parquet readers, the fixed raw schema, the driver-table adapter
* ``functions`` reusable column expressions (reject rule, whole-second clock, category levels, keys)
* ``operators`` ingest split, staging, sessionization, session metrics, star schema, analytics,
  data-quality checks, ML
* ``sinks``     partitioned Parquet tables, keyed upsert, model and report persistence
* ``plans``     end-to-end compositions (bronze -> silver -> gold) and the query catalog
* ``streaming`` Structured Streaming session metrics and scoring
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
