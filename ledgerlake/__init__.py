"""ledgerlake: a Spark-native medallion / Data Vault / star-schema pipeline.

Layers (each a set of DataFrame builders, no engine of its own):

* ``sources``    – source schemas, readers, the driver-table mapping, sinks
* ``functions``  – Column expressions (hash keys, initcap, tiers, calendar parts)
* ``operators``  – bronze, vault loaders, SCD2 / facts, reports, charts,
                   data-quality checks, profiling, distributed ranking
* ``plans``      – entity catalogue, layer wiring, pipeline runner, query registry
* ``streaming``  – micro-batch adapter that feeds the incremental loaders
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
