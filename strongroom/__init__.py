"""strongroom: an insert-only, historised warehouse (hubs, links, satellites)
built and read with Spark DataFrames.

Layout
  functions/  column builders (hash keys, hash diffs, soft-rule expressions)
  sources/    readers, writers and the staging feeds built from the test tables
  operators/  loaders (hub, link, satellite, effectivity), profiling, audits
  plans/      snapshot (spine, PIT, bridge) and information-mart builds
  streaming/  micro-batch vault loads with Structured Streaming
  suite/      the registered queries and their DuckDB oracles
"""

from strongroom.operators.specs import HubSpec, LinkSpec, SatSpec  # noqa: F401

__version__ = "0.1.0"
