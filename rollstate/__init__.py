"""rollstate: spec-driven telemetry tables and mergeable rollups on Spark.

A short declarative spec (id column, time column, measures, rollups) becomes month-partitioned
Parquet fact tables plus last-value and time-bucket rollups kept as mergeable partial states, fed in
batch or by Structured Streaming, compacted, and read through merge-on-read views.
"""

from rollstate.plans.engine import Engine
from rollstate.spec import SpecError, load_spec, load_spec_file

__all__ = ["Engine", "SpecError", "load_spec", "load_spec_file"]
