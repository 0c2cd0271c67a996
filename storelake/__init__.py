"""storelake: retail order analytics as Spark DataFrame, SQL, MLlib and
Structured Streaming jobs.

Layers (all functions are ``DataFrame -> DataFrame`` and lazy):

* ``storelake.sources``    -- table readers, bindings of the test tables to the
                              retail schema, stream source/parse, sinks
* ``storelake.functions``  -- column expressions (calendar, safe ratios, money sums,
                              alert texts)
* ``storelake.operators``  -- silver star schema, gold feature tables, anomaly
                              rules, baskets, forecasts, models, serving queries
* ``storelake.streaming``  -- the stateful stream (transformWithState) and sinks
* ``storelake.plans``      -- end-to-end layer jobs and plan inspection helpers
"""

__version__ = "0.1.0"
