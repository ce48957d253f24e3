"""Sluice: table and stream preparation as plain Spark DataFrame functions.

Subpackages
-----------
``functions``  column expressions (cleaning, parsing, hashing)
``operators``  ``DataFrame -> DataFrame`` steps (pivot, joins, counts, scoring, scanning)
``sources``    tolerant readers and table lookups
``sinks``      table writers
``streaming``  Structured Streaming versions of the same steps
``plans``      whole jobs put together from the pieces above
``queries``    the registered queries with their SQL oracles
"""

__version__ = "0.1.0"
