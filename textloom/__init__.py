"""textloom: corpus cleaning and analysis as Spark DataFrame operators.

Every operator is a plain ``DataFrame -> DataFrame`` function, or ``Column -> Column`` for row functions. Most only declare a
plan; those that reuse an intermediate table write it when they are called (``plans.materialize``). Subpackages:
``functions`` (columns), ``operators`` (DataFrames), ``sources`` (readers and writers), ``plans`` (commands, chains, queries,
materialization), ``streaming`` (Structured Streaming wrappers).
"""

__version__ = "0.2.0"
