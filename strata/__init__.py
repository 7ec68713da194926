"""strata: dimensional and fact modelling operators for PySpark.

Every operator is a plain function from DataFrames to a DataFrame,
parameterised by key / period / state / measure columns, built only on
the public DataFrame, SQL and Structured Streaming APIs.

Subpackages
-----------
sources     table loading, recasting the driver tables into the modelling
            shapes, file sinks and scratch locations
functions   column-level helpers (tier classes, "MM:SS" parsing, bitmaps)
operators   cumulative tables, SCD2, property graph, facts, datelists,
            reduced facts, match analytics, data-quality checks, joins
plans       physical layout (bucketing, partitioned writes, sizes) and
            plan assertions
streaming   event-time enrichment, tumbling and session windows
"""

__version__ = "0.1.0"
