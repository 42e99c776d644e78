"""tallyframe: subscription-business analytics as plain Spark DataFrame functions.

Layers (each a package):

* ``sources``   text ingest, named tables, sinks, and the binding of the
                driver's parquet test tables to the raw text shapes.
* ``functions`` column expressions: declarative casts, flags, maps, ratios,
                repeatable hash-based uniforms.
* ``operators`` reusable DataFrame operators: streaks (gaps and islands),
                calendar spines, sampling / numbering, range matching,
                data-quality checks.
* ``plans``     the named models built from the operators: staging,
                revenue marts, engagement KPIs, attribution and the other
                table-shaped jobs.
* ``streaming`` incremental (file-arrival) variant of the raw text load.

Every operator takes DataFrames and column names and returns a DataFrame; no
operator collects data to the driver except bounded histograms that are
explicitly documented as such.
"""

__all__ = ["session"]
