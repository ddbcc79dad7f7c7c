"""tidemark: set-based table sync and change history on Spark DataFrames.

Staging batches are cast and cleaned (``functions``), folded into stored
state by one of four strategies (``operators``), stored as versioned
tables with a run log (``sources``), and read back through reports
(``plans``).  Everything is DataFrame work: joins, windows and
aggregates that Catalyst plans and the cluster runs.
"""

__version__ = "0.1.0"
