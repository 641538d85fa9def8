"""kiln: parameterised table analytics on Spark DataFrames.

Every operator takes DataFrames and column names and returns a DataFrame; the
heavy lifting is done by Spark's built-in expressions, joins, aggregates and
windows so that Catalyst and AQE choose the physical plan.
"""

from kiln.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
