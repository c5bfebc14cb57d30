"""hourglass: keyed time-series analytics as lazy Spark DataFrame operators.

Every operator takes a DataFrame plus the names of its series key columns,
its time (or row-index) column and its value columns, and returns a new lazy
DataFrame. Nothing is collected to the driver except plan-shaping scalars
(for example the depth of a block scan) and one-row-per-series model
coefficients.
"""

from hourglass.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
