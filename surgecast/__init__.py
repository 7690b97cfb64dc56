"""surgecast: event-traffic analytics as Spark DataFrame operators.

Every public operator takes DataFrames and returns a DataFrame; the work is
planned by Catalyst and runs on executors. Grouped pandas functions are used
only for per-series recurrences that window frames cannot express.
"""

from surgecast.session import get_session, prepare_session, checkpoint_dir

__all__ = ["get_session", "prepare_session", "checkpoint_dir"]
