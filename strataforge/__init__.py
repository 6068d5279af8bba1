"""strataforge: survey poststratification operators on Spark DataFrames.

Every public operator is a ``DataFrame -> DataFrame`` function (or a column
expression) built from Spark SQL built-ins, so Catalyst prunes, pushes down
and plans it. Randomness is a keyed hash of (seed, key) so results do not
depend on partitioning or task retries.
"""

from strataforge.session import get_session, ensure_checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
