"""sluice — rule-driven record suppression and data-flow reconciliation on Spark.

Every public operator takes DataFrames and returns DataFrames; nothing is
collected except verdict rows at the very edge (``collect_verdict``).
"""

from sluice.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
