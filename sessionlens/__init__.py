"""sessionlens: Spark-native click-session analytics.

Cleaning, imputation, user-level splits, window features, profiles, time
series, metrics and a stacked click model, all expressed with the
DataFrame API so Catalyst plans them and executors run them.
"""

from sessionlens.session import get_spark, checkpoint_dir, cut_lineage  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir", "cut_lineage"]
