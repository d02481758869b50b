"""tablelearn: classification analytics on Spark DataFrames.

Every operator takes a DataFrame plus column names and returns a lazy
DataFrame built from Spark expressions, aggregates, windows and joins.
Only model fitting (naive Bayes, ID3 levels, MLlib estimators) runs jobs
eagerly, and what it brings to the driver is bounded by the model size
(classes x features, or one flag per tree level), never by the data.
"""

from tablelearn.session import ensure_checkpoint_dir, get_session, scratch_path

__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_path"]
