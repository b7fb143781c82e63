"""volcast — volatility bars, features, HAR-RV forecasts and residual anomalies on Spark.

Every public function takes and returns DataFrames (or Columns). Nothing in the
library calls ``collect``; small model artefacts are turned into scalar
subqueries so that plans stay lazy and distributed.
"""

from volcast.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
