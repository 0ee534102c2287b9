"""playlens: recommendation analytics on interaction tables, built on Spark.

Every operator takes DataFrames and plain parameters and returns a
DataFrame.  Nothing is collected to the driver except bounded results
(metric rows, a grid table, partition counts).

Layout:

* ``sources``   -- table reads, fixture views over the given tables, sinks
* ``functions`` -- column expressions (hash keys, checked casts, safe ratios)
* ``operators`` -- item ids, play shares and scores, splits, ALS, top-k, metrics, tuning
* ``plans``     -- end-to-end jobs composed from the operators
"""

from playlens.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
