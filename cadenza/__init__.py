"""cadenza — a Spark-native engine for two-stage recommendation analytics.

Every operator is a DataFrame-in / DataFrame-out function; Catalyst plans it.
Sub-packages:

* ``sources``   — table loading, schema helpers, the stand-in domain tables.
* ``functions`` — column expressions (text keys, list parsing, numerics, vectors).
* ``operators`` — interactions, splits, weighting, popularity, ranking, artists,
  name joins, profiles, scoring, reranking, playlists, evaluation.
* ``plans``     — global ordering helpers, iterative drivers, the pipeline and the
  registered queries with their SQL oracles.
* ``streaming`` — the interaction aggregation run as a Structured Streaming job.
"""

from cadenza.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
