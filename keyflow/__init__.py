"""keyflow: a Spark-native user-event pipeline.

Generate or load user records, resolve them into a fact/dimension layout,
claim unsent rows into keyed JSON messages, parse and enrich those messages
in a Structured Streaming job, upsert them into a keyed table that survives
replay, and run the analytical reads, delivery metrics, expectations and
audits on top. Every operator is a DataFrame -> DataFrame function; sources,
sinks and clocks are passed in.
"""

from keyflow.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
