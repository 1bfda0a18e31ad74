"""Streaming use of the row-wise steps (the reference itself is batch only)."""

from linkgraph.streaming.stateless import STATELESS_STEPS, apply_steps, clean_stream  # noqa: F401
