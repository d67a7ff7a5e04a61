"""Incremental (streaming) execution of the history operators."""

from strata.streaming.incremental import latest_history, start_history_stream

__all__ = ["latest_history", "start_history_stream"]
