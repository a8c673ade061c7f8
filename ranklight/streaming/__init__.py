"""Structured Streaming front end: answer query files as they arrive (the reference's interactive
query loop and search box, re-expressed as a stream of query rows against a static index)."""

from ranklight.streaming.search_stream import start_search_stream  # noqa: F401
