"""Structured Streaming variants of the event-time stats (SS-1..3)."""

from .jobs import (  # noqa: F401
    MINUTE_ACTIVITY,
    StreamJob,
    binned_production,
    read_aspect_stream,
    result,
    start,
    unit_engagements,
)
