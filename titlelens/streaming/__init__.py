"""Event streams from files, run until all that has arrived is done."""

from titlelens.streaming.sessions import (closed_sessions, drop_repeated_events, event_sessions, read_event_stream,
                                          run_available)

__all__ = ["closed_sessions", "drop_repeated_events", "event_sessions", "read_event_stream", "run_available"]
