"""Settings, from the environment where it names them."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """The defaults are the limits and intervals of the pipeline this engine stands in for."""

    poll_interval_seconds: int = 15
    max_pages_per_poll: int = 50
    initial_lookback_days: int = 7
    dedup_ttl_hours: int = 48
    relevance_threshold: float = 0.5
    severity_threshold: int = 4
    event_valid_days: int = 7
    session_gap_hours: int = 48
    raw_context_chars: int = 2000
    requests_per_window: int = 20
    window_seconds: int = 60

    @classmethod
    def from_env(cls, prefix: str = "SIGLOOM_") -> Settings:
        given = {f.name: type(f.default)(os.environ[prefix + f.name.upper()]) for f in fields(cls) if prefix + f.name.upper() in os.environ}
        return cls(**given)


#: What operators take for granted where a caller says nothing.
DEFAULTS = Settings.from_env()
