"""Structured Streaming jobs: landing by date (T1), clean + dedup (T2),
incremental calendar-hour engagement (T3)."""
