"""Row-level building blocks: dict-literal parsing, ANSI-safe casts, exact averages."""
