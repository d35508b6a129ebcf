"""Structured Streaming: what needs no other rows runs as it is on streams; counts and first sights keep bounded state behind a watermark."""

from quern.streaming.paragraphs import cleaned, first_seen, frequent, paragraph_counts

__all__ = ["cleaned", "first_seen", "frequent", "paragraph_counts"]
