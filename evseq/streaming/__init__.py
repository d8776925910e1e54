"""Structured Streaming forms of the operators.

``clean_stream`` applies the row-local cleaning expressions, which carry over
unchanged; ``keyed.next_event_stream`` keeps state per (entity, game) and gives
next events and contexts once the watermark has passed them.
"""

from evseq.streaming.keyed import next_event_stream
from evseq.streaming.rowlocal import clean_stream

__all__ = ["clean_stream", "next_event_stream"]
