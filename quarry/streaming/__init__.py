"""Structured Streaming: replayable sources, checkpointed sinks, windowed counts."""

from .batches import (Folder, Landing, batch_counts, batch_word_counts, closing_mark, heartbeat, merged_word_counts, numbered,
                      window_counts)
from .landing import run_available, start_sink, with_arrival
from .sources import file_stream, socket_lines, text_stream
from .windows import (all_slots, event_time, last_n_slots, running_word_count, slot_counts, slot_of,
                      sliding_counts, tokens_per_slot)

__all__ = ["Folder", "Landing", "batch_counts", "batch_word_counts", "closing_mark", "heartbeat", "merged_word_counts",
           "numbered", "window_counts", "run_available", "start_sink", "with_arrival", "file_stream", "socket_lines", "text_stream",
           "all_slots", "event_time", "last_n_slots", "running_word_count", "slot_counts", "slot_of",
           "sliding_counts", "tokens_per_slot"]
