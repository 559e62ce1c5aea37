from firstlight.streaming.pipeline import process_batch, start_pipeline
from firstlight.streaming.state import earliest_updates, first_per_day_stream

__all__ = ["earliest_updates", "first_per_day_stream", "process_batch", "start_pipeline"]
