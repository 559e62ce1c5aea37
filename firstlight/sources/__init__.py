from firstlight.sources.logs import (
    kafka_sink_options,
    kafka_source_options,
    read_file_log_stream,
    read_kafka_log_stream,
    starting_offsets,
)
from firstlight.sources.store import StorePaths, get_by_id, read_day, read_days

__all__ = [
    "StorePaths",
    "get_by_id",
    "kafka_sink_options",
    "kafka_source_options",
    "read_day",
    "read_days",
    "read_file_log_stream",
    "read_kafka_log_stream",
    "starting_offsets",
]
