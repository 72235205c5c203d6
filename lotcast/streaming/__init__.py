"""Structured Streaming: checkpointed ingest and incremental scoring."""

from lotcast.streaming.compact import CompactedFolder
from lotcast.streaming.dedup import without_resent
from lotcast.streaming.ingest import decode_stream, open_kafka, open_stream, stream_to_files
from lotcast.streaming.reports import ReportTable, report_counts, stream_reports
from lotcast.streaming.scoring import (
    checkpoint_stream_id,
    read_released_scores,
    score_stream,
    score_stream_each_batch,
    score_stream_released,
)

__all__ = [
    "CompactedFolder", "without_resent", "ReportTable", "report_counts", "stream_reports",
    "decode_stream", "open_kafka", "open_stream", "stream_to_files",
    "checkpoint_stream_id", "read_released_scores", "score_stream", "score_stream_each_batch", "score_stream_released",
]
