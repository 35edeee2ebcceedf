"""Structured Streaming forms of the incremental jobs."""
from .summaries import collecting, observed, read_summaries  # noqa: F401
from .upsert_stream import stream_upsert, upsert_batch  # noqa: F401
from .window_counts import stream_window_counts  # noqa: F401
from .work_list import pending, stream_work_list  # noqa: F401
