from tabsift.streaming.scoring import (
    monitor_stream,
    read_stream,
    run_available,
    score_stream,
)
from tabsift.streaming.windows import quantile_bins, score_requests, sketch_stream

__all__ = ["monitor_stream", "read_stream", "run_available", "score_stream", "quantile_bins", "score_requests", "sketch_stream"]
