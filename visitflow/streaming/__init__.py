"""Structured Streaming jobs over the ad-click log."""

from .ad_stream import (AdStateStore, TrendStore, run_to_completion, start_ad_stream,  # noqa: F401
                        start_trend_stream, trend_counts)
