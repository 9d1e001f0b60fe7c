"""The resampling and data-quality operators over unbounded input."""

from sparkseries.streaming.live import stream_expectations, stream_resample

__all__ = ["stream_expectations", "stream_resample"]
