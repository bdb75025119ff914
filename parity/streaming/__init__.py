"""Streaming: the checks applied to each micro-batch of a stream."""

from parity.streaming.batches import check_each_batch  # noqa: F401
