"""Streaming adapter: Structured Streaming micro-batches into the vault loaders.

The reference has no streaming operator (its data is loaded in daily
batches); this package only lets a stream drive the same batch loaders.
"""

from ledgerlake.streaming.microbatch import vault_batch_writer

__all__ = ["vault_batch_writer"]
