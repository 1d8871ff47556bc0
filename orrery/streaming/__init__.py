"""Structured Streaming entry points. The reference has no stream
processing; its incremental cache (IO11) is offered here as a micro-batch
upsert so new files can be merged as they arrive."""
