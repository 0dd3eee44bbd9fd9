"""DataFrame operators of every layer (bronze, vault, gold, reports, charts,
checks, profiling) and the distributed ranking primitives they share."""
