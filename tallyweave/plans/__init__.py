"""Plan-level helpers: durable cuts, sizes, whole pipelines."""
