"""Reading order tables, writing results, and adapters from other schemas."""
