"""Writers: CSV, JSON lines, id checkpoints, reports, the sharded store."""
