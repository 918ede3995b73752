"""Reading and writing tables, shared-folder checkpoints, and the test-data role mapping."""
