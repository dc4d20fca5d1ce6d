"""Row checks and orphan references on tables as they arrive."""
