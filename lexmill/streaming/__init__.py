"""Row-local steps on streaming tables."""
