"""Landing jobs and table input/output."""
