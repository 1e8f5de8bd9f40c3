"""Checked queries: each pairs a DataFrame build with an independent SQL statement."""
