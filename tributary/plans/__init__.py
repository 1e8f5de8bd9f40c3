"""The named data products, one function per product."""
