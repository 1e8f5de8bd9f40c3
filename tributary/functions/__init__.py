"""Column expressions. Every one compiles to built-in Catalyst expressions; there are no UDFs."""
