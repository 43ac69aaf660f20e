"""Column expressions. Everything here stays inside Catalyst; no UDFs."""
