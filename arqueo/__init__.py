"""arqueo: a PySpark engine for wide yearly budget tables, from landing checks to marts."""
