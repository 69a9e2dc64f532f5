"""Reading and writing: raw record files, tables, provenance."""
