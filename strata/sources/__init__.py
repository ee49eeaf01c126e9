from strata.sources.tables import SCHEMAS, SchemaMismatch, read_table, read_tables

__all__ = ["SCHEMAS", "SchemaMismatch", "read_table", "read_tables"]
