"""Sources: bronze JSONL, tables, JDBC."""
