"""Reading and writing: raw logs, tables, landing folders, the session."""
