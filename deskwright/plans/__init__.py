"""Jobs: tables, one-pass runs and reports."""
