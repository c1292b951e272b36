"""Where results go: append topics, upsert tables, logs."""
