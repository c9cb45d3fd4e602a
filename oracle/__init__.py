"""Independent SQL for the registered queries, for the checking database."""
