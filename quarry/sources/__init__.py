"""Sources: parquet tables, headed / positional CSV, Kafka options."""
