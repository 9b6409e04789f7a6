"""Table and stream operators for everyday lakehouse work, written as plain Spark plans."""
