"""Writers: partitioned tables, fact batches and message topics."""
