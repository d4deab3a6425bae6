"""Landing zone and raw table: readers and writers."""
