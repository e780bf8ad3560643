"""Readers (tables, day partitions, raw client logs) and the test-table stand-ins."""
