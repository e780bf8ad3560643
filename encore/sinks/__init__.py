"""Writers: key-multiplexed text, day-partitioned tables, JDBC, lineage cuts."""
