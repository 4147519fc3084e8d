"""Writers: partitioned tables, versioned merge targets, warehouse loads."""
