"""Jobs: compositions of operators with their reads and writes."""
