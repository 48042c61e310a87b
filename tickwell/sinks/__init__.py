"""Writers: partitioned lake tables, control logs, exports."""
