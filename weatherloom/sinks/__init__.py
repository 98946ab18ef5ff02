"""Writers: lake layers, exports, the time-partitioned table, audit rows."""
