"""Sources: aspect scans, dimension readers and driver-table adapters."""
