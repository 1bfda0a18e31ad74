"""Jobs composed from operators, and the registered query workload."""
