"""Table synchronisation as Spark jobs: bounded scans, type conformance, atomic publishing."""
