"""DataFrame operators: scans, conformance, spec tables, layout, targets."""
