"""What users call: scans, dashboards, lists, details, action and import batches."""
