"""Rule catalogue, validation and reports."""
