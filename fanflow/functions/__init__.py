"""functions of the change-data-capture engine."""
