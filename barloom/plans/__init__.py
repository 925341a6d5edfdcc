"""Feature, label and dataset plans."""
