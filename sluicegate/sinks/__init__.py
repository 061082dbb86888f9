"""Tables that are written: layer tables and the run log."""
