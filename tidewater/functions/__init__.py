"""tidewater.functions."""
