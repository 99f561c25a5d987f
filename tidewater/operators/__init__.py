"""tidewater.operators."""
