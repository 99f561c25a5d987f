"""tidewater.streaming."""
