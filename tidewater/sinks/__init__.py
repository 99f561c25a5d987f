"""tidewater.sinks."""
