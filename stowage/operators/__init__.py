"""DataFrame operators. Each is a pure function; clocks, thresholds and sizes are arguments."""
