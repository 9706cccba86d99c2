"""Sources and sinks (family A)."""
