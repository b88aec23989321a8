"""Sources and sinks: test-table adapters, raw frames, bronze and gold storage."""
