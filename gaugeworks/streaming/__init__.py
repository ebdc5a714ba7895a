"""The load, triggered by files as they arrive."""
