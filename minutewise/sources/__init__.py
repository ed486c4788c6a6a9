"""Sources, sinks and catalog access."""
