"""Sources, sinks and stored models."""
