"""The streaming scoring job."""
