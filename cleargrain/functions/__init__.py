"""Column builders shared by every job."""
