"""Readers and writers. Paths come from the caller and point at shared storage."""
