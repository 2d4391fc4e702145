"""The rules of chess, as small helpers for tasks."""
