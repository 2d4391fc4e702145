"""Readers of logs, position suites, opening books and reports."""
