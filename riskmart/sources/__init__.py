"""Readers. Together with ``sinks`` the only modules that touch storage."""
