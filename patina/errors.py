"""Errors raised for bad inputs, before or while a job is built."""


class PatinaError(ValueError):
    """A table, path, spec or patch that breaks a documented contract."""
