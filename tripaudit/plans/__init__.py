"""Composite flows: the full audit run, the registered query suite and the
SQL oracle used to check it."""
