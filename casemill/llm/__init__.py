"""Operators for preparing training text, one module each. Nothing else in the package imports this one."""
