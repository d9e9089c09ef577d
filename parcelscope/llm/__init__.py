"""Operators for preparing training text at scale; see the module of each operator."""
