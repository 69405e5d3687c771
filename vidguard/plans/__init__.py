"""Whole jobs put together from sources and operators. Each is a plain function of a session."""
