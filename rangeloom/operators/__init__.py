"""Operators on loaded data: binding, counting, healing, profiling, layout."""
