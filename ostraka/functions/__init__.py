"""Functions of the engine."""
