"""Column expressions, pictures, and the package on the executors."""

__all__ = ["geometry", "pixels", "png", "workers"]
