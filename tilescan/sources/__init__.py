"""Sources and sinks."""

__all__ = ["files", "fixtures", "raster", "remote", "tiff"]
