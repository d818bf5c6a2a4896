"""tilescan: analytics over georeferenced raster scenes and their detections on Spark DataFrames."""

__version__ = "0.1.0"
