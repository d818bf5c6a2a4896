"""Operators: functions from DataFrames to DataFrames."""

__all__ = ["boxes", "frames", "jobs", "land", "networks", "pixels", "polygons", "previews", "scoring", "transforms", "windows"]
