"""Prepare hourly and monthly time series on Spark and forecast them with a variance for every point."""

from tidecast.session import configure, work_dir, write_scratch

__all__ = ["configure", "work_dir", "write_scratch"]
