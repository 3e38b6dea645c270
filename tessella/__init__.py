"""Slide-raster analytics as Spark tables: every operator is a function of DataFrames."""
