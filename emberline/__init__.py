"""Spark-native analytics over timestamped point detections, raster cells and weather grids."""
