"""Spark-native analytics over agent trajectories."""
