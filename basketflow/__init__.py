"""Demand analytics over order baskets, written as Spark jobs."""
