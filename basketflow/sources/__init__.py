"""Inputs and the tables that keep state between runs."""
