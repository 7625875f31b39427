"""Discriminative-term analytics and text classification on Spark DataFrames."""
