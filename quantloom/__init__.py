"""Spark-first analytics over keyed time series."""
