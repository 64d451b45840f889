"""Batch analytics over yearly storm-event files, written as Spark DataFrame jobs."""
