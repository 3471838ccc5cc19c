"""Screening of payment transactions on Spark, in batch and as a stream."""
