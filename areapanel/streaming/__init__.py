"""Streaming: intentionally empty.

The reference has no streaming sources, watermarks, windows over event time or
stateful operators: every job is batch and replaces whole tables. Nothing is
built here; the batch jobs in ``areapanel.plans.jobs`` are the whole surface.
"""
