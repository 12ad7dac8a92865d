"""Baseline models for a binary target, built, judged and explained as Spark jobs."""

from plumbline.spec import ModelSpec

__all__ = ["ModelSpec"]
