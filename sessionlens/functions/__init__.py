"""Scalar Column builders (dates, clips, labels, null handling)."""

from sessionlens.functions.scalars import *  # noqa: F401,F403
