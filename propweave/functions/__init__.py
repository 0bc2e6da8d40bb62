"""Scalar functions of rule programs, Column to Column; null means that the property is absent."""

from propweave.functions.scalars import *  # noqa: F403
