"""Imports every module that registers queries."""

from foliary.plans import census, events, files, progress, text, versions  # noqa: F401
