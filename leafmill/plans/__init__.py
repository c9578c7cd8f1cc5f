"""Registered queries; importing this package registers them all."""

from . import archive, evidence, extras, grouping, joining, sampling, scoring, storage, templates, text, validation, windowing  # noqa: F401
