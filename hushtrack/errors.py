"""Errors raised by the library."""


class GapDetectionError(Exception):
    """The input messages cannot be processed (e.g. a mandatory column is missing)."""


class InsufficientSegmentsDataError(Exception):
    """The segments table does not reach far enough past the processed range."""


class ConflictingChangeError(Exception):
    """Another writer changed the table first."""
