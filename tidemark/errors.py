"""What a guard raises: the subject that failed, and how many rows if rows did."""

from __future__ import annotations


class GuardError(Exception):
    """Base of all; ``subject`` names what failed, ``rows`` counts or is None."""

    def __init__(self, message: str, subject: str, rows: int | None = None):
        super().__init__(message)
        self.subject, self.rows = subject, rows


class MissingColumns(GuardError, ValueError):
    """Required columns that a table lacks."""


class EmptyTable(GuardError, ValueError):
    """No rows where some are needed."""


class CheckFailed(GuardError, ValueError):
    """A check that some rows fail."""


class TooLittleHistory(GuardError, ValueError):
    """A part of the time split without rows."""


class VolumeRejected(GuardError, RuntimeError):
    """The volumetric guardrail's critical verdict."""
