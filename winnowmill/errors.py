"""Errors raised by operators and by row scorers."""

from __future__ import annotations


class InvalidInput(ValueError):
    """The arguments or the schema of an input do not fit the operator."""


class NotCalibrated(RuntimeError):
    """A calibration was used before it was fitted."""


class ScorerFailure(RuntimeError):
    """A row scorer failed; ``retryable`` says whether trying again may help."""

    def __init__(self, message: str, retryable: bool = True):
        super().__init__(message)
        self.message = message
        self.retryable = retryable


class BadRequest(ScorerFailure):
    """The row itself is at fault; never retried."""

    def __init__(self, message: str, retryable: bool = False):
        super().__init__(message, retryable)


class RateLimited(ScorerFailure):
    """The scorer asked to wait; such waits do not use up retries."""

    def __init__(self, message: str = "rate limit exceeded", retry_after: float = 1.0):
        super().__init__(message, True)
        self.retry_after = retry_after


class TimedOut(ScorerFailure):
    """A call took longer than the policy allows, or the time for the batch is used up."""


class ConnectionFailed(ScorerFailure):
    """The scorer could not be reached; retried more often than other failures."""
