"""Errors of the engine: each has a code and details, and says so in one line."""

from __future__ import annotations


class EngineError(Exception):
    """Base of all; ``details`` is what a log should hold."""

    code = "engine"

    def __init__(self, message: str, code: str | None = None, details: dict | None = None):
        super().__init__(message)
        self.code, self.details = code or type(self).code, details or {}

    def record(self) -> dict:
        return {"error": type(self).__name__, "code": self.code, "message": str(self), "details": self.details}


class ConfigError(EngineError):
    code = "config"


class SourceError(EngineError):
    code = "source"


class SinkError(EngineError):
    code = "sink"


class JobError(EngineError):
    code = "job"


class StreamError(EngineError):
    code = "stream"


class QualityError(EngineError, ValueError):
    """A check that has to hold does not. ``details`` has the figures."""

    code = "quality"


class SchemaError(QualityError):
    """Columns are missing or of another type."""

    code = "schema"
