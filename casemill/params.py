"""Run parameters, checked once before any job starts."""

from __future__ import annotations

from dataclasses import dataclass, field


class ParamError(ValueError):
    """A parameter is outside its allowed range."""


@dataclass(frozen=True)
class Params:
    #: No limit unless the caller names one.
    max_file_size_mb: float | None = None
    max_document_chars: int | None = None
    grounding_max_corrections: int = 1
    max_attempts: int = 3
    #: Model calls of one task under way at a time; a model must allow as many threads.
    calls_in_flight: int = 4
    company_name: str = "Example Customer Care"
    email_signature: str = "Customer Care Team, Example"

    def __post_init__(self) -> None:
        if self.max_document_chars is not None and self.max_document_chars < 500:
            raise ParamError("max_document_chars must be at least 500")
        if self.grounding_max_corrections < 0:
            raise ParamError("grounding_max_corrections must not be negative")
        if self.max_attempts < 1:
            raise ParamError("max_attempts must be at least 1")
        if self.calls_in_flight < 1:
            raise ParamError("calls_in_flight must be at least 1")
        if self.max_file_size_mb is not None and self.max_file_size_mb <= 0:
            raise ParamError("max_file_size_mb must be positive")

    @property
    def max_file_bytes(self) -> int | None:
        return None if self.max_file_size_mb is None else int(self.max_file_size_mb * 1024 * 1024)


@dataclass(frozen=True)
class RunMeta:
    """Literals stamped on every record of one run."""

    run_id: str
    provider: str = "template"
    model: str = "rules-v1"
    prompt_version: str = "1.0"
    started_at: str = ""
    processed_at: str = field(default="")
