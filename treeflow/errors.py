"""Typed failures of a remote document service, with process exit codes."""

from __future__ import annotations


class RemoteError(Exception):
    """A failed request.  `kind` names the row of ERROR_KINDS that describes it."""

    kind = "generic"

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status

    @property
    def exit_code(self) -> int:
        return ERROR_KINDS[self.kind][2]

    @property
    def retryable(self) -> bool:
        return ERROR_KINDS[self.kind][1]


class AuthError(RemoteError):
    kind = "auth"


class NotFoundError(RemoteError):
    kind = "not_found"


class RateLimitError(RemoteError):
    kind = "rate_limit"


class ServerError(RemoteError):
    kind = "server"


class NetworkError(RemoteError):
    kind = "network"


class RequestTimeout(RemoteError):
    kind = "timeout"


class UsageError(Exception):
    """A command line that cannot be run."""

    exit_code = 2


# Kind -> (exception, retryable, exit code).
ERROR_KINDS = {
    "generic": (RemoteError, False, 1),
    "auth": (AuthError, False, 3),
    "not_found": (NotFoundError, False, 4),
    "rate_limit": (RateLimitError, True, 5),
    "server": (ServerError, True, 6),
    "network": (NetworkError, True, 6),
    "timeout": (RequestTimeout, True, 7),
}
BODY_CHARS, CAUSE_CHARS = 200, 120


def kind_of(status: int) -> str:
    """The kind of a response status that is no success."""
    special = {401: "auth", 403: "auth", 404: "not_found", 429: "rate_limit"}
    return special.get(status) or ("server" if status >= 500 else "generic")


def for_status(status: int, request: str, body: str = "") -> RemoteError:
    note = f": {body[:BODY_CHARS]}" if body else ""
    return ERROR_KINDS[kind_of(status)][0](f"status {status} for {request}{note}", status)


def exit_code_for(error: BaseException) -> int:
    return getattr(error, "exit_code", 1)
