"""Network settings by precedence: command line, then file, then environment, then default.

Every setting is an ordered list of layers.  A layer yields a value or the marker ABSENT;
the highest one that yields decides and is remembered as the value's source.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any
from urllib.parse import urlsplit

ABSENT = object()
CONFIG_NAME = "treeflow.config.json"
DEFAULT_TIMEOUT_MS = 60_000
# Environment variables, by falling rank.
PROXY_VARIABLES = ("TREEFLOW_PROXY_URL", "TREEFLOW_PROXY", "HTTPS_PROXY", "https_proxy", "HTTP_PROXY", "http_proxy", "ALL_PROXY", "all_proxy")
TOKEN_VARIABLES = ("TREEFLOW_TOKEN", "TREEFLOW_API_TOKEN", "TREEFLOW_ACCESS_TOKEN")
TIMEOUT_VARIABLE = "TREEFLOW_HTTP_TIMEOUT_MS"
# What reads as no.
NO_WORDS = ("false", "0", "no", "off", "")


def as_bool(value: Any) -> bool:
    return value if isinstance(value, bool) else str(value).strip().lower() not in NO_WORDS


@dataclass
class NetworkConfig:
    proxy: str | None = None
    ssl_verify: bool = True
    sources: dict[str, str] = field(default_factory=dict)
    config_file: str | None = None


def load_config(path: str | None, folder: str = ".") -> tuple[str | None, dict]:
    """The config file's path and object.  A named file must be readable; the usual one may
    be missing or broken; JSON that is no object counts as empty."""
    place = Path(folder, path or CONFIG_NAME)
    try:
        found = json.loads(place.read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        if path:
            raise ValueError(f"--config {path}: {e}") from e
        return None, {}
    return str(place), found if isinstance(found, dict) else {}


def first_of(env: Mapping[str, str], names) -> str:
    return next((env[n] for n in names if env.get(n)), "")


def _decide(layers: Iterator[tuple[str, Any]]) -> tuple[Any, str]:
    return next((value, source) for source, value in layers if value is not ABSENT)


def _proxy_layers(args, file, env):
    yield "cli", None if args.get("no-proxy") else str(args["proxy"]) if args.get("proxy") else ABSENT
    yield "config", (str(file["proxy"]) if file["proxy"] not in (None, "") else None) if "proxy" in file else ABSENT
    yield "env", first_of(env, PROXY_VARIABLES) or ABSENT
    yield "default", None


def _verify_layers(args, file, env):
    yield "cli", False if args.get("no-ssl-verify") or args.get("insecure") else True if args.get("ssl-verify") else ABSENT
    yield "config", as_bool(file["sslVerify"]) if "sslVerify" in file else ABSENT
    yield "env", as_bool(env["TREEFLOW_SSL_VERIFY"]) if "TREEFLOW_SSL_VERIFY" in env else ABSENT
    yield "env", str(env["NODE_TLS_REJECT_UNAUTHORIZED"]).strip() != "0" if "NODE_TLS_REJECT_UNAUTHORIZED" in env else ABSENT
    yield "default", True


def resolve_network(args: Mapping[str, Any], env: Mapping[str, str], folder: str = ".") -> NetworkConfig:
    path, file = load_config(args.get("config"), folder)
    proxy, proxy_from = _decide(_proxy_layers(args, file, env))
    verify, verify_from = _decide(_verify_layers(args, file, env))
    return NetworkConfig(proxy, verify, {"proxy": proxy_from, "sslVerify": verify_from}, path)


def number(text: Any, name: str) -> int | float:
    """A number; whole ones as int."""
    try:
        value = float(text)
    except (TypeError, ValueError):
        raise ValueError(f"{name} must be a number (got {text})") from None
    return int(value) if value.is_integer() else value


def timeout_ms(args: Mapping[str, Any], env: Mapping[str, str]) -> int | float:
    """Flag, then environment (checked even if the flag is set), then default."""
    own = str(env.get(TIMEOUT_VARIABLE, "")).strip()
    value = number(own, TIMEOUT_VARIABLE) if own else DEFAULT_TIMEOUT_MS
    return value if args.get("timeout-ms") is None else number(args["timeout-ms"], "--timeout-ms")


def redact(proxy: str | None) -> str:
    """A proxy URL with its credentials hidden."""
    if not proxy:
        return ""
    try:
        parts = urlsplit(proxy)
        if parts.username is None and parts.password is None:
            return proxy
        place = (parts.hostname or "") + (f":{parts.port}" if parts.port else "")
    except ValueError:
        return proxy
    return parts._replace(netloc=f"***@{place}").geturl()
