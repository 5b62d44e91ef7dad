"""Command line: python -m treeflow.cli"""

from __future__ import annotations

import json
import os
import re
import shutil
import sys
from collections.abc import Mapping
from pathlib import Path

from . import __version__, config
from .errors import RemoteError, UsageError, exit_code_for
from .functions.canon import canonical
from .plans import job
from .plans.sizing import TIERS, Strategy
from .sources.remote import Client, TokenBucket, fixture_transport, http_transport

USAGE = """treeflow: fetch a document of any size in parts and join them

input      --url URL | --file-key KEY | --fixture FILE   (--base URL: the service)
size       --size auto|sm|md|large|xl|xxxxl  --max-part-bytes N  --max-part-ms N  --max-rechunk-depth N
requests   --depth N  --batch-size N  --concurrency N  --rate N  --retries N  --timeout-ms N  --pin VERSION
network    --proxy URL  --no-proxy  --ssl-verify  --no-ssl-verify  --insecure  --config FILE
modes      --geometry  --resume  --no-resume  --skeleton-only  --reconstruct-only  --keep-parts
output     --out FILE  --work-dir FOLDER  --pretty  --stdout  --quiet  --help  --version

exit codes 0 done, 1 other, 2 usage, 3 access, 4 not found, 5 rate limit, 6 server or network, 7 time-out
"""
# Flags without a value.
SWITCHES = frozenset("geometry resume no-resume skeleton-only reconstruct-only keep-parts pretty stdout quiet help h version no-ssl-verify ssl-verify insecure no-proxy".split())
FIXTURE_KEY = "FIXTUREKEY0000000000"
PREVIEW = 5


def parse(argv: list[str]) -> dict:
    """Flags to values; `--flag value` and `--flag=value`; switches are true; the rest under _."""
    out: dict = {"_": []}
    rest = iter(argv)
    for word in rest:
        if not word.startswith("--") and word != "-h":
            out["_"].append(word)
            continue
        name, given, value = word.lstrip("-").partition("=")
        out[name] = True if name in SWITCHES else value if given else next(rest, None)
    return out


def key_in(text: str) -> str:
    """A file key in a URL or path; empty if there is none."""
    text = text.strip()
    if m := re.search(r"/(?:file|design)/([0-9A-Za-z]{10,})", text, re.IGNORECASE):
        return m[1]
    return max((s for s in re.split(r"[\\/]", text) if re.fullmatch("[0-9A-Za-z]{20,}", s)), key=len, default="")


def _optional(args: Mapping, name: str):
    return None if args.get(name) is None else config.number(args[name], f"--{name}")


class Run:
    def __init__(self, argv: list[str], env: Mapping[str, str], out=None, err=None):
        self.args, self.env = parse(argv), env
        self.out, self.err = out or sys.stdout, err or sys.stderr

    def log(self, text: str) -> None:
        if not self.args.get("quiet"):
            self.warn(text)

    def warn(self, text: str) -> None:
        self.err.write(f"[treeflow] {text}\n")

    def work_dir(self, key: str) -> Path | None:
        own = self.args.get("work-dir")
        return Path(own) if own else Path("out", key) if key else None

    def emit(self, result: job.Result, folder: Path, label: str) -> None:
        text = canonical(result.file, bool(self.args.get("pretty")))
        if self.args.get("stdout"):
            self.out.write(text + "\n")
        else:
            place = Path(self.args.get("out") or folder / "full.json")
            place.parent.mkdir(parents=True, exist_ok=True)
            place.write_text(text, encoding="utf-8")
            self.log(f"wrote {place}: {sum(1 for _ in job.walk(result.file['document']))} nodes, {result.grafted} grafted [{label}]")
        if result.missing:
            more = "…" if len(result.missing) > PREVIEW else ""
            self.warn(f"{len(result.missing)} frontier nodes were not returned: {', '.join(result.missing[:PREVIEW])}{more}")

    def rebuild(self, folder: Path) -> None:
        skeleton = json.loads((folder / "skeleton.json").read_text(encoding="utf-8"))
        try:
            manifest = json.loads((folder / "manifest.json").read_text(encoding="utf-8"))
        except (OSError, ValueError):
            manifest = {}
        files = sorted(p.name for p in (folder / "parts").iterdir() if re.fullmatch(r"part-.*\.json", p.name))
        if named := {p["file"] for p in manifest.get("parts") or []}:
            files = [f for f in files if f in named]
        parts = [json.loads((folder / "parts" / f).read_text(encoding="utf-8")) for f in files]
        self.emit(job.join_parts(skeleton, parts, manifest), folder, "reconstruct-only")

    def client(self) -> Client:
        args = self.args
        net = config.resolve_network(args, self.env)
        if not net.ssl_verify:
            self.warn(f"TLS verification is off (from {net.sources['sslVerify']})")
        if net.proxy:
            self.log(f"proxy {config.redact(net.proxy)} (from {net.sources['proxy']})")
        fixture = args.get("fixture")
        transport = fixture_transport(json.loads(Path(fixture).read_text(encoding="utf-8"))) if fixture else http_transport(net.proxy, net.ssl_verify)
        token = "fixture" if fixture else config.first_of(self.env, config.TOKEN_VARIABLES)
        told = lambda e: self.log(f"retry {e['attempt']} (status {e['status']}) in {e['waitMs']} ms")
        return Client(args.get("base") or "", token, transport, config.timeout_ms(args, self.env), _optional(args, "retries") if args.get("retries") is not None else 3, bool(args.get("geometry")), args.get("pin"), None, told)

    def planned(self, client: Client):
        def heard(plan: Strategy) -> None:
            if client.limiter:  # as many at once as the resolved plan asks for
                client.limiter.resize(plan.concurrency)

        return heard

    def main(self) -> int:
        args = self.args
        if args.get("help") or args.get("h") or args.get("version"):
            self.out.write(f"{__version__}\n" if args.get("version") else USAGE)
            return 0
        key = args.get("file-key") or (key_in(args["url"]) if args.get("url") else "") or (FIXTURE_KEY if args.get("fixture") else "")
        size = (args.get("size") or "auto").lower()
        if size != "auto" and size not in TIERS:
            raise UsageError(f"--size must be auto or one of {', '.join(TIERS)}")
        folder = self.work_dir(key)
        if args.get("reconstruct-only"):
            if folder is None:
                raise UsageError("--reconstruct-only needs --work-dir")
            self.rebuild(folder)
            return 0
        if not any(args.get(k) for k in ("fixture", "file-key", "url")):
            raise UsageError("no input: give --url, --file-key or --fixture")
        if not key:
            raise UsageError("no file key in the input")
        client = self.client()
        given = {"depth": "depth", "batch_size": "batch-size", "concurrency": "concurrency", "max_part_bytes": "max-part-bytes", "max_part_ms": "max-part-ms"}
        given = {k: _optional(args, flag) for k, flag in given.items()}
        rate = _optional(args, "rate") or 0
        if rate > 0:
            client.limiter = TokenBucket(rate)
        level = _optional(args, "max-rechunk-depth")
        resume = False if args.get("no-resume") else True if args.get("resume") else None
        store = job.Folder(str(folder))
        result = job.run_document(client, key, store, size, max_level=job.MAX_SPLIT_LEVEL if level is None else level, resume=resume, skeleton_only=bool(args.get("skeleton-only")), log=self.log, on_plan=self.planned(client), **given)
        if result.skeleton is not None:
            (folder / "skeleton.json").write_text(canonical(result.skeleton, True), encoding="utf-8")
        if args.get("skeleton-only") and result.file is None:
            return 0
        (folder / "manifest.json").write_text(json.dumps(result.manifest, indent=2), encoding="utf-8")
        self.emit(result, folder, result.manifest["size"])
        if not args.get("keep-parts") and not args.get("stdout"):
            for name in ("parts", "groups"):
                shutil.rmtree(folder / name, ignore_errors=True)
        return 0


def run(argv: list[str], env: Mapping[str, str] | None = None, out=None, err=None) -> int:
    """Runs a command line; failures become exit codes."""
    r = Run(argv, os.environ if env is None else env, out, err)
    try:
        return r.main()
    except (UsageError, RemoteError) as e:
        r.warn(f"{type(e).__name__}: {e}")
        return exit_code_for(e)
    except Exception as e:  # the last resort of a command line
        r.warn(f"error: {e}")
        return 1


if __name__ == "__main__":
    sys.exit(run(sys.argv[1:]))
