import http.server
import io
import json
import threading

import pytest

from tests.fixture import document
from treeflow import cli, config
from treeflow.errors import AuthError, NetworkError, NotFoundError, RateLimitError, RemoteError, RequestTimeout, ServerError, exit_code_for
from treeflow.sources import remote
from treeflow.sources.remote import Client, Response, TokenBucket, fixture_transport


class Script:
    """Answers from a list; exceptions are raised."""

    def __init__(self, *answers):
        self.answers, self.urls, self.slept, self.events = list(answers), [], [], []

    def __call__(self, url, headers, timeout):
        self.urls.append(url)
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    def client(self, **more):
        return Client("", "t", self, sleep=self.slept.append, on_retry=self.events.append, **more)


OK = Response(200, '{"x": 1}')


def test_retries_and_waits():
    s = Script(Response(429, "", {"Retry-After": "2.5"}), Response(503, "", {"retry-after": "0"}), TimeoutError(), OK)
    assert s.client().get("/q") == {"x": 1}
    assert s.slept == [2.5, 1.0, 2.0] and [e["status"] for e in s.events] == [429, 503, None]


@pytest.mark.parametrize(
    ("answer", "error", "code", "tries"),
    [
        (Response(401, "no"), AuthError, 3, 1),
        (Response(403, ""), AuthError, 3, 1),
        (Response(404, ""), NotFoundError, 4, 1),
        (Response(418, ""), RemoteError, 1, 1),
        (Response(429, ""), RateLimitError, 5, 3),
        (Response(500, ""), ServerError, 6, 3),
        (ConnectionError("x" * 500), NetworkError, 6, 3),
        (TimeoutError(), RequestTimeout, 7, 3),
        (Response(200, "no json"), NetworkError, 6, 1),
    ],
)
def test_failures(answer, error, code, tries):
    s = Script(*[answer] * 9)
    with pytest.raises(error) as e:
        s.client(retries=2).get("/q")
    assert type(e.value) is error and exit_code_for(e.value) == code and len(s.urls) == tries and len(str(e.value)) < 260


def test_requests():
    s = Script(*[OK] * 9)
    c = s.client(geometry=True, version="9")
    c.skeleton("k/1", 3)
    c.whole("k")
    c.nodes("k", ["1:2", "é,/"], 4)
    assert s.urls == ["/files/k%2F1?depth=3&geometry=paths&version=9", "/files/k?geometry=paths&version=9", "/files/k/nodes?ids=1%3A2,%C3%A9%2C%2F&depth=4&geometry=paths&version=9"]
    assert c.nodes("k", []) == {"nodes": {}} and len(s.urls) == 3
    with pytest.raises(ValueError):
        c.whole("")
    with pytest.raises(AuthError):
        Client("", "", s).get("/q")
    assert [remote.backoff_ms(n) for n in range(7)] == [500, 1000, 2000, 4000, 8000, 15000, 15000]


def test_token_bucket():
    now = [0.0]
    b = TokenBucket(2, 3, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    times = []
    for _ in range(6):
        b.acquire()
        times.append(round(now[0], 3))
    assert times == [0, 0, 0, 0.5, 1.0, 1.5]
    b.resize(0)
    assert b.burst == 1 and b.tokens <= 1
    off = TokenBucket(0, 1, clock=lambda: 0.0, sleep=lambda s: pytest.fail("waits"))
    [off.acquire() for _ in range(50)]


@pytest.fixture(scope="module")
def server():
    serve = fixture_transport(document())

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            missing = "/files/none" in self.path
            body = b"" if missing else serve(self.path, {}, 1).body.encode()
            self.send_response(404 if missing else 200 if self.headers.get("X-Access-Token") else 401)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    httpd = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}"
    httpd.shutdown()


def test_http(server):
    c = Client(server, "t", remote.http_transport())
    assert c.whole("k") == document()
    with pytest.raises(NotFoundError):
        c.whole("none")
    with pytest.raises(NetworkError):
        Client("http://127.0.0.1:1", "t", remote.http_transport(), retries=0).whole("k")


def test_data_source(spark, server, tmp_path):
    remote.register(spark)
    place = tmp_path / "doc.json"
    place.write_text(json.dumps(document()))
    read = lambda **o: spark.read.format("treeflow_remote").options(fileKey="k", fixture=str(place), **o).load()
    assert json.loads(read().first().payload) == document()
    assert "children" not in json.loads(read(depth="0").first().payload)["document"]
    some = read(ids='["1:100","1:200","1:300","nope"]', batchSize="2")
    assert some.rdd.getNumPartitions() == 2 and {r.id for r in some.collect()} == {"1:100", "1:200", "1:300"}
    assert [r.id for r in some.filter("id = '1:200'").collect()] == ["1:200"]
    failed = spark.read.format("treeflow_remote").options(fileKey="none", base=server, failures="rows", tokenEnv="HOME").load().first()
    assert failed.payload is None and failed.error.startswith("not_found")


def run(*argv, env=None):
    out, err = io.StringIO(), io.StringIO()
    return cli.run([str(a) for a in argv], env or {}, out, err), out.getvalue(), err.getvalue()


@pytest.fixture
def place(tmp_path):
    p = tmp_path / "doc.json"
    p.write_text(json.dumps(document()))
    return p


def test_cli_runs(place, tmp_path):
    work = tmp_path / "w"
    code, _, err = run("--fixture", place, "--work-dir", work, "--keep-parts", "--max-part-bytes", 200)
    assert code == 0 and "md" in err and json.loads((work / "full.json").read_text()) == document()
    text = (work / "full.json").read_text()
    assert "\\u2028" in text and chr(0x2028) not in text
    (work / "parts" / "part-zzz.json").write_text('{"nodes": {"1:100": {"document": {"id": "stale"}}}}')
    code, out, _ = run("--reconstruct-only", "--work-dir", work, "--stdout", "--quiet")
    assert code == 0 and json.loads(out) == document()
    assert run("--fixture", place, "--work-dir", work, "--quiet")[2] == "" and not (work / "parts").exists()
    assert run("--fixture", place, "--work-dir", tmp_path / "s", "--skeleton-only")[0] == 0 and not (tmp_path / "s" / "full.json").exists()
    code, out, _ = run("--fixture", place, "--work-dir", work, "--size=sm", "--stdout", "--pretty")
    assert code == 0 and out.startswith('{\n  "name"') and json.loads((work / "manifest.json").read_text())["mode"] == "whole"


def test_cli_exit_codes(place, tmp_path, server):
    assert run("--help")[:1] == (0,) and run("-h")[0] == 0 and run("--version")[1].strip()
    assert run()[0] == run("--fixture", place, "--size", "huge")[0] == run("--reconstruct-only")[0] == run("--url", "x")[0] == 2
    assert run("--file-key", "k", "--work-dir", tmp_path, "--base", server)[0] == 3
    assert run("--file-key", "none", "--work-dir", tmp_path, "--base", server, env={"TREEFLOW_TOKEN": "t"})[0] == 4
    assert run("--fixture", place, "--depth", "x", "--work-dir", tmp_path)[0] == 1
    assert run("--url", f"https://h.example/file/{'a' * 12}/T", "--work-dir", tmp_path, "--base", server, "--stdout", "--rate", 50, env={"TREEFLOW_API_TOKEN": "t"})[0] == 0


def test_parse_and_keys():
    assert cli.parse(["--a=1", "--b", "--c", "--quiet", "x", "--d"]) == {"_": ["x"], "a": "1", "b": "--c", "quiet": True, "d": None}
    long, longer = "k" * 20, "m" * 25
    assert [cli.key_in(s) for s in (f"out/{long}/{longer}/x", f"h/DESIGN/{'q' * 10}", f" {long} ", "short", "")] == [longer, "q" * 10, long, "", ""]


def test_config(tmp_path):
    f = tmp_path / config.CONFIG_NAME
    get = lambda args=None, env=None: config.resolve_network(args or {}, env or {}, str(tmp_path))
    assert (get().proxy, get().ssl_verify, get().sources) == (None, True, {"proxy": "default", "sslVerify": "default"})
    env = {"HTTPS_PROXY": "", "all_proxy": "http://e", "TREEFLOW_SSL_VERIFY": " OFF "}
    assert (get(env=env).proxy, get(env=env).ssl_verify) == ("http://e", False)
    assert get(env={"NODE_TLS_REJECT_UNAUTHORIZED": "0"}).ssl_verify is False
    f.write_text('{"proxy": "", "sslVerify": "yes"}')
    assert (get(env=env).proxy, get(env=env).ssl_verify, get(env=env).sources["proxy"]) == (None, True, "config")
    assert get({"proxy": "http://c", "insecure": True}, env).proxy == "http://c" and get({"no-proxy": True, "proxy": "x"}, env).proxy is None
    f.write_text("[1]")
    assert get().proxy is None
    f.write_text("broken")
    assert get().config_file is None
    with pytest.raises(ValueError, match="--config"):
        get({"config": config.CONFIG_NAME})
    assert [config.timeout_ms(a, e) for a, e in (({}, {}), ({}, {config.TIMEOUT_VARIABLE: "5"}), ({"timeout-ms": "1.5"}, {config.TIMEOUT_VARIABLE: "5"}))] == [60_000, 5, 1.5]
    with pytest.raises(ValueError, match="number"):
        config.timeout_ms({}, {config.TIMEOUT_VARIABLE: "x"})
    assert [config.redact(p) for p in ("http://u:p@h:1/x", "http://h", "", None)] == ["http://***@h:1/x", "http://h", "", ""]
