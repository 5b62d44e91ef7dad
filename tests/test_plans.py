import json

import pytest

from tests.fixture import document
from treeflow.plans import job, manifest, sizing
from treeflow.plans.sizing import BOUNDS, MIB, PRESETS, TIERS
from treeflow.sources.remote import Client, fixture_transport


def client(doc=None):
    return Client("", "token", fixture_transport(doc or document()))


# The parity cases, on a document rebuilt from what they state of it.
CASES = {
    "default": ({}, "auto", {"size": "md", "frontierDepth": 2, "idCount": 3}),
    "depth-1": ({"depth": 1}, "auto", {"frontierDepth": 1, "idCount": 1}),
    "size-large": ({}, "large", {"size": "large"}),
    "batch-1": ({"batch_size": 1}, "auto", {"batchSize": 1, "batchCount": 3}),
    "tiny-budget": ({"depth": 2, "max_part_bytes": 200}, "auto", {"frontierDepth": 2}),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name, spark):
    given, size, expected = CASES[name]
    r = job.run_document(client(), "key", job.Store(), size, **given)
    assert {k: r.manifest[k] for k in expected} == expected
    assert manifest.faults(r.manifest) == []
    assert r.file == document() and r.missing == []
    raw = spark.createDataFrame([("key", json.dumps(document()))], "file_key string, raw string")
    row = job.run_documents(raw, size, **given).first()
    m = json.loads(row.manifest)
    assert all(m[k] == r.manifest[k] for k in manifest.COMPARED) and json.loads(row.full) == document() and row.grafted == r.grafted


def test_tiny_budget_splits():
    r = job.run_document(client(), "key", job.Store(), "md", max_part_bytes=200)
    assert r.manifest["rechunked"] == 3 and r.manifest["oversizedLeaves"] == []
    assert len(job.run_document(client(), "key", job.Store(), "md", max_part_bytes=60).manifest["oversizedLeaves"]) == 9
    assert all(g["rechunked"] for g in r.manifest["groups"])


def test_levels_are_absolute():
    r = job.run_document(client(), "key", job.Store(), "md", max_part_bytes=200, max_level=2)
    assert r.manifest["rechunked"] == 0 and r.file == document()


def test_time_breach_only_unbatches(monkeypatch):
    ticks = iter(range(0, 10**6, 100))
    monkeypatch.setattr(job.time, "monotonic", lambda: next(ticks))
    r = job.run_document(client(), "key", job.Store(), "md", max_part_ms=1)
    assert r.manifest["rechunked"] == 0 and r.manifest["groups"][0]["rechunked"] and len(r.manifest["parts"]) == 3
    assert all(p["elapsedMs"] == 0 for p in r.manifest["parts"])


def test_whole_mode():
    r = job.run_document(client(), "key", job.Store(), "sm", max_part_bytes=1, skeleton_only=True)
    assert r.manifest["mode"] == "whole" and r.file == document() and manifest.faults(r.manifest) == []


def test_resume_reuses_committed_groups_only(tmp_path):
    store = job.Folder(str(tmp_path))
    first = job.run_document(client(), "key", store, "large", batch_size=2)
    again = job.run_document(client(), "key", job.Folder(str(tmp_path)), "large", batch_size=2)
    assert (first.manifest["downloaded"], again.manifest["downloaded"], again.manifest["resumedSkipped"]) == (2, 0, 2) and again.file == document()
    other = document() | {"version": "8"}
    assert job.run_document(client(other), "key", job.Folder(str(tmp_path)), "large", batch_size=2).manifest["resumedSkipped"] == 0
    assert job.run_document(client(), "key", job.Folder(str(tmp_path)), "large", batch_size=2, resume=False).manifest["resumedSkipped"] == 0
    (tmp_path / "parts" / first.manifest["parts"][0]["file"]).unlink()
    third = job.run_document(client(), "key", job.Folder(str(tmp_path)), "large", batch_size=2)
    assert third.manifest["resumedSkipped"] == 1 and third.file == document()


def test_missing_nodes_are_reported():
    serve = fixture_transport(document())

    def lossy(url, headers, timeout):
        r = serve(url, headers, timeout)
        if "/nodes" in url:
            body = json.loads(r.body)
            body["nodes"].pop("1:200", None)
            if "1:300" in body["nodes"]:
                body["nodes"]["1:300"] = None
            r.body = json.dumps(body)
        return r

    for given in ({}, {"max_part_bytes": 1}):
        assert job.run_document(Client("", "t", lossy), "key", job.Store(), "md", **given).missing == ["1:200", "1:300"]


def test_empty_frontier():
    r = job.run_document(client(), "key", job.Store(), "md", depth=9)
    assert r.manifest["idCount"] == 0 and r.manifest["parts"] == []


@pytest.mark.parametrize("nodes", [0, 3000, 3001, 30_001, 10**7])
@pytest.mark.parametrize("width", [0, 1, 51, 301, 2001])
@pytest.mark.parametrize("size", [0, 2 * MIB + 1, 8 * MIB + 1, 50 * MIB + 1])
def test_tier_bounds(nodes, width, size):
    tier = job.tier_of(nodes, width, size)
    if width == 0 and nodes <= 3000:
        assert tier == "sm"
    else:
        place = TIERS.index(tier)
        assert all(place == 4 or v <= BOUNDS[s][place] for s, v in (("nodes", nodes), ("frontier", width), ("bytes", size)))
        assert place == 0 or any(v > BOUNDS[s][place - 1] for s, v in (("nodes", nodes), ("frontier", width), ("bytes", size)))


def test_tier_columns(spark):
    rows = [(n, w, b) for n in (0, 3000, 3001, 30_001, 150_001, 10**7) for w in (0, 1, 51, 301, 2001) for b in (0, 2 * MIB + 1, 8 * MIB + 1, 50 * MIB + 1)]
    df = spark.createDataFrame(rows, "n_nodes long, frontier_width long, skeleton_bytes long").withColumn("tier", sizing.classify())
    assert all(r.tier == job.tier_of(r.n_nodes, r.frontier_width, r.skeleton_bytes) for r in df.collect())


def test_strategies(spark):
    df = spark.createDataFrame([(t,) for t in TIERS], "tier string")
    for given in ({}, {"depth": 7, "batch_size": 1}, {"max_part_bytes": 0}, {"max_part_bytes": 5}, {"max_part_ms": 9}):
        for r in sizing.with_strategy(df, **given).collect():
            s = sizing.strategy_for(r.tier, **given)
            assert all(getattr(r, f) == getattr(s, f) for f in PRESETS["sm"].__dataclass_fields__)
    assert sizing.strategy_for("sm", max_part_bytes=5).mode == "whole"
    with pytest.raises(ValueError, match="unknown size tier"):
        sizing.strategy_for("huge")
    with pytest.raises(Exception, match="unknown size tier"):
        sizing.with_strategy(spark.createDataFrame([("huge",)], "tier string")).collect()


def test_manifest_faults():
    good = manifest.whole_manifest("k", "sm")
    assert manifest.faults(good) == []
    for bad in ({"size": None}, {"batchSize": 0}, {"idCount": -1}, {"idCount": True}, {"idCount": 1.5}, {"parts": [{"file": "x"}]}, {"oversizedLeaves": [1]}):
        assert manifest.faults(good | bad)
    assert manifest.faults({k: v for k, v in good.items() if k != "parts"})


def test_a_plan_is_told_before_nodes_are_asked_for():
    serve, seen = fixture_transport(document()), []

    def watched(url, headers, timeout):
        seen.append("nodes" if "/nodes" in url else "skeleton")
        return serve(url, headers, timeout)

    job.run_document(Client("", "t", watched), "key", job.Store(), "auto", on_plan=lambda p: seen.append(p.concurrency))
    assert seen[:2] == ["skeleton", 4] and set(seen[2:]) == {"nodes"}


def test_empty_frontiers_are_warned_of():
    said = []
    job.run_document(client(), "key", job.Store(), "md", depth=9, log=said.append)
    assert any("no frontier nodes at depth 9" in s for s in said)


def test_streamed_parts_are_the_same_files(tmp_path):
    text = "é" * 70_000 + "\r\n" + "x" * 70_000
    for kind in (job.Folder, lambda f: job.SharedStore(f"file://{f}")):
        for stream in (False, True):
            store = kind(str(tmp_path / f"{kind is job.Folder}{stream}"))
            store.put("part-a.json", text, stream)
            assert (tmp_path / f"{kind is job.Folder}{stream}" / "parts" / "part-a.json").read_bytes() == text.encode()
    assert [len(s) for s in job.slices(text)] == [65_536, 65_536, 140_002 - 2 * 65_536]


def test_runs_of_many_remote_documents_resume(spark, tmp_path):
    """Documents of a service, asked for by the tasks; a second run asks for skeletons only."""
    calls = tmp_path / "calls"
    calls.mkdir()

    def connect(key, raw):
        serve = fixture_transport(document() | {"name": key})

        def counted(url, headers, timeout):
            if "/nodes" in url:
                import uuid

                (calls / uuid.uuid4().hex).touch()
            return serve(url, headers, timeout)

        return Client("", "t", counted)

    keys = spark.createDataFrame([(f"k{i}",) for i in range(5)], "file_key string").repartition(3)
    given = {"connect": connect, "store": f"file://{tmp_path}/store", "batch_size": 2, "max_part_bytes": 400}
    first = {r.file_key: r for r in job.run_documents(keys, "large", **given).collect()}
    assert len(list(calls.iterdir())) == 10 and len(first) == 5
    again = {r.file_key: r for r in job.run_documents(keys, "large", **given).collect()}
    assert len(list(calls.iterdir())) == 10
    for k, r in again.items():
        assert json.loads(r.full) == document() | {"name": k} and r.full == first[k].full and r.missing == []
        assert json.loads(r.manifest)["resumedSkipped"] == 2 and json.loads(first[k].manifest)["resumedSkipped"] == 0


def test_group_keys_are_the_same_in_spark(spark):
    rows = [("sha", "v", "o"), ("sha", None, "o"), ("sha", "v", None)]
    df = spark.createDataFrame(rows, "sha string, version string, options string")
    from treeflow.operators import resume

    got = [r.k for r in df.select(resume.content_key("sha", "version", "options").alias("k")).collect()]
    assert got == [resume.key_of(*r) for r in rows] and len(set(got)) == 3


def test_public_names():
    import treeflow

    assert all(getattr(treeflow, n) is not None for n in treeflow.__all__) and len(treeflow.__all__) > 60
    with pytest.raises(AttributeError):
        treeflow.nothing  # noqa: B018


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from treeflow.shared import shared_dir

    bare = lambda master: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None))
    assert shared_dir(bare("local[4]")).startswith("file://")
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="checkpoint"):
            shared_dir(bare(master))
