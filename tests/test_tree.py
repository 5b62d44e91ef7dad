import json
import random

import pytest

from tests.fixture import document, node, random_tree
from treeflow.functions.canon import canonical
from treeflow.operators import budget, flatten, frontier, graft, measure, resume
from treeflow.plans import job


def files(spark, docs):
    return spark.createDataFrame([(f"f{i}", canonical(d)) for i, d in enumerate(docs)], "file_key string, raw string")


DOCS = [document(), *(random_tree(s) for s in range(6)), {"document": node("a", "X", 1, None, "t", node("b", "Y"))}]


@pytest.fixture(scope="module")
def nodes(spark):
    return flatten.flatten(files(spark, DOCS)).cache()


def all_nodes(doc):
    return list(job.walk(doc["document"]))


def test_round_trip_is_byte_exact(spark, nodes):
    got = {r.file_key: r.document for r in flatten.serialise(nodes).collect()}
    assert got == {f"f{i}": canonical(d["document"]) for i, d in enumerate(DOCS)}


def test_documents_without_a_tree(spark):
    df = spark.createDataFrame([("a", None), ("b", "[]"), ("c", '{"document": null}')], "file_key string, raw string")
    assert flatten.flatten(df).count() == 0 and flatten.envelopes(df).count() == 3 and flatten.assets(df).count() == 0


def test_counts_and_sizes(spark, nodes):
    counts = {r.file_key: r.n_nodes for r in measure.count_nodes(nodes).collect()}
    assert counts == {f"f{i}": len(all_nodes(d)) for i, d in enumerate(DOCS)}
    sized = {(r.file_key, r.id): r for r in measure.subtree_sizes(nodes).filter("is_object").collect()}
    for i, d in enumerate(DOCS):
        for n, _ in all_nodes(d):
            r = sized[f"f{i}", n["id"]]
            assert r.bytes == len(canonical(n).encode())
            assert (r.children, r.descendants) == (len(n.get("children", [])), sum(1 for _ in job.walk(n)) - 1)


def test_skeleton_and_signals(spark, nodes):
    for depth in (0, 1, 2, 9):
        got = {r.file_key: r for r in measure.signals(nodes, depth).collect()}
        for i, d in enumerate(DOCS):
            from treeflow.sources.remote import fixture_transport

            cut = json.loads(fixture_transport(d)(f"/files/k?depth={depth}", {}, 1).body)
            r = got[f"f{i}"]
            assert (r.n_nodes, r.frontier_width) == (len(all_nodes(cut)), len(job.frontier_of(cut, depth)))
            assert r.skeleton_bytes == len(canonical(cut["document"]).encode())


def test_find_node(nodes):
    assert {r.file_key for r in measure.find_node(nodes, "1:200").collect()} == {"f0"}


@pytest.mark.parametrize("depth", [0, 1, 2, 3, 50])
def test_frontier_and_batches(spark, nodes, depth):
    front = frontier.collect_frontier(nodes, depth)
    own = {f"f{i}": job.frontier_of(d, depth) for i, d in enumerate(DOCS)}
    got = {}
    for r in sorted(front.collect(), key=lambda r: r.pos):
        got.setdefault(r.file_key, []).append(r.id)
    assert got == {k: v for k, v in own.items() if v}
    for size in (0, 1, 3):
        rows = frontier.batches(front, size).collect()
        step = max(1, size)
        assert {(r.file_key, r.batch_no): (r.ids, r.sha) for r in rows} == {(k, i // step): (v[i : i + step], job.sha_of(v[i : i + step])) for k, v in own.items() for i in range(0, len(v), step)}


def test_frontier_keeps_the_first_of_repeated_ids(spark):
    doc = {"document": node("r", "D", node("x", "F", a=1), node("y", "F"), node("x", "F", a=2), node("", "F"), {"type": "F"})}
    rows = frontier.collect_frontier(flatten.flatten(files(spark, [doc])), 1).collect()
    assert [(r.id, r.pos) for r in sorted(rows, key=lambda r: r.pos)] == [("x", 0), ("y", 1)]


@pytest.mark.parametrize(("max_bytes", "max_level"), [(200, 4), (80, 4), (10, 3), (0, 4), (10**6, 4), (10, 1)])
def test_split_plan(spark, nodes, max_bytes, max_level):
    sized = measure.subtree_sizes(nodes).filter("is_object")
    plan = budget.split_plan(sized, frontier.collect_frontier(nodes, 1), max_bytes, max_level).collect()
    own = set()
    for i, d in enumerate(DOCS):
        for n, level in all_nodes(d):
            if level == 1:
                own |= {(f"f{i}", own_id, shallow, over) for own_id, _, shallow, over in job.split_parts(n, 1, max_bytes, max_level)}
    assert {(r.file_key, r.id, r.split, r.oversized) for r in plan} == own
    assert all(r.sha == job.sha_of([r.id]) for r in plan)


def test_oversized_leaves_in_order(spark):
    plan = spark.createDataFrame([("f", "b", 1, True), ("f", "a", 2, True), ("f", "b", 3, True), ("f", "c", 0, False)], "file_key string, id string, pos int, oversized boolean")
    assert budget.oversized_leaves(plan, ["pos"]).first().oversizedLeaves == ["b", "a"]


def parts_of(doc, depth, max_bytes, max_level=4):
    out = []
    for n, level in all_nodes(doc):
        if level == depth and n.get("id"):
            for own, text, _, _ in job.split_parts(n, depth, max_bytes, max_level):
                out.append((f"part-{job.sha_of([own])}.json", canonical({"nodes": {own: {"document": json.loads(text)}}})))
    return out


@pytest.mark.parametrize("depth", [1, 2])
@pytest.mark.parametrize("max_bytes", [30, 10**6])
def test_graft_gives_the_document_back(spark, depth, max_bytes):
    docs = DOCS[:4]
    raw = files(spark, docs)
    nodes = flatten.flatten(raw)
    rows = [(f"f{i}", file, text) for i, d in enumerate(docs) for file, text in parts_of(d, depth, max_bytes)]
    parts = spark.createDataFrame(rows, "file_key string, file string, payload string")
    index = graft.index_parts(graft.part_entries(parts))
    whole, hits = graft.graft(measure.skeleton(nodes, depth), index)
    assert {r.file_key: r.document for r in flatten.serialise(whole).collect()} == {f"f{i}": canonical(d["document"]) for i, d in enumerate(docs)}
    own = {}
    for i, d in enumerate(docs):
        front = {n["id"]: n for n, level in all_nodes(d) if level == depth}
        indexed = {r.id: json.loads(r.document) for r in index.filter(f"file_key = 'f{i}'").collect()}
        cut = {"id": d["document"].get("id"), "children": []}
        del cut
        own[f"f{i}"] = graft.graft_tree(d["document"], indexed)[1]
        assert set(front) <= set(indexed)
    assert {r.file_key: r.grafted for r in hits.collect()} == own
    skeletons = spark.createDataFrame([(f"f{i}", json.dumps(_cut(d, depth))) for i, d in enumerate(docs)], "file_key string, raw string")
    full = {r.file_key: json.loads(r.full) for r in graft.reconstruct(skeletons, parts, frontier.collect_frontier(nodes, depth)).collect()}
    assert all(full[f"f{i}"]["document"] == d["document"] for i, d in enumerate(docs))


def _cut(doc, depth):
    from treeflow.sources.remote import fixture_transport

    return json.loads(fixture_transport(doc)(f"/files/k?depth={depth}", {}, 1).body)


def test_index_order_nulls_and_assets(spark):
    rows = [
        ("f", "part-b.json", canonical({"nodes": {"x": {"document": {"id": "x", "v": 2}, "styles": {"s": 2}}, "n": None, "e": {"document": None}}})),
        ("f", "part-a.json", canonical({"nodes": {"x": {"document": {"id": "x", "v": 1}, "styles": {"s": 1, "t": 1}}}})),
        ("f", "part-c.json", canonical({"name": "no nodes"})),
    ]
    entries = graft.part_entries(spark.createDataFrame(rows, "file_key string, file string, payload string"))
    assert [(r.id, json.loads(r.document)["v"]) for r in graft.index_parts(entries).collect()] == [("x", 2)]
    base = spark.createDataFrame([("f", "styles", "s", "0", 0), ("f", "styles", "u", "0", 1)], "file_key string, kind string, key string, value string, seq long")
    assert {(r.key, r.value) for r in graft.merge_assets(entries, base).collect()} == {("s", "2"), ("t", "1"), ("u", "0")}
    front = spark.createDataFrame([("f", i, p) for p, i in enumerate("xnezyw")] + [("f", f"m{k}", 10 + k) for k in range(4)], "file_key string, id string, pos long")
    r = graft.missing_preview(graft.missing_ids(front, graft.index_parts(entries))).first()
    assert (r.n_missing, r.preview) == (9, ["n", "e", "z", "y", "w"])


def test_parts_that_hold_themselves_are_an_error(spark):
    raw = files(spark, [{"document": node("r", "D", node("x", "F"))}])
    index = spark.createDataFrame([("f0", "x", canonical(node("x", "F", node("x", "F"))))], "file_key string, id string, document string")
    with pytest.raises(RuntimeError, match="deeper"):
        graft.graft(flatten.flatten(raw), index, max_levels=4)


def test_deep_chain():
    root = cur = {"id": "0"}
    for i in range(1, 5000):
        cur["children"] = [{"id": str(i)}]
        cur = cur["children"][0]
    rows = list(flatten.node_rows({"id": "r", "children": [root]}, "k"))
    assert len(rows) == 5001 and graft.graft_tree(root, {})[1] == 0


def test_resume(spark):
    groups = spark.createDataFrame([("f", "s1", ["a", "b"], False), ("f", "s2", ["c"], True), ("f", "s3", [], False)], "file_key string, sha string, parts array<string>, rechunked boolean")
    present = spark.createDataFrame([("f", "a"), ("f", "b"), ("f", "b"), ("g", "c")], "file_key string, file string")
    wanted = spark.createDataFrame([("f", f"s{i}") for i in range(1, 5)], "file_key string, sha string")
    todo, old = resume.split_by_resume(wanted, groups, present)
    assert sorted(r.sha for r in todo.collect()) == ["s2", "s3", "s4"] and [(r.sha, r.parts) for r in old.collect()] == [("s1", ["a", "b"])]
    keyed = wanted.limit(1).selectExpr("*", "'1' v1", "'2' v2", "'o' o").select(resume.content_key("sha", "v1", "o").alias("a"), resume.content_key("sha", "v2", "o").alias("b")).first()
    assert keyed.a != keyed.b and len(keyed.a) == 12


def test_random_split_and_join():
    for seed in range(30):
        r = random.Random(seed)
        doc = random_tree(100 + seed)
        from treeflow.sources.remote import Client, fixture_transport

        client = Client("", "t", fixture_transport(doc))
        got = job.run_document(client, "k", job.Store(), "md", depth=r.randint(0, 4), batch_size=r.randint(1, 5), max_part_bytes=r.choice([0, 1, 50, 300, 10**6]), max_level=r.randint(0, 6))
        assert got.file["document"] == doc["document"] and not got.missing


def test_shallow_parts(spark, nodes):
    split = nodes.filter("is_object and level <= 1 and children_at is not null").select("file_key", "id")
    got = {(r.file_key, r.id): r.document for r in budget.shallow_parts(nodes, split).collect()}
    own = {}
    for i, d in enumerate(DOCS):
        for n, level in job.walk(d["document"]):
            if level <= 1 and isinstance(n.get("children"), list):
                bare = [{k: v for k, v in c.items() if k != "children"} if isinstance(c, dict) else c for c in n["children"]]
                own[f"f{i}", n["id"]] = canonical({**n, "children": bare})
    assert got == own


@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_numbered(spark, rows):
    values = list(range(rows))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v // 3, f"n{v:05d}") for v in values], "a int, b string").repartition(7)
    got = sorted(((r.a, r.b), r.place) for r in frontier.numbered(df, ["a", "b"]).collect())
    assert [p for _, p in got] == list(range(1, rows + 1))


def test_answers(spark):
    front = spark.createDataFrame([("f", f"i{k}", k) for k in range(4)], "file_key string, id string, pos long")
    entries = spark.createDataFrame([("f", "i1", "{}"), ("f", "i3", None), ("g", "i0", "{}")], "file_key string, id string, document string")
    assert [(r.id, r.there) for r in frontier.with_answers(front, entries).orderBy("pos").collect()] == [("i0", False), ("i1", True), ("i2", False), ("i3", False)]
    assert [tuple(r) for r in frontier.returned(front, entries).collect()] == [("f", 4, 1)]


def test_split_plan_stops_when_nothing_splits(spark):
    sized = spark.createDataFrame([("f", "a", None, 0, 10, 1), ("f", "b", "a", 1, 9, 0)], "file_key string, id string, parent_id string, level int, bytes long, children int")
    roots = sized.filter("level = 0").select("file_key", "id")
    assert {(r.id, r.split) for r in budget.split_plan(sized, roots, 100).collect()} == {("a", False)}
    assert {(r.id, r.split, r.oversized) for r in budget.split_plan(sized, roots, 5).collect()} == {("a", True, False), ("b", False, True)}
    assert {r.id for r in budget.split_plan(sized, roots, 5, max_level=0).collect()} == {"a"}
