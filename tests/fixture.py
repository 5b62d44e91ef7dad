"""A small document, and random ones."""

import random

LINES = "quote \" backslash \\ line para  é 日本"


def node(own, kind, *kids, **more):
    out = {"id": own, "type": kind, **more}
    if kids:
        out["children"] = list(kids)
    return out


def document():
    frames = [node(f"1:{n}", "FRAME", *(node(f"{n}:{k}", "TEXT", text=LINES * k) for k in range(1, 4)), size=1.5) for n in (100, 200, 300)]
    return {"name": "Fixture", "lastModified": "2024-01-01T00:00:00Z", "version": "7", "document": node("0:0", "DOCUMENT", node("0:1", "CANVAS", *frames)), "components": {"c": {"k": 1}}, "componentSets": {}, "styles": {"s": None}}


def random_tree(seed, depth=5, width=4):
    r, n = random.Random(seed), [0]

    def grow(level):
        n[0] += 1
        out = {"id": f"{seed}:{n[0]}", "n": r.choice([1, 1.0, 1e-7, None, "x" * r.randint(0, 40), [1, {"a": 2}], LINES])}
        if level < depth and r.random() < 0.8:
            kids = [grow(level + 1) for _ in range(r.randint(0, width))]
            if r.random() < 0.5:
                out = {"children": kids, **out}
            else:
                out["children"] = kids
        return out

    root = grow(0)
    root.setdefault("children", []).append(grow(1))
    return {"name": f"t{seed}", "document": root, "extra": {"10": 1, "2": 2}}
