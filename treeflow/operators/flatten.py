"""JSON documents to node tables and back.

A document is parsed once, by the task that holds its row, with an explicit stack, so depth
is not bounded by recursion.  Rows keep enough to write the same text again: key order, the
place of the children list, and values that are no objects.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.canon import canonical
from ..ship import ship

ASSET_KINDS = ("components", "componentSets", "styles")


def node_rows(root, file_key: str | None) -> Iterator[tuple]:
    """NODES rows of a parsed tree, parents first."""
    stack = [(root, None, 0, 0, ())]
    while stack:
        node, parent, level, place, path = stack.pop()
        if not isinstance(node, dict):
            yield (file_key, None, parent, level, place, list(path), None, canonical(node), None, False)
            continue
        kids = node.get("children")
        at = list(node).index("children") if isinstance(kids, list) else None
        props = {k: v for k, v in node.items() if at is None or k != "children"}
        own, kind = node.get("id"), node.get("type")
        own = own if own is None or isinstance(own, str) else canonical(own)
        yield (file_key, own, parent, level, place, list(path), kind if isinstance(kind, str) else None, canonical(props), at, True)
        if at is not None:
            stack += [(c, own, level + 1, i, (*path, i)) for i, c in reversed(list(enumerate(kids)))]


def tree_of(rows) -> object:
    """The parsed tree again, from (path, props, children_at, is_object) in any order."""
    built: dict[tuple, object] = {}
    for path, props, at, is_object in sorted(rows, key=lambda r: tuple(r[0])):
        value = json.loads(props)
        if is_object and at is not None and not pd.isna(at):
            items = list(value.items())
            items.insert(int(at), ("children", []))
            value = dict(items)
        path = tuple(path)
        built[path] = value
        if path:
            built[path[:-1]]["children"].append(value)
    return built[()]


def _arrow(rows: list[tuple], like) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = to_arrow_schema(like)
    cols = list(zip(*rows, strict=True)) or [[]] * len(kind)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kind, strict=True)], schema=kind)


def _mapped(docs: DataFrame, key_col: str, json_col: str, like, rows_of, chunk: int = 20_000) -> DataFrame:
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for row in rows_of(key, text):
                    out.append(row)
                    if len(out) == chunk:
                        yield _arrow(out, like)
                        out = []
            yield _arrow(out, like)

    return docs.select(F.col(key_col).cast("string"), F.col(json_col)).mapInArrow(run, like)


def _file(text):
    value = json.loads(text) if text else None
    return value if isinstance(value, dict) else {}


def flatten(files: DataFrame, key_col: str = "file_key", json_col: str = "raw") -> DataFrame:
    """NODES of documents given as JSON text; one without a `document` object has no nodes."""

    def rows_of(key, text):
        root = _file(text).get("document")
        return node_rows(root, key) if isinstance(root, dict) else ()

    return _mapped(files, key_col, json_col, schema.NODES, rows_of)


def envelopes(files: DataFrame, key_col: str = "file_key", json_col: str = "raw") -> DataFrame:
    """FILES rows: all but the tree, and the place of `document` among the keys."""

    def rows_of(key, text):
        file = _file(text)
        at = list(file).index("document") if "document" in file else None
        plain = lambda k: file[k] if isinstance(file.get(k), str) else None if file.get(k) is None else canonical(file[k])
        yield (key, plain("name"), plain("version"), plain("lastModified"), canonical({k: v for k, v in file.items() if k != "document"}), at)

    return _mapped(files, key_col, json_col, schema.FILES, rows_of)


def assets(files: DataFrame, key_col: str = "file_key", json_col: str = "raw") -> DataFrame:
    """ASSETS rows of the three asset maps of documents."""

    def rows_of(key, text):
        seq = 0
        for kind in ASSET_KINDS:
            for name, value in (_file(text).get(kind) or {}).items():
                yield (key, kind, name, canonical(value), seq)
                seq += 1

    return _mapped(files, key_col, json_col, schema.ASSETS, rows_of)


def serialise(nodes: DataFrame, pretty: bool = False, keys=("file_key",)) -> DataFrame:
    """keys and document: the canonical text of each key's tree.  A tree is one row of output,
    so its rows meet in one task; trees spread over all tasks."""
    ship(nodes.sparkSession)

    def whole(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = zip(pdf["path"], pdf["props"], pdf["children_at"], pdf["is_object"], strict=True)
        return pd.DataFrame({**{k: [v] for k, v in zip(keys, key, strict=True)}, "document": [canonical(tree_of(rows), pretty)]})

    kinds = ", ".join(f"{k} {nodes.schema[k].dataType.simpleString()}" for k in keys)
    return nodes.groupBy(*keys).applyInPandas(whole, f"{kinds}, document string")


def edges_from_tables(region: DataFrame, nation: DataFrame, customer: DataFrame, orders: DataFrame) -> DataFrame:
    """The reference tables as one tree: root, regions, nations, customers, orders; ids are level:key.
    Columns id, parent_id, level, own_bytes and key (its order among siblings)."""

    def level(df, n, key, parent, text):
        up = F.lit("0:0") if parent is None else F.concat(F.lit(f"{n - 1}:"), F.col(parent).cast("string"))
        return df.select(F.concat(F.lit(f"{n}:"), F.col(key).cast("string")).alias("id"), up.alias("parent_id"), F.lit(n).alias("level"), F.octet_length(text).cast("long").alias("own_bytes"), F.col(key).cast("long").alias("key"))

    root = region.sparkSession.range(1).select(F.lit("0:0").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("own_bytes"), F.lit(0).cast("long").alias("key"))
    out = root.unionByName(level(region, 1, "r_regionkey", None, "r_name"))
    out = out.unionByName(level(nation, 2, "n_nationkey", "n_regionkey", "n_name"))
    out = out.unionByName(level(customer, 3, "c_custkey", "c_nationkey", "c_name"))
    return out.unionByName(level(orders, 4, "o_orderkey", "o_custkey", "o_orderpriority"))
