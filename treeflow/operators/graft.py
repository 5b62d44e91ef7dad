"""Joining parts back into documents."""

from __future__ import annotations

import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema
from ..functions.canon import canonical
from ..shared import cut
from ..ship import ship
from .flatten import ASSET_KINDS, node_rows

MAX_LEVELS = 200


def last_wins(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """keys and the value of the last row by the order; a combinable maximum."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def part_entries(parts: DataFrame) -> DataFrame:
    """(file_key, file, pos, id, document, components, componentSets, styles) of every entry of
    the parts' `nodes`; a null entry, or one without a document, has a null document."""
    ship(parts.sparkSession)
    kind = "file_key string, file string, pos int, id string, document string, " + ", ".join(f"{k} map<string,string>" for k in ASSET_KINDS)

    def run(batches):
        for batch in batches:
            out = []
            for key, file, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                nodes = (json.loads(payload) if payload else {}).get("nodes") or {}
                for pos, (own, entry) in enumerate(nodes.items()):
                    entry = entry if isinstance(entry, dict) else {}
                    doc = entry.get("document")
                    maps = ([(k, canonical(v)) for k, v in (entry.get(a) or {}).items()] for a in ASSET_KINDS)
                    out.append((key, file, pos, own, None if doc is None else canonical(doc), *maps))
            types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), *[pa.map_(pa.string(), pa.string())] * 3]
            cols = list(zip(*out, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["file_key", "file", "pos", "id", "document", *ASSET_KINDS])

    return parts.select("file_key", "file", "payload").mapInArrow(run, kind)


def index_parts(entries: DataFrame) -> DataFrame:
    """(file_key, id, document): the last one by file name, then place in the file."""
    return last_wins(entries.filter(F.col("document").isNotNull()), ["file_key", "id"], "document", ["file", "pos"])


def merge_assets(entries: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """(file_key, kind, key, value): later parts win over earlier ones, and all over the base."""
    rows = None
    for kind in ASSET_KINDS:
        own = entries.select("file_key", F.lit(kind).alias("kind"), "file", "pos", F.explode(kind).alias("key", "value"))
        rows = own if rows is None else rows.unionByName(own)
    if base is not None:
        rows = rows.unionByName(base.select("file_key", "kind", F.lit("").alias("file"), F.lit(-1).alias("pos"), "key", "value"))
    return last_wins(rows, ["file_key", "kind", "key"], "value", ["file", "pos"])


def missing_ids(frontier: DataFrame, index: DataFrame) -> DataFrame:
    """Frontier rows whose id no part returned."""
    return frontier.join(index.select("file_key", "id"), ["file_key", "id"], "left_anti")


def missing_preview(missing: DataFrame, n: int = 5) -> DataFrame:
    """(file_key, n_missing, preview): how many, and the first n in order.

    Tasks keep their first n of each file before the shuffle, so no list of all is gathered."""
    first = missing.withColumn("nth", F.row_number().over(W.partitionBy("file_key").orderBy("pos", "id"))).filter(F.col("nth") <= n)
    first = first.groupBy("file_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "id"))), lambda x: x["id"]).alias("preview"))
    return missing.groupBy("file_key").agg(F.count("*").alias("n_missing")).join(first, "file_key")


def entry_nodes(index: DataFrame) -> DataFrame:
    """NODES of every indexed entry with its id as `entry`."""
    ship(index.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = type(schema.NODES)([*schema.NODES.fields]).add("entry", "string")
    arrow = to_arrow_schema(kind)

    def run(batches):
        for batch in batches:
            out = []
            for key, own, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                out += [(*row, own) for row in node_rows(json.loads(text), key)]
            cols = list(zip(*out, strict=True)) or [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return index.select("file_key", "id", "document").mapInArrow(run, kind)


def graft(skeleton: DataFrame, index: DataFrame, max_levels: int = MAX_LEVELS) -> tuple[DataFrame, DataFrame]:
    """(NODES of the grafted documents, (file_key, grafted)).

    Walks down from the roots: a node whose id is indexed is replaced by the index's, and its
    children are walked in turn, so shallow parents of split parts take in their children's
    parts.  Each level is one join with the index and one with the children, whatever the
    number of documents; it ends when no node has children."""
    base = skeleton.withColumn("entry", F.lit(None).cast("string"))
    every = base.unionByName(entry_nodes(index)).select("file_key", "entry", "id", "path", "type", "props", "children_at", "is_object")
    every = every.withColumn("up", F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0))))
    roots = every.filter(F.size("path") == 0)
    heads = roots.filter(F.col("entry").isNotNull()).select(F.col("file_key").alias("h_key"), F.col("entry").alias("own"), *(F.col(c).alias(f"new_{c}") for c in ("id", "type", "props", "children_at", "is_object")))
    children = every.filter(F.size("path") > 0).select(F.col("file_key").alias("c_key"), F.col("entry").alias("from_entry"), F.col("up").alias("from_path"), F.col("path").alias("src_path"), "id", "type", "props", "children_at", "is_object")

    slots = roots.filter(F.col("entry").isNull()).select("file_key", F.lit(None).cast("string").alias("src"), F.col("path").alias("src_path"), F.lit(None).cast("string").alias("parent_id"), F.col("path").alias("path"), "id", "type", "props", "children_at", "is_object")
    out, hits = None, None
    for _ in range(max_levels):
        joined = slots.join(heads, (F.col("file_key") == F.col("h_key")) & (F.col("id") == F.col("own")) & (F.col("id") != "") & F.col("is_object"), "left")
        hit = F.col("own").isNotNull()
        now = cut(joined.select(
            "file_key",
            F.when(hit, F.col("own")).otherwise(F.col("src")).alias("src"),
            F.when(hit, F.array().cast("array<int>")).otherwise(F.col("src_path")).alias("src_path"),
            "parent_id",
            "path",
            *(F.when(hit, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in ("id", "type", "props", "children_at", "is_object")),
            hit.alias("hit"),
        ))
        count = now.groupBy("file_key").agg(F.count_if("hit").alias("grafted"))
        out, hits = (now, count) if out is None else (out.unionByName(now), hits.unionByName(count))
        open_ = now.filter(F.col("children_at").isNotNull()).select("file_key", F.col("src").alias("p_src"), F.col("src_path").alias("p_path"), F.col("path").alias("at"), F.col("id").alias("p_id"))
        slots = open_.join(children, (F.col("file_key") == F.col("c_key")) & F.col("p_src").eqNullSafe(F.col("from_entry")) & (F.col("p_path") == F.col("from_path"))).select(
            "file_key", F.col("p_src").alias("src"), "src_path", F.col("p_id").alias("parent_id"), F.concat("at", F.slice("src_path", F.size("src_path"), 1)).alias("path"), "id", "type", "props", "children_at", "is_object"
        )
        if slots.isEmpty():
            break
    else:
        raise RuntimeError(f"documents deeper than {max_levels} levels, or parts that hold themselves")
    nodes = out.select("file_key", "id", "parent_id", F.size("path").alias("level"), F.coalesce(F.element_at(F.when(F.size("path") > 0, F.col("path")), -1), F.lit(0)).alias("ord"), "path", "type", "props", "children_at", "is_object")
    return nodes, hits.groupBy("file_key").agg(F.sum("grafted").alias("grafted"))


def graft_tree(root, index: dict):
    """(grafted tree, number of hits) of one document in memory."""
    hits = 0

    def chosen(node):
        nonlocal hits
        if isinstance(node, dict) and (own := node.get("id")) and own in index:
            hits += 1
            return index[own]
        return node

    top = [None]
    work = [(root, top, 0)]
    while work:
        node, into, place = work.pop()
        node = chosen(node)
        if isinstance(node, dict) and isinstance(node.get("children"), list):
            kids = list(node["children"])
            node = {**node, "children": kids}
            work += [(k, kids, i) for i, k in enumerate(kids)]
        into[place] = node
    return top[0], hits


def reconstruct(skeletons: DataFrame, parts: DataFrame, frontier: DataFrame | None = None, pretty: bool = False) -> DataFrame:
    """(file_key, full, grafted, missing) of whole documents in byte-stable text.

    skeletons: file_key, raw.  A document is built by one task; documents are spread."""
    ship(skeletons.sparkSession)
    entries = part_entries(parts)
    packed = entries.groupBy("file_key").agg(F.collect_list(F.struct("file", "pos", "id", "document", *ASSET_KINDS)).alias("entries"))
    ids = frontier.groupBy("file_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("frontier")) if frontier is not None else None
    rows = skeletons.select("file_key", "raw").join(packed, "file_key", "left")
    rows = rows.join(ids, "file_key", "left") if ids is not None else rows.withColumn("frontier", F.array().cast("array<string>"))

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                file = json.loads(row.raw)
                index, maps = {}, {k: dict(file.get(k) or {}) for k in ASSET_KINDS}
                for e in sorted(row.entries if row.entries is not None else (), key=lambda e: (e["file"], e["pos"])):
                    if e["document"] is not None:
                        index[e["id"]] = json.loads(e["document"])
                    for k in ASSET_KINDS:
                        maps[k].update({n: json.loads(v) for n, v in dict(e[k] or {}).items()})
                tree, hits = graft_tree(file.get("document"), index)
                full = canonical({**file, "document": tree, **maps}, pretty)
                wanted = row.frontier if row.frontier is not None else ()
                out.append((row.file_key, full, hits, [i for i in wanted if i not in index]))
            yield pd.DataFrame(out, columns=["file_key", "full", "grafted", "missing"])

    return rows.mapInPandas(run, "file_key string, full string, grafted long, missing array<string>")


__all__ = ["entry_nodes", "graft", "graft_tree", "index_parts", "last_wins", "merge_assets", "missing_ids", "missing_preview", "part_entries", "reconstruct"]
