"""Tables of the library."""

from __future__ import annotations

from pyspark.sql import types as T

_s, _l, _i = T.StringType(), T.LongType(), T.IntegerType()


def _struct(*pairs) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


#: A document is the list of its nodes.  `path` holds the child positions from the root and
#: orders the nodes; `props` is the node's JSON without a children list; `children_at` is the
#: place of that list among the node's keys (null: none); is_object is false for children
#: that are no JSON objects, whose text is in props.
NODES = _struct(
    ("file_key", _s), ("id", _s), ("parent_id", _s), ("level", _i), ("ord", _i), ("path", T.ArrayType(_i, False)),
    ("type", _s), ("props", _s), ("children_at", _i), ("is_object", T.BooleanType()),
)
#: What surrounds a document's tree.
FILES = _struct(("file_key", _s), ("name", _s), ("version", _s), ("last_modified", _s), ("envelope", _s), ("root_at", _i))
ASSETS = _struct(("file_key", _s), ("kind", _s), ("key", _s), ("value", _s), ("seq", _l))
FRONTIER = _struct(("file_key", _s), ("id", _s), ("pos", _l))
PARTS = _struct(("file_key", _s), ("sha", _s), ("file", _s), ("ids", T.ArrayType(_s)), ("bytes", _l), ("elapsed_ms", T.DoubleType()), ("payload", _s))
GROUPS = _struct(("file_key", _s), ("batch_no", _l), ("sha", _s), ("ids", T.ArrayType(_s)), ("parts", T.ArrayType(_s)), ("rechunked", T.BooleanType()), ("resumed", T.BooleanType()))

_PART = _struct(("file", _s), ("ids", T.ArrayType(_s)), ("sha", _s), ("bytes", _l), ("elapsedMs", T.DoubleType()))
_GROUP = _struct(("sha", _s), ("ids", T.ArrayType(_s)), ("parts", T.ArrayType(_s)), ("rechunked", T.BooleanType()), ("resumed", T.BooleanType()))
MANIFEST = _struct(
    ("fileKey", _s), ("size", _s), ("frontierDepth", _i), ("batchSize", _i), ("concurrency", _i), ("idCount", _l), ("batchCount", _l),
    ("downloaded", _l), ("resumedSkipped", _l), ("rechunked", _l), ("oversizedLeaves", T.ArrayType(_s)), ("frontierIds", T.ArrayType(_s)),
    ("parts", T.ArrayType(_PART)), ("groups", T.ArrayType(_GROUP)), ("mode", _s),
)
