"""Queries that apply the operators to the reference tables, each with its DuckDB SQL where
SQL can express it.

The tree is root, region, nation, customer, order; node ids are level:key.  SPECS maps a name
to (query, SQL or None).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .functions import canon, scalars
from .operators import budget, flatten, frontier, graft, measure, resume
from .operators.flatten import edges_from_tables
from .plans import job, manifest, sizing
from .shared import cut, new_folder
from .ship import ship
from .sources import workdir
from .streaming.limiter import replay

SPECS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def add(f):
        SPECS[f.__name__] = (f, sql)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges_from_tables(*(table(spark, sf_dir, t) for t in ("region", "nation", "customer", "orders")))


_TREE = """n AS (
  SELECT '0:0' AS id, NULL::VARCHAR AS parent_id, 0 AS level, 0::BIGINT AS own_bytes, 0::BIGINT AS key
  UNION ALL SELECT '1:' || r_regionkey, '0:0', 1, strlen(r_name), r_regionkey FROM region
  UNION ALL SELECT '2:' || n_nationkey, '1:' || n_regionkey, 2, strlen(n_name), n_nationkey FROM nation
  UNION ALL SELECT '3:' || c_custkey, '2:' || c_nationkey, 3, strlen(c_name), c_custkey FROM customer
  UNION ALL SELECT '4:' || o_orderkey, '3:' || o_custkey, 4, strlen(o_orderpriority), o_orderkey FROM orders)"""
_SIZES = """anc AS (SELECT id AS root, id, own_bytes FROM n UNION ALL SELECT a.root, n.id, n.own_bytes FROM anc a JOIN n ON n.parent_id = a.id),
sz AS (SELECT root AS id, sum(own_bytes)::BIGINT AS bytes, (count(*) - 1)::BIGINT AS descendants FROM anc GROUP BY root)"""


def conversation_files(spark, sf_dir) -> DataFrame:
    """Conversations as documents: a page each role, a frame each turn."""
    c = table(spark, sf_dir, "conversations")
    frame = F.struct(F.concat_ws(":", F.lit("2"), "conv_id", "turn").alias("id"), F.lit("FRAME").alias("type"), F.array(F.struct(F.concat_ws(":", F.lit("3"), "conv_id", "turn").alias("id"), F.col("text").alias("text"))).alias("children"))
    pages = c.groupBy("conv_id", "role").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", frame.alias("f")))), lambda x: x["f"]).alias("children"))
    page = F.struct(F.concat_ws(":", F.lit("1"), "conv_id", "role").alias("id"), F.lit("CANVAS").alias("type"), F.col("children"))
    files = pages.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("role", page.alias("p")))), lambda x: x["p"]).alias("children"))
    doc = F.struct(F.lit("doc").alias("name"), F.lit("1").alias("version"), F.struct(F.lit("0:0").alias("id"), F.lit("DOCUMENT").alias("type"), F.col("children")).alias("document"))
    return files.select(F.col("conv_id").cast("string").alias("file_key"), F.to_json(doc).alias("raw"))


#: the same documents in SQL: texts of leaves, frames, pages and roots, and all nodes
_DOCS = """c AS (SELECT conv_id::VARCHAR AS file_key, role, turn, text FROM conversations),
f AS (SELECT *, '{"id":"3:' || file_key || ':' || turn || '"' || CASE WHEN text IS NULL THEN '' ELSE ',"text":' || to_json(text) END || '}' AS leaf,
  row_number() OVER (PARTITION BY file_key, role ORDER BY turn) - 1 AS ord FROM c),
fr AS (SELECT *, '{"id":"2:' || file_key || ':' || turn || '","type":"FRAME","children":[' || leaf || ']}' AS frame FROM f),
p AS (SELECT file_key, role, count(*) AS kids, '{"id":"1:' || file_key || ':' || role || '","type":"CANVAS","children":[' || string_agg(frame, ',' ORDER BY turn) || ']}' AS page,
  row_number() OVER (PARTITION BY file_key ORDER BY role) - 1 AS ord FROM fr GROUP BY file_key, role),
r AS (SELECT file_key, count(*) AS kids, sum(kids)::BIGINT AS frames, '{"id":"0:0","type":"DOCUMENT","children":[' || string_agg(page, ',' ORDER BY role) || ']}' AS root FROM p GROUP BY file_key),
nodes AS (
  SELECT file_key, '0:0' AS id, NULL AS parent_id, 0 AS level, 0 AS ord, 'DOCUMENT' AS type, root AS text, 1::BIGINT * kids AS kids, kids + 2 * frames AS descendants FROM r
  UNION ALL SELECT file_key, '1:' || file_key || ':' || role, '0:0', 1, ord, 'CANVAS', page, kids, 2 * kids FROM p
  UNION ALL SELECT file_key, '2:' || file_key || ':' || turn, '1:' || file_key || ':' || role, 2, ord, 'FRAME', frame, 1, 1 FROM fr
  UNION ALL SELECT file_key, '3:' || file_key || ':' || turn, '2:' || file_key || ':' || turn, 3, 0, NULL, leaf, 0, 0 FROM fr),
whole AS (SELECT file_key, '{"name":"doc","version":"1","document":' || root || ',"components":{},"componentSets":{},"styles":{}}' AS full_text FROM r)"""


def conversation_nodes(spark, sf_dir) -> DataFrame:
    return flatten.flatten(conversation_files(spark, sf_dir))


def conversation_parts(spark, sf_dir) -> DataFrame:
    """Parts of these documents: a shallow one of each page, a whole one of each frame, and an
    older one of each frame, which the newer one, later by name, replaces."""
    nodes = conversation_nodes(spark, sf_dir)
    shallow = budget.shallow_parts(nodes, nodes.filter("level = 1").select("file_key", "id"))
    shallow = shallow.select("file_key", F.concat(F.lit("part-a-"), "id").alias("file"), "id", "document", F.lit("{}").alias("components"))
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("file_key"), F.concat_ws(":", F.lit("2"), "conv_id", "turn").alias("id"), "role", "turn", "text")
    leaf = lambda text: F.array(F.struct(F.regexp_replace("id", "^2", "3").alias("id"), text.alias("text")))
    frame = lambda text: F.to_json(F.struct("id", F.lit("FRAME").alias("type"), leaf(text).alias("children")))
    maps = F.to_json(F.map_from_arrays(F.array("role"), F.array("turn")))
    frames = [c.select("file_key", F.concat(F.lit(f"part-{k}-"), F.lpad(F.col("turn").cast("string"), 9, "0")).alias("file"), "id", frame(text).alias("document"), maps.alias("components")) for k, text in (("b", F.lit("old")), ("c", F.col("text")))]
    every = shallow.unionByName(frames[0]).unionByName(frames[1])
    entry = F.concat(F.lit('{"nodes":{'), F.to_json(F.struct("id")).substr(7, 1 << 20))
    payload = F.concat(F.expr("left(e, length(e) - 1)"), F.lit(':{"document":'), "document", F.lit(',"components":'), "components", F.lit("}}}"))
    return every.withColumn("e", entry).select("file_key", "file", payload.alias("payload"))


# --- sources, projections, filters -------------------------------------------------------


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def props_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


# --- joins -----------------------------------------------------------------------------------


@query("""WITH parts AS (SELECT o_custkey AS id, arg_max(o_orderkey, o_orderkey) AS latest FROM orders GROUP BY o_custkey)
SELECT c_custkey, coalesce(latest, -c_custkey) AS node, latest IS NOT NULL AS grafted FROM customer LEFT JOIN parts ON id = c_custkey""")
def graft_lookup(spark, sf_dir):
    """Skeleton left joined with the last-wins index; the index wins."""
    parts = graft.last_wins(table(spark, sf_dir, "orders").withColumn("v", F.col("o_orderkey")), ["o_custkey"], "v", ["o_orderkey"])
    c = table(spark, sf_dir, "customer")
    return c.join(parts, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", F.coalesce("v", -F.col("c_custkey")).alias("node"), F.col("v").isNotNull().alias("grafted"))


@query("SELECT c_custkey FROM customer ANTI JOIN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ON o_custkey = c_custkey")
def missing_ids(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey").join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left_anti")


@query("""WITH m AS (SELECT c_nationkey, c_custkey FROM customer ANTI JOIN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ON o_custkey = c_custkey)
SELECT c_nationkey::VARCHAR AS file_key, count(*) AS n_missing, list_transform(list_sort(list(c_custkey))[1:5], lambda k: '3:' || k) AS preview FROM m GROUP BY c_nationkey""")
def missing_preview(spark, sf_dir):
    """The first five missing ids of each file."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    front = c.select(F.col("c_nationkey").cast("string").alias("file_key"), F.concat(F.lit("3:"), "c_custkey").alias("id"), F.col("c_custkey").alias("pos"))
    index = o.filter("o_orderpriority = '1-URGENT'").join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").cast("string").alias("file_key"), F.concat(F.lit("3:"), "o_custkey").alias("id"))
    return graft.missing_preview(graft.missing_ids(front, index))


@query("""WITH p AS (SELECT l_orderkey, bool_or(l_returnflag <> 'R') AS there FROM lineitem GROUP BY l_orderkey, l_linenumber),
g AS (SELECT l_orderkey AS o_orderkey, bool_and(there) AS whole FROM p GROUP BY l_orderkey)
SELECT o_orderkey FROM orders ANTI JOIN (SELECT o_orderkey AS k FROM g WHERE whole) ON k = o_orderkey""")
def resume_anti(spark, sf_dir):
    """Groups (orders) that must be fetched again: some part (line item) is not there."""
    li = table(spark, sf_dir, "lineitem").select(F.lit("t").alias("file_key"), F.col("l_orderkey").cast("string").alias("sha"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("file"), "l_returnflag")
    groups = li.groupBy("file_key", "sha").agg(F.collect_list("file").alias("parts")).withColumn("rechunked", F.lit(False))
    wanted = table(spark, sf_dir, "orders").select(F.lit("t").alias("file_key"), F.col("o_orderkey").cast("string").alias("sha"))
    todo, _ = resume.split_by_resume(wanted, groups, li.filter("l_returnflag <> 'R'").select("file_key", "file"))
    return todo.select(F.col("sha").cast("long").alias("o_orderkey"))


@query("""WITH th(ord, tier, bound) AS (VALUES (0, 'sm', 3000), (1, 'md', 30000), (2, 'large', 150000), (3, 'xl', 1000000)),
v AS (SELECT c_custkey, (abs(c_acctbal) * 400)::BIGINT AS n FROM customer)
SELECT c_custkey, n, coalesce(arg_min(tier, ord), 'xxxxl') AS tier FROM v LEFT JOIN th ON n <= bound GROUP BY c_custkey, n""")
def tier_range_join(spark, sf_dir):
    v = table(spark, sf_dir, "customer").select("c_custkey", F.round(F.abs("c_acctbal") * 400).cast("long").alias("n"))
    return sizing.tier_by_join(v, "n", "nodes", "c_custkey")


@query("""WITH v AS (SELECT conv_id, count(*) AS n, sum(strlen(text))::BIGINT AS b FROM conversations GROUP BY conv_id),
t AS (SELECT conv_id, CASE WHEN n <= 2 THEN 'sm' WHEN b <= 8388608 THEN 'md' ELSE 'large' END AS tier FROM v)
SELECT conv_id, tier, CASE tier WHEN 'sm' THEN 'whole' ELSE 'frontier' END AS mode, 3 AS depth, CASE tier WHEN 'large' THEN 5 ELSE 10 END AS batch_size,
 CASE tier WHEN 'sm' THEN 1 WHEN 'md' THEN 4 ELSE 6 END AS concurrency, true AS rechunk, 1000::BIGINT AS max_part_bytes FROM t""")
def strategy_join(spark, sf_dir):
    """Tier joined with its preset; given depth and byte budget win."""
    v = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b"))
    t = v.select("conv_id", F.when(F.col("n") <= 2, "sm").when(F.col("b") <= 8388608, "md").otherwise("large").alias("tier"))
    return sizing.with_strategy(t, depth=3, max_part_bytes=1000).select("conv_id", "tier", "mode", "depth", "batch_size", "concurrency", "rechunk", F.col("max_part_bytes").cast("long").alias("max_part_bytes"))


@query("""WITH f AS (SELECT c_nationkey::VARCHAR AS file_key, c_custkey::VARCHAR AS id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos FROM customer)
SELECT file_key, id, pos, o_orderkey::VARCHAR AS document, o_orderkey IS NOT NULL AS there FROM f LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON o_custkey::VARCHAR = id""")
def batch_response_join(spark, sf_dir):
    """Requested ids joined with what came back, keeping the requested order."""
    return frontier.with_answers(*_asked(spark, sf_dir)).select("file_key", "id", "pos", "document", "there")


def _asked(spark, sf_dir):
    f = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("file_key"), F.col("c_custkey").cast("string").alias("id"), (F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) - 1).cast("long").alias("pos"))
    o = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderkey").cast("string").alias("document"))
    return f, o.join(f.select("file_key", "id"), "id")


@query("""SELECT c_nationkey::VARCHAR AS file_key, count(*) AS requested, count(o) AS returned FROM customer
LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders WHERE o_orderstatus = 'P') ON o = c_custkey GROUP BY c_nationkey""")
def returned_ratio(spark, sf_dir):
    return frontier.returned(*_asked(spark, sf_dir))


@query("""SELECT 'f' || n_nationkey AS "fileKey", 'idCount' AS "column" FROM nation WHERE n_nationkey % 4 = 0
UNION ALL SELECT 'f' || n_nationkey, 'size' FROM nation WHERE n_nationkey % 5 = 0""")
def output_comparison(spark, sf_dir):
    """Two runs' manifests compared key by key."""
    n = table(spark, sf_dir, "nation")
    fixed = [F.lit(v).alias(k) for k, v in (("frontierDepth", 2), ("batchSize", 10), ("concurrency", 4), ("batchCount", 1), ("rechunked", 0))]
    a = n.select(F.concat(F.lit("f"), "n_nationkey").alias("fileKey"), F.lit("md").alias("size"), F.col("n_nationkey").alias("idCount"), *fixed, F.array().cast("array<string>").alias("oversizedLeaves"))
    b = a.withColumn("size", F.when(F.col("idCount") % 5 == 0, "xl").otherwise(F.col("size")))
    b = b.withColumn("idCount", F.when(F.col("idCount") % 4 == 0, F.col("idCount") + 1).otherwise(F.col("idCount")))
    return manifest.differing(a, b)


# --- aggregates ------------------------------------------------------------------------------


@query(f"WITH {_TREE} SELECT level, count(*) AS n_nodes FROM n GROUP BY level")
def tree_count_by_level(spark, sf_dir):
    return tree(spark, sf_dir).groupBy("level").agg(F.count("*").alias("n_nodes"))


@query(f"WITH RECURSIVE {_TREE}, {_SIZES} SELECT id, bytes, descendants FROM sz")
def subtree_bytes(spark, sf_dir):
    """Size and number of descendants of every subtree, summed upwards level by level."""
    return measure.rolled_up(tree(spark, sf_dir), 4).select("id", F.col("bytes").cast("long").alias("bytes"), "descendants")


@query("""WITH v AS (SELECT conv_id, count(*) AS n_nodes, count(DISTINCT turn) AS frontier_width, sum(strlen(text))::BIGINT AS skeleton_bytes FROM conversations GROUP BY conv_id)
SELECT conv_id, n_nodes, frontier_width, skeleton_bytes, CASE WHEN frontier_width = 0 AND n_nodes <= 3000 THEN 'sm' ELSE
 ['sm', 'md', 'large', 'xl', 'xxxxl'][greatest(
  CASE WHEN n_nodes <= 3000 THEN 0 WHEN n_nodes <= 30000 THEN 1 WHEN n_nodes <= 150000 THEN 2 WHEN n_nodes <= 1000000 THEN 3 ELSE 4 END,
  CASE WHEN frontier_width <= 0 THEN 0 WHEN frontier_width <= 50 THEN 1 WHEN frontier_width <= 300 THEN 2 WHEN frontier_width <= 2000 THEN 3 ELSE 4 END,
  CASE WHEN skeleton_bytes <= 2097152 THEN 0 WHEN skeleton_bytes <= 8388608 THEN 1 WHEN skeleton_bytes <= 52428800 THEN 3 ELSE 4 END * 1) + 1] END AS tier FROM v""")
def classify_tier(spark, sf_dir):
    v = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n_nodes"), F.count_distinct("turn").alias("frontier_width"), F.sum(F.octet_length("text")).cast("long").alias("skeleton_bytes"))
    return v.withColumn("tier", sizing.classify())


@query("SELECT user_id, arg_max(value, struct_pack(t := ts, e := event_id)) AS value FROM events GROUP BY user_id")
def last_wins_merge(spark, sf_dir):
    return graft.last_wins(table(spark, sf_dir, "events"), ["user_id"], "value", ["ts", "event_id"])


@query("""WITH p AS (SELECT l_orderkey AS sha, 'part-' || l_partkey || '.json' AS file, bool_and(l_returnflag <> 'R') AS fresh FROM lineitem GROUP BY l_orderkey, l_partkey),
g AS (SELECT o_custkey AS file_key, count(*) AS "batchCount", count(*) FILTER (o_orderstatus = 'F') AS "resumedSkipped", sum(o_orderkey % 3)::BIGINT AS rechunked FROM orders GROUP BY o_custkey),
q AS (SELECT o_custkey AS file_key, count(*) FILTER (fresh) AS downloaded FROM (SELECT o_custkey, file, arg_min(fresh, sha) AS fresh FROM p JOIN orders ON o_orderkey = sha GROUP BY o_custkey, file) GROUP BY o_custkey)
SELECT file_key::VARCHAR AS file_key, "batchCount", "resumedSkipped", rechunked, coalesce(downloaded, 0) AS downloaded FROM g LEFT JOIN q USING (file_key)""")
def run_counters(spark, sf_dir):
    """Counters of a run: groups, reused groups, splits, files written."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("file_key"), F.col("o_orderkey").alias("sha"), (F.col("o_orderstatus") == "F").alias("resumed"), (F.col("o_orderkey") % 3).alias("rechunked"))
    once = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.bool_and(F.col("l_returnflag") != "R").alias("fresh"), F.min("l_linenumber").cast("long").alias("bytes"))
    parts = once.join(o.select("file_key", "sha"), F.col("l_orderkey") == F.col("sha")).select("file_key", F.concat(F.lit("part-"), "l_partkey", F.lit(".json")).alias("file"), F.array(F.col("l_partkey").cast("string")).alias("ids"), "sha", "bytes", F.lit(0.0).alias("elapsed_ms"), "fresh")
    return manifest.counters(o, parts).select("file_key", "batchCount", "resumedSkipped", "rechunked", "downloaded")


# --- windows, order, sets -----------------------------------------------------------------------


@query("""WITH f AS (SELECT c_nationkey::VARCHAR AS file_key, '3:' || c_custkey AS id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos FROM customer)
SELECT file_key, pos // 10 AS batch_no, list(id ORDER BY pos) AS ids, substring(sha256(string_agg(id, ',' ORDER BY id)), 1, 12) AS sha FROM f GROUP BY file_key, pos // 10""")
def frontier_batches(spark, sf_dir):
    f = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("file_key"), F.concat(F.lit("3:"), "c_custkey").alias("id"), (F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) - 1).cast("long").alias("pos"))
    return frontier.batches(f, 10)


@query("SELECT user_id, event_type, arg_min(event_id, struct_pack(t := ts, e := event_id)) AS event_id FROM events GROUP BY user_id, event_type")
def dedup_first(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return frontier.first_of_each(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT c_nationkey, ceil(count(*) / 7)::BIGINT AS batches FROM customer GROUP BY c_nationkey")
def batch_count(spark, sf_dir):
    n = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return n.select("c_nationkey", frontier.batch_count("n", 7).alias("batches"))


@query("""WITH s AS (SELECT page_id, unnest(string_split(url, '/')) AS s, generate_subscripts(string_split(url, '/'), 1) AS p FROM pages)
SELECT page_id, arg_max(s, length(s) * 1000 - p) AS longest FROM s GROUP BY page_id""")
def longest_segment(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", scalars.longest(F.split("url", "/")).alias("longest"))


@query("""SELECT 'part-' || n_nationkey || '.json' AS file, n_nationkey AS bytes, row_number() OVER (ORDER BY 'part-' || n_nationkey || '.json') AS place FROM nation
UNION ALL SELECT 'part-r' || r_regionkey || '.json', r_regionkey, -1 FROM region""")
def part_order_union(spark, sf_dir):
    """Parts listed by name, and a union of part sets."""
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("part-"), "n_nationkey", F.lit(".json")).alias("file"), F.col("n_nationkey").alias("bytes"))
    r = table(spark, sf_dir, "region").select(F.concat(F.lit("part-r"), "r_regionkey", F.lit(".json")).alias("file"), F.col("r_regionkey").alias("bytes"), F.lit(-1).cast("long").alias("place"))
    return frontier.numbered(n, ["file"]).unionByName(r)


# --- tree ---------------------------------------------------------------------------------------


def _split(budget_bytes: int, limit: int) -> str:
    return f"""WITH RECURSIVE {_TREE}, {_SIZES},
sp AS (SELECT n.id, n.id AS root, 2 AS level, z.bytes, z.bytes > {budget_bytes} AND 2 < {limit} AND z.descendants > 0 AS split, z.bytes > {budget_bytes} AND z.descendants = 0 AS oversized
  FROM n JOIN sz z ON n.id = z.id WHERE n.level = 2
  UNION ALL SELECT n.id, p.root, p.level + 1, z.bytes, z.bytes > {budget_bytes} AND p.level + 1 < {limit} AND z.descendants > 0, z.bytes > {budget_bytes} AND z.descendants = 0
  FROM sp p JOIN n ON n.parent_id = p.id JOIN sz z ON z.id = n.id WHERE p.split)
SELECT id, root, level, bytes, split, oversized, substring(sha256(id), 1, 12) AS sha FROM sp"""


def _plan(spark, sf_dir, budget_bytes, limit):
    sized = measure.rolled_up(tree(spark, sf_dir), 4).withColumn("children", F.col("descendants"))
    roots = sized.filter("level = 2").select("id")
    return budget.split_plan(sized, roots, budget_bytes, limit, keys=()).withColumn("bytes", F.col("bytes").cast("long"))


@query(_split(300, 4))
def rechunk_plan(spark, sf_dir):
    """Parts of every nation's subtree under a byte budget."""
    return _plan(spark, sf_dir, 300, 4)


@query(_split(9, 5))
def rechunk_plan_deep(spark, sf_dir):
    """A budget that some single orders exceed: oversized leaves."""
    return _plan(spark, sf_dir, 9, 5)


@query("""SELECT event_id, value * 1000 > 90000 OR event_id % 100 > 95 AS over_both, value * 1000 > 90000 AS over_bytes FROM events""")
def batch_budget(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", (F.col("value") * 1000).alias("b"), (F.col("event_id") % 100).alias("ms"))
    return e.select("event_id", budget.batch_over("b", "ms", 90000, 95).alias("over_both"), budget.batch_over("b", "ms", 90000, 0).alias("over_bytes"))


# --- scalars ------------------------------------------------------------------------------------


@query("SELECT doc_id, sha256(replace(replace(text || chr(8232) || 'x' || chr(8233), chr(8232), '\\u2028'), chr(8233), '\\u2029')) AS escaped FROM documents")
def escape_separators(spark, sf_dir):
    text = F.concat("text", F.lit(chr(0x2028) + "x" + chr(0x2029)))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(scalars.escape_separators(text), 256).alias("escaped"))


@query("SELECT n, least(500 * pow(2, n), 15000)::BIGINT AS wait_ms FROM (SELECT DISTINCT event_id % 12 AS n FROM events)")
def backoff_schedule(spark, sf_dir):
    n = table(spark, sf_dir, "events").select((F.col("event_id") % 12).alias("n")).distinct()
    return n.select("n", scalars.backoff_ms("n").alias("wait_ms"))


@query("""SELECT event_id, CASE WHEN try_cast(h AS DOUBLE) > 0 THEN try_cast(h AS DOUBLE) * 1000 ELSE least(500 * pow(2, event_id % 8), 15000) END AS wait_ms
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '2.5' WHEN 1 THEN '0' WHEN 2 THEN 'soon' END AS h FROM events)""")
def retry_after(spark, sf_dir):
    h = F.when(F.col("event_id") % 4 == 0, "2.5").when(F.col("event_id") % 4 == 1, "0").when(F.col("event_id") % 4 == 2, "soon")
    return table(spark, sf_dir, "events").select("event_id", h.alias("h")).select("event_id", scalars.retry_wait_ms("h", F.col("event_id") % 8).cast("double").alias("wait_ms"))


@query("""WITH s AS (SELECT event_id, 400 + event_id % 110 AS status FROM events),
k AS (SELECT *, CASE WHEN status IN (401, 403) THEN 'auth' WHEN status = 404 THEN 'not_found' WHEN status = 429 THEN 'rate_limit' WHEN status >= 500 THEN 'server' ELSE 'generic' END AS kind FROM s)
SELECT event_id, status, kind, CASE kind WHEN 'auth' THEN 3 WHEN 'not_found' THEN 4 WHEN 'rate_limit' THEN 5 WHEN 'server' THEN 6 ELSE 1 END AS exit_code, kind IN ('rate_limit', 'server') AS retryable FROM k""")
def status_taxonomy(spark, sf_dir):
    s = table(spark, sf_dir, "events").select("event_id", (400 + F.col("event_id") % 110).alias("status")).withColumn("kind", scalars.error_kind("status"))
    return s.select("event_id", "status", "kind", scalars.exit_code("kind").alias("exit_code"), scalars.retryable("kind").alias("retryable"))


@query("SELECT o_orderkey, CASE WHEN length(o_orderkey::VARCHAR) < 4 THEN lpad(o_orderkey::VARCHAR, 4, '0') ELSE o_orderkey::VARCHAR END AS padded FROM orders")
def pad_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.pad("o_orderkey").alias("padded"))


@query(r"""WITH u AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://docs.example.com/Design/AbCdEfGhIj' || page_id || '/x' WHEN 1 THEN 'out/abcdefghijklmnopqrst' || page_id || '/Short/zyxwvutsrqponmlkjihgfe' ELSE url END AS s FROM pages),
g AS (SELECT page_id, s, regexp_extract(s, '(?i)[^/]+/(?:file|design)/([0-9A-Za-z]{10,})', 1) AS named FROM u),
l AS (SELECT page_id, arg_max(x, length(x) * 1000 - p) AS seg FROM (SELECT page_id, unnest(regexp_split_to_array(s, '[\\/]')) AS x, generate_subscripts(regexp_split_to_array(s, '[\\/]'), 1) AS p FROM u) WHERE regexp_full_match(x, '[0-9A-Za-z]{20,}') GROUP BY page_id)
SELECT page_id, CASE WHEN named <> '' THEN named ELSE coalesce(seg, '') END AS file_key FROM g LEFT JOIN l USING (page_id)""")
def parse_key(spark, sf_dir):
    own = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://docs.example.com/Design/AbCdEfGhIj"), "page_id", F.lit("/x"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("out/abcdefghijklmnopqrst"), "page_id", F.lit("/Short/zyxwvutsrqponmlkjihgfe"))).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", scalars.file_key(own).alias("file_key"))


@query("SELECT event_id, lower(trim(v)) NOT IN ('false', '0', 'no', 'off', '') AS yes FROM (SELECT event_id, ['False', ' no ', 'on', '1', '0', '', 'off', 'x'][event_id % 8 + 1] AS v FROM events)")
def as_bool(spark, sf_dir):
    v = F.element_at(F.array(*map(F.lit, ["False", " no ", "on", "1", "0", "", "off", "x"])), (F.col("event_id") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", scalars.as_bool(v).alias("yes"))


@query("SELECT page_id, regexp_extract(url, '://([^/?#]+)', 1) AS host FROM pages")
def url_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"))


@query("SELECT page_id, left(html, 200) AS body, left(url, 20) AS cause FROM pages")
def text_truncation(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", scalars.body_preview("html").alias("body"), scalars.body_preview("url", 20).alias("cause"))


@query("SELECT page_id, replace(url, '://', '://***@') AS proxy FROM pages")
def redact_proxy(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", scalars.redacted(F.replace("url", F.lit("://"), F.lit("://user:secret@"))).alias("proxy"))


@query("SELECT event_id, (event_id % 30)::VARCHAR AS retry_after FROM events")
def header_lookup(spark, sf_dir):
    h = F.create_map(F.when(F.col("event_id") % 2 == 0, "Retry-After").otherwise("RETRY-after"), (F.col("event_id") % 30).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", h.alias("h")).select("event_id", scalars.header("h", "retry-after").alias("retry_after"))


@query("SELECT item_id, sha256('{\"t\":' || to_json(text) || '}') AS sha FROM benchmark")
def canonical_json(spark, sf_dir):
    """Canonical text of JSON values; bench texts hold no character that writers escape differently."""
    b = table(spark, sf_dir, "benchmark").select("item_id", F.to_json(F.struct(F.col("text").alias("t"))).alias("j"))
    return b.select("item_id", F.sha2(canon.canonical_json("j"), 256).alias("sha"))


@query("SELECT page_id, url_encode(url) AS encoded FROM pages")
def percent_encode(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", canon.percent_encoded("url").alias("encoded"))


# --- documents as trees --------------------------------------------------------------------------


@query(f"WITH {_DOCS} SELECT file_key, id, parent_id, level, ord::INT AS ord, type FROM nodes")
def flatten_nodes(spark, sf_dir):
    """JSON documents as node tables."""
    return conversation_nodes(spark, sf_dir).select("file_key", "id", "parent_id", "level", "ord", "type")


@query(f"WITH {_DOCS} SELECT file_key, sha256(root) AS sha FROM r")
def serialise_documents(spark, sf_dir):
    """Node tables as JSON text again, byte for byte."""
    return flatten.serialise(conversation_nodes(spark, sf_dir)).select("file_key", F.sha2("document", 256).alias("sha"))


@query(f"WITH {_DOCS} SELECT file_key, id, level, level < 2 AS has_children FROM nodes WHERE level <= 2")
def skeleton_truncate(spark, sf_dir):
    """Skeletons down to a level."""
    return measure.skeleton(conversation_nodes(spark, sf_dir), 2).select("file_key", "id", "level", F.col("children_at").isNotNull().alias("has_children"))


@query(f"WITH {_DOCS} SELECT file_key, id, parent_id, level FROM nodes WHERE id = '2:7:1'")
def find_node(spark, sf_dir):
    return measure.find_node(conversation_nodes(spark, sf_dir), "2:7:1").select("file_key", "id", "parent_id", "level")


@query(f"WITH {_DOCS} SELECT file_key, count(*) AS n_nodes FROM nodes GROUP BY file_key")
def count_nodes(spark, sf_dir):
    return measure.count_nodes(conversation_nodes(spark, sf_dir))


@query(f"""WITH {_DOCS} SELECT file_key, count(*) AS n_nodes, count(DISTINCT CASE WHEN level = 2 THEN id END) AS frontier_width,
 sum(strlen(CASE level WHEN 0 THEN '{{"id":"0:0","type":"DOCUMENT","children":[]}}' WHEN 1 THEN '{{"id":"' || id || '","type":"CANVAS","children":[]}}' ELSE '{{"id":"' || id || '","type":"FRAME"}}' END) + (ord > 0)::INT)::BIGINT AS skeleton_bytes
FROM nodes WHERE level <= 2 GROUP BY file_key""")
def frontier_width(spark, sf_dir):
    """The three sizes of skeletons that choose a tier."""
    return measure.signals(conversation_nodes(spark, sf_dir), 2)


@query(f"WITH {_DOCS} SELECT file_key, id, strlen(text) AS bytes, descendants, kids AS children FROM nodes")
def document_subtree_sizes(spark, sf_dir):
    return measure.subtree_sizes(conversation_nodes(spark, sf_dir)).select("file_key", "id", "bytes", "descendants", "children")


@query(f"WITH {_DOCS} SELECT file_key, id, row_number() OVER (PARTITION BY file_key ORDER BY role, turn) - 1 AS pos FROM (SELECT file_key, role, turn, '2:' || file_key || ':' || turn AS id FROM fr)")
def document_frontier(spark, sf_dir):
    return frontier.collect_frontier(conversation_nodes(spark, sf_dir), 2)


@query(f"WITH {_DOCS} SELECT file_key, list(id ORDER BY id) AS \"oversizedLeaves\" FROM nodes WHERE level = 3 AND strlen(text) > 300 GROUP BY file_key")
def oversized_leaves(spark, sf_dir):
    """Leaves over the budget that splitting comes down to."""
    sized = measure.subtree_sizes(conversation_nodes(spark, sf_dir))
    plan = budget.split_plan(sized, sized.filter("level = 1").select("file_key", "id"), 300)
    return budget.oversized_leaves(plan, ["level", "id"])


@query(f"""WITH {_DOCS} SELECT file_key, '1:' || file_key || ':' || role AS id,
 sha256('{{"id":"1:' || file_key || ':' || role || '","type":"CANVAS","children":[' || string_agg('{{"id":"2:' || file_key || ':' || turn || '","type":"FRAME"}}', ',' ORDER BY turn) || ']}}') AS sha FROM fr GROUP BY file_key, role""")
def shallow_parent(spark, sf_dir):
    """Parents with their children's own keys only."""
    nodes = conversation_nodes(spark, sf_dir)
    return budget.shallow_parts(nodes, nodes.filter("level = 1").select("file_key", "id")).select("file_key", "id", F.sha2("document", 256).alias("sha"))


@query(f"""WITH {_DOCS} SELECT file_key, id, sha256(CASE level WHEN 2 THEN text ELSE
 '{{"id":"' || id || '","type":"CANVAS","children":[' || (SELECT string_agg('{{"id":"2:' || x.file_key || ':' || turn || '","type":"FRAME"}}', ',' ORDER BY turn) FROM fr x WHERE '1:' || x.file_key || ':' || x.role = nodes.id) || ']}}' END) AS sha FROM nodes WHERE level IN (1, 2)""")
def index_parts(spark, sf_dir):
    """Nodes by id from all parts; the last part wins."""
    return graft.index_parts(graft.part_entries(conversation_parts(spark, sf_dir))).select("file_key", "id", F.sha2("document", 256).alias("sha"))


@query("SELECT conv_id::VARCHAR AS file_key, 'components' AS kind, role AS key, max(turn)::VARCHAR AS value FROM conversations GROUP BY conv_id, role")
def map_merge(spark, sf_dir):
    """Union of the parts' maps, the later entry of a key winning."""
    return graft.merge_assets(graft.part_entries(conversation_parts(spark, sf_dir)))


def _grafted(spark, sf_dir):
    skeleton = measure.skeleton(conversation_nodes(spark, sf_dir), 1)
    return graft.graft(skeleton, graft.index_parts(graft.part_entries(conversation_parts(spark, sf_dir))))


@query(f"WITH {_DOCS} SELECT file_key, id, parent_id, level, ord::INT AS ord, type FROM nodes")
def graft_documents(spark, sf_dir):
    """Skeletons of two levels with shallow pages put in, and frames into those."""
    return _grafted(spark, sf_dir)[0].select("file_key", "id", "parent_id", "level", "ord", "type")


@query(f"WITH {_DOCS} SELECT file_key, kids + frames AS grafted FROM r")
def graft_counts(spark, sf_dir):
    return _grafted(spark, sf_dir)[1]


@query(f"WITH {_DOCS} SELECT file_key, sha256(root) AS sha, kids + frames AS grafted, 0 AS n_missing FROM r")
def reconstruct_documents(spark, sf_dir):
    """Whole documents from skeletons and parts."""
    nodes = conversation_nodes(spark, sf_dir)
    skeletons = flatten.serialise(measure.skeleton(nodes, 1)).select("file_key", F.concat(F.lit('{"document":'), "document", F.lit("}")).alias("raw"))
    out = graft.reconstruct(skeletons, conversation_parts(spark, sf_dir), frontier.collect_frontier(nodes, 2))
    # the tree is what stands before the maps that the parts bring
    tree = F.regexp_extract("full", r'(?s)^\{"document":(.*),"components":\{[^{}]*\},"componentSets":\{\},"styles":\{\}\}$', 1)
    return out.select("file_key", F.sha2(tree, 256).alias("sha"), "grafted", F.size("missing").alias("n_missing"))


# --- stateful and whole runs ---------------------------------------------------------------------


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) / 1000000.0::DOUBLE AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
b AS (SELECT user_id, event_id, n, t, 3.0::DOUBLE AS tokens FROM e WHERE n = 1
  UNION ALL SELECT e.user_id, e.event_id, e.n, greatest(e.t, b.t), least(3.0::DOUBLE, b.tokens - (b.tokens >= 1)::INT + greatest(0.0::DOUBLE, e.t - b.t) * 0.00001::DOUBLE) FROM b JOIN e ON e.user_id = b.user_id AND e.n = b.n + 1)
SELECT user_id, event_id, tokens >= 1 AS admitted FROM b""")
def token_bucket(spark, sf_dir):
    """Events each user's bucket admits: an ordered fold."""
    return replay(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", 0.00001, 3)


@query(f"""WITH {_DOCS} SELECT file_key, frames AS "idCount", ceil(frames / 3)::BIGINT AS "batchCount", sha256(full_text) AS sha, 0 AS n_missing,
 (SELECT list_sort(list(id)) FROM nodes n WHERE n.file_key = r.file_key AND level = 3 AND strlen(text) > 300) AS oversized FROM r JOIN whole USING (file_key)""")
def run_documents(spark, sf_dir):
    """Whole runs over many documents under a budget that splits batches and frames: every
    joined result is the document that it started from."""
    out = job.run_documents(conversation_files(spark, sf_dir), "md", batch_size=3, max_part_bytes=300)
    m = F.from_json("manifest", "idCount long, batchCount long, oversizedLeaves array<string>")
    leaves = F.array_sort(m["oversizedLeaves"])
    return out.select("file_key", m["idCount"].alias("idCount"), m["batchCount"].alias("batchCount"), F.sha2("full", 256).alias("sha"), F.size("missing").alias("n_missing"), F.when(F.size(leaves) > 0, leaves).alias("oversized"))


@query(f"""WITH {_DOCS}, s AS (SELECT file_key, role, turn, strlen(frame) AS fb, strlen(leaf) AS lb FROM fr)
SELECT file_key, count(*) AS n_parts FROM (SELECT file_key, '1' FROM p UNION ALL SELECT file_key, '2' FROM fr JOIN p USING (file_key, role) WHERE strlen(page) > 200 UNION ALL SELECT file_key, '3' FROM s WHERE fb > 200) GROUP BY file_key""")
def stored_parts(spark, sf_dir):
    """Parts under a budget written to a folder and read back: a shallow one of every page, and
    frames with their leaves where they exceed it."""
    # stored, or each level of the plan would flatten the documents again
    sized = cut(measure.subtree_sizes(conversation_nodes(spark, sf_dir)).select("file_key", "id", "parent_id", "level", "bytes", "children"))
    roots = sized.filter("level = 1").select("file_key", "id")
    plan = budget.split_plan(sized, roots, 200)
    folder = new_folder(spark, "parts")
    workdir.write_parts(plan.select("file_key", "sha", "id", F.to_json(F.struct("id", "bytes")).alias("payload")), folder)
    return workdir.read_written_parts(spark, folder).groupBy("file_key").agg(F.count("*").alias("n_parts"))


QUERIES = {name: f for name, (f, _) in SPECS.items()}
ORACLE_SQL = {name: sql for name, (_, sql) in SPECS.items() if sql}
