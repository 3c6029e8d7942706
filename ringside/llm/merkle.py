"""Operator 12: Merkle manifest of a dataset, upper proofs by a butterfly exchange.

Every row is a leaf. Per group (source) the leaves form a tree: while there is more
than one node, every `fanout` consecutive ones, the last run maybe fewer, become the
hash of their digests. The groups' roots, in order of the groups, form the upper
tree. A digest is a lowercase hex SHA-256; digests are hashed as hex text.

1. Places: leaves are dealt by ranges of (group, id), written once, and numbered by a
   count per range, so no group and no range is ever in one place as a whole.
2. Blocks: `fanout ** height` consecutive leaves of a group, aligned to the tree, so
   a block is a whole subtree and its root needs no other block.
3. Butterfly: in round r the blocks whose numbers differ only in digit r (base
   `fanout`) swap the roots of the subtrees they stand for, and each hashes the
   parent for itself. Every ancestor is hashed by all blocks below it, every block
   learns its siblings on all levels, and nothing is handed down again. A last
   subtree with fewer blocks than its siblings has its blocks give to several.
   One exchange of a narrow row a block and round; the rounds are one linear plan.
4. Paths: a block's leaves get their siblings inside the block and the block's upper
   ones. Folding a leaf with its path gives the root.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringside.llm.common import table
from ringside.session import cut

FANOUT = 3
#: A block has FANOUT ** HEIGHT leaves: 2187.
HEIGHT = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# -- leaves -----------------------------------------------------------------

def leaf(fields: list[Column]) -> Column:
    """Hash of the fields: '-' for null, else the value's UTF-8 length in bytes, ':' and the value."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[one(c.cast("string")) for c in fields]).cast("binary"), 256)


def group_key(group: Column) -> Column:
    """A key without nulls in the order of the groups, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def placed(leaves: DataFrame) -> DataFrame:
    """leaves (g, id, leaf, ...) with place (from 0, by id and leaf) and total of their group, written once.

    Null ids come first. Rows equal in id and leaf are interchangeable; a hash of the row's place in the input spreads
    them over ranges, whatever their number.
    """
    order = ["g", "id", "leaf", "salt"]
    salted = leaves.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    ranged = cut(salted.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "leaves")
    sizes = ranged.groupBy("g", "range").agg(F.count(F.lit(1)).alias("c"))
    own = Window.partitionBy("g")
    before = own.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("g", "range", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"), F.sum("c").over(own).alias("total"))
    inside = F.row_number().over(Window.partitionBy("g", "range").orderBy("id", "leaf", "salt")) - 1
    return cut(ranged.withColumn("inside", inside).join(starts, ["g", "range"]).withColumn(
        "place", F.col("start") + F.col("inside")).drop("salt", "range", "inside", "start"), "placed")


# -- trees ------------------------------------------------------------------

def levels(digests: list[str], fanout: int, height: int | None) -> list[list[str]]:
    """All levels of a tree from its leaves up: so many levels above them, or (None) until one node remains."""
    out = [digests]
    while len(out) - 1 < height if height is not None else len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def _block_levels(rows: pd.DataFrame, fanout: int, height: int) -> list[list[str]]:
    return levels(rows["leaf"].tolist(), fanout, height if rows["total"].iat[0] > fanout ** height else None)


def block_roots(leaves: DataFrame, fanout: int, height: int) -> DataFrame:
    """(g, block, blocks, digest) of every block of placed leaves."""
    def of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        root = _block_levels(rows, fanout, height)[-1][0]
        return pd.DataFrame({"g": rows["g"].iloc[:1], "block": rows["place"].iloc[:1] // fanout ** height,
                             "blocks": -(-rows["total"].iloc[:1] // fanout ** height), "digest": [root]})

    block = F.floor(F.col("place") / fanout ** height)
    return leaves.select("g", "place", "total", "leaf").groupBy("g", block.alias("block")).applyInPandas(
        of, "g string, block bigint, blocks bigint, digest string")


def butterfly(state: DataFrame, fanout: int) -> DataFrame:
    """(g, block, digest, lefts, rights) from the blocks' roots: digest is the group's root now, lefts and rights the
    digests before and after the block's ancestor on every level, joined, from the bottom up."""
    state = state.withColumns({"lefts": F.array().cast(PATH), "rights": F.array().cast(PATH)})
    most = state.agg(F.max("blocks")).first()[0] or 1  # one number: it sets how many rounds there are
    span = 1
    while span < most:
        names = {"s": span, "f": fanout, "nodes": f"(blocks + {span - 1}) div {span}"}
        at = state.withColumns({"node": F.expr("block div {s}".format(**names)), "nodes": F.expr(names["nodes"])}).withColumns({
            "low": F.expr(f"block - node * {span}"), "own": F.expr(f"least({span}, blocks - node * {span})"),
            "first": F.expr(f"(node div {fanout}) * {fanout}")})
        size = f"least({span}, blocks - j * {span})"
        given = (f"transform(if(low < {size}, sequence(low, {size} - 1, own), cast(array() as array<bigint>)), l -> j * {span} + l)")
        to = F.expr(f"if(nodes > 1, flatten(transform(sequence(first, least(first + {fanout - 1}, nodes - 1)), j -> {given})), array(block))")
        sent = at.select("g", "blocks", "block", "digest", "lefts", "rights", F.expr(f"node % {fanout}").alias("slot"),
                         F.explode(to).alias("to"))
        mine = F.col("block") == F.col("to")
        met = sent.groupBy("g", "to").agg(
            F.max("blocks").alias("blocks"), *[F.max(F.when(F.col("slot") == k, F.col("digest"))).alias(f"d{k}") for k in range(fanout)],
            *[F.first(F.when(mine, F.col(c)), ignorenulls=True).alias(c) for c in ("lefts", "rights")])
        swaps, slot = F.expr(names["nodes"]) > 1, F.expr(f"(to div {span}) % {fanout}")
        every = [F.col(f"d{k}") for k in range(fanout)]
        sides = {"lefts": [F.when(slot > k, d) for k, d in enumerate(every)], "rights": [F.when(slot < k, d) for k, d in enumerate(every)]}
        state = met.select(
            "g", F.col("to").alias("block"), "blocks",
            F.when(swaps, F.sha2(F.concat_ws("", *every).cast("binary"), 256)).otherwise(F.coalesce(*every)).alias("digest"),
            *[F.when(swaps, F.concat(c, F.array(F.concat_ws("", *s)))).otherwise(F.col(c)).alias(c) for c, s in sides.items()])
        span *= fanout
    return state.select("g", "block", "digest", "lefts", "rights")


def _with_paths(leaves: DataFrame, above: DataFrame, fanout: int, height: int) -> DataFrame:
    """Placed leaves with lefts and rights up to where those of `above` (g, block, lefts, rights, ...) end, and its columns."""
    carried = [f for f in leaves.schema.fields if f.name not in ("place", "total")]
    added = [f for f in above.schema.fields if f.name not in ("g", "block", "lefts", "rights")]

    def of(rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place").reset_index(drop=True)
        tree, top = _block_levels(rows, fanout, height), upper.iloc[0]
        over = [list(top["lefts"]), list(top["rights"])]
        lefts, rights = [], []
        for i in range(len(rows)):
            left, right, at = [], [], i
            for nodes in tree[:-1]:
                first = at - at % fanout
                left.append("".join(nodes[first:at]))
                right.append("".join(nodes[at + 1:first + fanout]))
                at //= fanout
            lefts.append(left + over[0])
            rights.append(right + over[1])
        out = {f.name: rows[f.name] for f in carried} | {f.name: top[f.name] for f in added}
        return pd.DataFrame(out | {"lefts": lefts, "rights": rights})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*carried, *added])
    block = F.floor(F.col("place") / fanout ** height)
    return leaves.withColumn("block", block).groupBy("g", "block").cogroup(above.groupBy("g", "block")).applyInPandas(
        of, f"{schema}, lefts {PATH}, rights {PATH}")


def manifest(leaves: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """leaves (g, id, leaf, ...) with subroot, root, lefts and rights: the path of every leaf up to the root.

    An empty table gives an empty table. A lone leaf is its group's subroot, a lone subroot the root; their path is empty.
    """
    low = placed(leaves)
    state = cut(butterfly(block_roots(low, fanout, height), fanout), "blocks")
    roots = placed(state.filter("block = 0").select(F.lit("").alias("g"), F.col("g").alias("id"), F.col("digest").alias("leaf")))
    top = butterfly(block_roots(roots, fanout, height), fanout).withColumnRenamed("digest", "root")
    over = _with_paths(roots, top, fanout, height).select(F.col("id").alias("g"), "root", F.col("lefts").alias("ls"), F.col("rights").alias("rs"))
    above = state.join(over, "g").select("g", "block", F.col("digest").alias("subroot"), "root",
                                         F.concat("lefts", "ls").alias("lefts"), F.concat("rights", "rs").alias("rights"))
    return _with_paths(low, cut(above, "above"), fanout, height)


def fold(first: Column) -> Column:
    """The root that a leaf's digest gives with the path in lefts and rights."""
    steps = F.arrays_zip("lefts", "rights")
    return F.aggregate(steps, first, lambda d, s: F.sha2(F.concat(s["lefts"], d, s["rights"]).cast("binary"), 256))


def path_digest() -> Column:
    """Hash of all siblings of the path, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b))).cast("binary"), 256)


def document_leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group: str = "source",
                    text: str = "text") -> DataFrame:
    """(g, id, leaf, other) of every document; other is the leaf of the tampered document, null where it is left alone.

    A document is tampered with where the CRC-32 of its id in decimal is even: line feeds are deleted from its text. Null
    ids and null texts are left alone. Nulls in any field are leaves like others, an empty text is not a null one.
    """
    value = {c: F.col(f"`{c}`") for c in (*fields, id_col, group, text)}
    changed = [F.replace(value[c], F.lit("\n"), F.lit("")) if c == text else value[c] for c in fields]
    even = F.crc32(value[id_col].cast("string").cast("binary")) % 2 == 0
    return docs.select(group_key(value[group]).alias("g"), value[id_col].alias("id"),
                       leaf([value[c] for c in fields]).alias("leaf"), F.when(even, leaf(changed)).alias("other"))


def op12(spark, sf_dir):
    """Leaf, roots and proof of every document, and whether the tampered ones still verify."""
    found = manifest(document_leaves(table(spark, sf_dir, "documents")))
    out = found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", path_digest().alias("proof_sha256"),
                       fold(F.coalesce("other", "leaf")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {"op12_merkle_butterfly_manifest": op12}


def _field(name: str, value: str) -> str:
    return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field(c, text if c == "text" else c) for c in FIELDS) + ")"


def _crc_sql(value: str) -> str:
    step = "list_reduce(list_concat([xor(x, y)], range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))"
    return f"xor(list_reduce(list_concat([4294967295], list_transform(string_split({value}, ''), lambda c: ascii(c)::bigint)), lambda x, y: {step}), 4294967295)"


def _tree_sql(name: str, keys: str, leaves: str, same: str) -> str:
    """CTEs: all nodes of the trees over the leaves, and what stands left and right of each node."""
    return f"""
{name}_nodes as (
  {leaves}
  union all
  select {keys}, lvl + 1, idx // 3, sha256(string_agg(d, '' order by idx)), (n + 2) // 3
  from {name}_nodes where n > 1 group by {keys}, lvl, idx // 3, n),
{name}_sides as (
  select a.{keys}, a.lvl, a.idx, coalesce(string_agg(b.d, '' order by b.idx) filter (b.idx < a.idx), '') as l,
         coalesce(string_agg(b.d, '' order by b.idx) filter (b.idx > a.idx), '') as r
  from {name}_nodes a left join {name}_nodes b on {same} and a.lvl = b.lvl and a.idx // 3 = b.idx // 3 and a.idx <> b.idx
  where a.n > 1 group by a.{keys}, a.lvl, a.idx)"""


ORACLES = {"op12_merkle_butterfly_manifest": f"""
with recursive base as (
  select doc_id, source as s, {_leaf_sql("text")} as leaf,
         case when {_crc_sql("doc_id::varchar")} % 2 = 0 then {_leaf_sql("replace(text, chr(10), '')")} else {_leaf_sql("text")} end as other,
         row_number() over (partition by source order by doc_id) - 1 as idx, count(*) over (partition by source) as n
  from documents),
{_tree_sql("low", "s", "select s, 0 as lvl, idx, leaf as d, n from base", "a.s is not distinct from b.s")},
subroots as (
  select s, d as subroot, row_number() over (order by s nulls first) - 1 as idx, count(*) over () as n from low_nodes where n = 1),
{_tree_sql("top", "one", "select 1 as one, 0 as lvl, idx, subroot as d, n from subroots", "true")},
climb as (
  select doc_id, s, 0 as lvl, idx, other as d, '' as proof from base
  union all
  select c.doc_id, c.s, c.lvl + 1, c.idx // 3, sha256(l || d || r), proof || l || r
  from climb c join low_sides v on c.s is not distinct from v.s and c.lvl = v.lvl and c.idx = v.idx),
half as (select doc_id, s, arg_max(d, lvl) as d, arg_max(proof, lvl) as proof from climb group by doc_id, s),
rest as (
  select doc_id, subroot, 0 as lvl, t.idx, d, proof from half h join subroots t on h.s is not distinct from t.s
  union all
  select c.doc_id, subroot, c.lvl + 1, c.idx // 3, sha256(l || d || r), proof || l || r
  from rest c join top_sides v on c.lvl = v.lvl and c.idx = v.idx),
done as (select doc_id, any_value(subroot) as subroot, arg_max(d, lvl) as folded_root, arg_max(proof, lvl) as proof from rest group by doc_id)
select b.doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded_root, folded_root = root as verified
from base b join done on done.doc_id = b.doc_id cross join (select d as root from top_nodes where n = 1)
"""}
