"""Operator 13: MinHash near-duplicates by a signature-coordinate inverted join.

1. Signature: the distinct word shingles of a text, hashed to 64 bits, and their
   minima under different orders. Texts with equal sets of shingles are one node
   (known by a 64-bit hash of the set).
2. Inverted join with prefix and skip merging. A node is posted under its first
   POSTED coordinate-value pairs. Two nodes of the wanted similarity agree in at
   least `matches(POSTED)` of them but for a chance of MISS, so they share a pair
   among the POSTED - matches + 1 rarest of each: only this prefix is merged. Pairs
   that one node alone has need no list, and long lists (a passage or a line that
   many documents share) are skipped, because they come last in every order.
3. Families: nodes that lists connect. A family is a set of nodes among which all
   further work lies; it is not yet a result.
4. Meetings: in a family of up to PIECE members each pair that the sizes do not rule
   out has its collisions counted over all COORDINATES; pairs above the match
   threshold are confirmed on the full sets of shingles. What is joined already is
   not compared again, and a meeting returns a spanning forest.
5. A larger family is worked through list by list. The members of a long list first
   meet its centre (the member whose pairs are the most frequent), dealt over lanes.
   Then, in every list that still holds more than one component, the members outside
   its largest component meet all others, in blocks and pieces of bounded size; a
   pair with several lists in common meets in the one of the least coordinate. No
   list, family, member or pair is dropped.

A pair exactly at the similarity is missed with a chance of at most twice MISS, a more similar one with less.
"""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringside.llm.common import WORD, fresh, maybe_listed, table, whole_text
from ringside.llm.graph import components
from ringside.session import cut

SHINGLE = 5
#: Similarity of the contract, as a fraction (85 of 100); the general rule of the library is 4 of 5.
CONTRACT, GENERAL = (85, 100), (4, 5)
#: Coordinates that are posted, and those that are counted where two nodes meet.
POSTED, COORDINATES = 32, 128
MISS = 1e-6
SEED = 42
#: Members and shingles of a piece of a family; they bound a meeting's memory, not what is compared.
PIECE, PIECE_SHINGLES = 512, 2_000_000
#: Tasks over which the members of one list are dealt where they learn what becomes of it.
SALT = 16

_WORD_BYTES = re.compile(WORD.encode())
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_CHUNK, _BATCH = 2048, 256
_ORDERS = np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 63, (2, COORDINATES, 1), np.uint64) * np.uint64(2) + np.uint64(1)


@functools.lru_cache(None)
def matches(coordinates: int, part: int, whole: int, miss: float = MISS) -> int:
    """The most agreeing coordinates that a pair of similarity part / whole falls short of with a chance of at most miss."""
    s, below, k = part / whole, 0.0, 0
    while k < coordinates:
        below += math.comb(coordinates, k) * s ** k * (1 - s) ** (coordinates - k)
        if below > miss:
            break
        k += 1
    return max(1, k)


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles, A-Z lower-cased; fewer words: the whole sequence; no word: none."""
    words = _WORD_BYTES.findall(text.encode().translate(_LOWER))
    if not words:
        return np.zeros(0, np.uint64)
    seen: dict[bytes, int] = {}
    numbers = [seen.setdefault(w, len(seen)) for w in words]
    hashed = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in seen), np.uint64, len(seen))[numbers]
    width = min(shingle, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ hashed[i:i + n]
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(out ^ (out >> np.uint64(29)))


def signature(hashes: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The least value of the set under each order, 32 bits of it."""
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(hashes), _CHUNK):
        mixed = (hashes[None, i:i + _CHUNK] ^ _ORDERS[0, :coordinates]) * _ORDERS[1, :coordinates]
        np.minimum(least, (mixed >> np.uint64(32)).astype(np.uint32).min(1), out=least)
    return least


def _sketch(batches, shingle, mark):
    for batch in batches:
        for i in range(0, batch.num_rows, _BATCH):
            part = batch.slice(i, _BATCH)
            nodes, sizes, signs, marks = [], [], [], []
            for text in part.column(2).to_pylist():
                hashes = shingle_set(text, shingle)
                some = len(hashes) > 0
                sizes.append(len(hashes))
                nodes.append(int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64)) if some else None)
                signs.append(signature(hashes, POSTED).view(np.int32) if some else None)
                marks.append(mark(text) if mark and some else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(signs, pa.list_(pa.int32())), pa.array(marks, pa.int64())], ["doc_id", "k", "node", "n", "posted", "mark"])


def sketches(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text: str = "text", mark=None) -> DataFrame:
    """(doc_id, k, node, n, posted, mark) of every row, written once; k is a hash of the text, n the size of its set.

    posted are the coordinates under which the node is posted, mark what that function says of the text. Texts without a
    word have no node.
    """
    t = whole_text(text)
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(t).alias("k"), t.alias("text"))
    return cut(rows.mapInArrow(lambda b: _sketch(b, shingle, mark), "doc_id bigint, k bigint, node bigint, n bigint, "
                               "posted array<int>, mark bigint"), "signatures")


# -- inverted join ----------------------------------------------------------

def postings(nodes: DataFrame, similarity: tuple[int, int], miss: float = MISS) -> DataFrame:
    """(node, n, rank, mask, t): t are the tokens of a node's prefix, those that more than one node has.

    nodes: (node, n, posted). A token is a coordinate and its value, side by side in a long. The order of a node's tokens
    is by how many nodes have them, then by the token. rank is high for central nodes; mask has a bit for every coordinate
    of the prefix. One row a node: joins by node take place before the tokens are spread (``in_lists``).
    """
    prefix = POSTED - matches(POSTED, *similarity, miss) + 1
    value = F.col("value").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    each = nodes.select("node", "n", F.posexplode("posted").alias("at", "value")).select(
        "node", "n", F.shiftleft(F.col("at").cast("bigint"), 32).bitwiseOR(value).alias("token"))
    held = cut(each.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "tokens")
    # most tokens are one node's alone and need no exchange
    several = maybe_listed(each, F.col("token"), held, F.col("token"))
    known = several.join(held, "token").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("c", "token"))).alias("t"))
    left = F.lit(prefix - POSTED) + F.size("t")  # tokens of its own come first
    first = known.filter(left > 0).select(
        "node", "n", F.aggregate("t", F.lit(0).cast("bigint"), lambda a, x: a + x["c"]).alias("rank"),
        F.transform(F.slice("t", 1, F.greatest(left, F.lit(1))), lambda x: x["token"]).alias("t"))
    bit = lambda a, x: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(x, 32).cast("int")))
    return first.select("node", "n", "rank", F.aggregate("t", F.lit(0).cast("bigint"), bit).alias("mask"), "t")


def in_lists(posted: DataFrame) -> DataFrame:
    """(token, node, n, rank, mask): a row for every token of a posting."""
    return posted.select(F.explode("t").alias("token"), "node", "n", "rank", "mask")


def families(posted: DataFrame) -> DataFrame:
    """(node, family) of all nodes that share a list: the components of the lists, each named by its smallest node."""
    lists = in_lists(posted)
    least = lists.groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z")
    edges = _salted(lists, least.select("token", "a")).select("a", F.col("node").alias("b"))
    return components(edges).toDF("node", "family")


# -- meetings ---------------------------------------------------------------

class _Meeting:
    """Members of one meeting: what is joined among them, and links confirmed on full sets."""

    def __init__(self, rows: pa.Table, similarity, least, coordinate):
        self.node = rows.column("node").to_numpy()
        self.size = rows.column("n").to_numpy()
        self.sign = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
        self.ends = np.cumsum(self.size)
        vocabulary, self.flat = np.unique(np.frombuffer(b"".join(rows.column("hashes").to_pylist()), np.uint64), return_inverse=True)
        self.mark = np.zeros(len(vocabulary), bool)
        self.root = np.unique(rows.column("label").to_numpy(), return_index=True, return_inverse=True)
        self.root = self.root[1][self.root[2]]
        self.first = np.arange(len(self.root))
        self.coordinate, self.similarity, self.least = coordinate, similarity, least
        if coordinate is not None:
            masks = rows.column("mask").to_numpy()
            self.prefix = (masks[:, None] >> np.arange(coordinate)) & 1 == 1

    def words(self, i):
        return self.flat[self.ends[i] - self.size[i]:self.ends[i]]

    def join(self, i: int, others: np.ndarray) -> None:
        """Link member i to those of the others that are similar to it and not joined to it yet."""
        part, whole = self.similarity
        small, large = np.minimum(self.size[others], self.size[i]), np.maximum(self.size[others], self.size[i])
        others = others[(self.root[others] != self.root[i]) & (whole * small >= part * large)]
        if not len(others):
            return
        same = self.sign[others] == self.sign[i]
        held = same.sum(1) >= self.least
        if self.coordinate:  # another list, of a lesser coordinate, has the pair too
            held &= ~(same[:, :self.coordinate] & self.prefix[others] & self.prefix[i]).any(1)
        others = others[held]
        if not len(others):
            return
        mine = self.words(i)
        self.mark[mine] = True
        sizes = self.size[others]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        both = np.add.reduceat(self.mark[np.concatenate([self.words(j) for j in others])].astype(np.int64), starts)
        self.mark[mine] = False
        for r in np.unique(self.root[others[whole * both >= part * (sizes + len(mine) - both)]]):
            low, high = sorted((r, self.root[i]))
            self.root[self.root == high] = low

    def forest(self) -> pa.RecordBatch:
        apart = self.root != self.first
        a, b = self.node[self.root[apart]], self.node[apart]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _groups(batches, keys):
    """Runs of rows with equal keys, from batches that are sorted by them."""
    first, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows - 1, bool)
        for v in values:
            changed |= v[1:] != v[:-1]
        bounds = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for s, e in zip(bounds, bounds[1:]):
            key = tuple(v[s] for v in values)
            if held and key != first:
                yield pa.Table.from_batches(held)
                held = []
            first = key
            held.append(batch.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


def _met(rows: DataFrame, keys: list[str], similarity, miss: float, by_list: bool = False) -> DataFrame:
    """Forests (a, b) of the meetings named by the keys.

    rows: keys, node, label, n, mask, signature, hashes, asks, answers: members that ask meet every member that answers.
    Members of one label are joined already. by_list: the first key is a token, and a pair with lists of lesser
    coordinates in common is left to these.
    """
    least = matches(COORDINATES, *similarity, miss)

    def of(batches):
        for group in _groups(batches, keys):
            meeting = _Meeting(group, similarity, least, group.column(keys[0])[0].as_py() >> 32 if by_list else None)
            asks, answers = (group.column(c).to_numpy().astype(bool) for c in ("asks", "answers"))
            index = np.arange(len(asks))
            for i in np.flatnonzero(asks):
                # two members that both ask and both answer meet once
                meeting.join(i, np.flatnonzero(answers & ((index < i) | ~(asks & answers[i]))))
            yield meeting.forest()

    columns = [*keys, "node", "label", "n", "mask", "signature", "hashes", "asks", "answers"]
    dealt = rows.select(*columns).repartition(*keys).sortWithinPartitions(*keys, "node")
    return dealt.mapInArrow(of, "a bigint, b bigint")


def _dealt(row: str, pieces, salt: int):
    return F.pmod(F.xxhash64(row, F.lit(salt)), pieces).cast("int")


def _each(pieces):
    return F.explode(F.sequence(F.lit(0), pieces - 1))


def _salted(lists: DataFrame, plan: DataFrame) -> DataFrame:
    """lists joined to the plan of their token, a long list's members over SALT tasks."""
    salts = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return lists.withColumn("salt", _dealt("node", F.lit(SALT), 5)).join(salts, ["token", "salt"]).drop("salt")


def _long_lists(lists: DataFrame, members: DataFrame, similarity, miss: float, piece: int) -> DataFrame:
    """Edges (a, b) among the members of the lists (token, node, rank, mask, n), all pairs of a list considered."""
    yes, no = F.lit(True), F.lit(False)
    held = members.select("node", "signature", "hashes")
    whole = F.greatest(F.lit(1), F.ceil(F.greatest(F.col("c") / piece, F.col("s") / PIECE_SHINGLES))).cast("int")
    # members of long lists meet the centres
    sizes = lists.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"),
                                       F.max_by("node", F.struct("rank", "node")).alias("centre"))
    sizes = cut(sizes.withColumn("pieces", whole), "lists")
    around = _salted(lists, sizes.filter("pieces > 1").select("token", "centre")).select("centre", "node", "n").distinct()
    around = cut(around, "around")
    lanes = around.groupBy("centre").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).select("centre", whole.alias("lanes"))
    lane = _dealt("node", F.col("lanes"), 7).alias("lane")
    apart = _salted(around.withColumnRenamed("centre", "token"), lanes.withColumnRenamed("centre", "token"))
    apart = apart.filter("node <> token").select(F.col("token").alias("centre"), "node", "n", lane, no.alias("asks"))
    own = around.filter("node = centre").join(lanes, "centre").select(
        "centre", "node", "n", _each(F.col("lanes")).alias("lane"), yes.alias("asks"))
    rows = apart.union(own).join(held, "node").withColumns(
        {"label": F.col("node"), "mask": F.lit(0).cast("bigint"), "answers": ~F.col("asks")})
    stars = cut(_met(rows, ["centre", "lane"], similarity, miss), "stars")
    # then those outside the largest component of a list meet all others in it
    labelled = lists.join(components(stars).toDF("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = cut(labelled, "labelled")
    most = labelled.groupBy("token", "label").agg(F.count(F.lit(1)).alias("l")).groupBy("token").agg(
        F.max_by("label", F.struct("l", "label")).alias("largest"), F.sum("l").alias("c"), F.max("l").alias("most")).filter("most < c")
    most = most.select("token", "largest", F.ceil((F.col("c") - F.col("most")) / piece).cast("int").alias("blocks"))
    still = _salted(labelled, cut(most.join(sizes.select("token", "pieces"), "token"), "open-lists"))
    block, part = _dealt("node", F.col("blocks"), 11), _dealt("node", F.col("pieces"), 13)
    asking = F.col("label") != F.col("largest")
    ask = still.filter(asking).withColumn("block", block).withColumn("piece", _each(F.col("pieces"))).withColumns(
        {"asks": yes, "answers": F.col("piece") == part})
    answer = still.withColumn("block", _each(F.col("blocks"))).filter(~asking | (F.col("block") != block)).withColumns(
        {"piece": part, "asks": no, "answers": yes})
    rows = ask.unionByName(answer).join(held, "node")
    return stars.union(_met(rows, ["token", "block", "piece"], similarity, miss, by_list=True))


def links(posted: DataFrame, members: DataFrame, similarity: tuple[int, int], miss: float = MISS, piece: int = PIECE) -> DataFrame:
    """Edges (a, b), all confirmed on full sets: their components are those of all links between nodes that share a list.

    posted: the postings; members: (family, node, n, signature, hashes). Both are read several times.
    """
    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    large = cut(sizes.filter((F.col("c") > piece) | (F.col("s") > PIECE_SHINGLES)).select("family"), "families")
    yes = F.lit(True)
    small = members.join(large, "family", "left_anti").withColumns(
        {"label": F.col("node"), "mask": F.lit(0).cast("bigint"), "asks": yes, "answers": yes})
    edges = _met(small, ["family"], similarity, miss)
    if large.isEmpty():
        return edges
    inside = members.join(large, "family", "left_semi")
    lists = cut(in_lists(posted.join(inside.select("node"), "node")), "long-lists")
    return edges.union(_long_lists(lists, inside, similarity, miss, piece))


# -- operator ---------------------------------------------------------------

def _hashes(batches, shingle):
    for batch in batches:
        for i in range(0, batch.num_rows, _BATCH):
            part = batch.slice(i, _BATCH)
            sets = [shingle_set(t, shingle) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in ("family", "node", "n")], pa.array([signature(x).tobytes() for x in sets], pa.binary()),
                 pa.array([x.tobytes() for x in sets], pa.binary())], ["family", "node", "n", "signature", "hashes"])


def _rows_of(docs: DataFrame, heads: DataFrame, how: str, id_col: str, text: str) -> DataFrame:
    """docs joined to (head_id, head_k) of heads; returns docs with fresh helper names dropped by the caller."""
    k, head_id, head_k = fresh(docs, "_k", "_head_id", "_head_k")
    marked = docs.withColumn(k, F.xxhash64(whole_text(text)))
    named = heads.withColumnsRenamed({"head_id": head_id, "head_k": head_k})
    same = F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(head_id)) & (F.col(k) == F.col(head_k))
    return marked.join(named, same, how)


def classes(docs: DataFrame, rows: DataFrame, similarity: tuple[int, int] = GENERAL, shingle: int = SHINGLE,
            id_col: str = "doc_id", text: str = "text", miss: float = MISS, piece: int = PIECE, lists=None) -> DataFrame:
    """(node, head) of every node of the sketches: head is (null_id, doc_id, k) of its component's first row, null ids last.

    lists: a function from (node, n, mark) to further lists (token, node, n) of nodes that may be similar; their tokens
    have the coordinate POSTED.
    """
    order = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "k")
    nodes = cut(rows.filter("node is not null").groupBy("node").agg(
        F.min(order).alias("head"), *[F.first(c).alias(c) for c in ("n", "posted", "mark")]), "nodes")
    posted = cut(postings(nodes.select("node", "n", "posted"), similarity, miss), "postings")
    if lists is not None:
        more = lists(nodes.select("node", "n", "mark")).withColumn("t", F.array("token")).drop("token")
        more = more.join(posted.select("node", "rank", "mask"), "node", "left")
        posted = cut(posted.unionByName(more.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("rank", "mask")})), "postings")
    found = cut(families(posted), "node-families")
    wanted = nodes.join(found, "node").select("node", "family", "n", F.col("head.doc_id").alias("head_id"), F.col("head.k").alias("head_k"))
    wanted = cut(wanted, "wanted")
    plain = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    plain = maybe_listed(plain, F.xxhash64("doc_id", F.xxhash64("text")), wanted, F.xxhash64("head_id", "head_k"))
    once = _rows_of(plain, wanted, "inner", "doc_id", "text").groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("family", "n", "text")])
    members = cut(once.select("family", "node", "n", "text").mapInArrow(
        lambda b: _hashes(b, shingle), "family bigint, node bigint, n bigint, signature binary, hashes binary"), "members")
    roots = components(links(posted, members, similarity, miss, piece))
    labelled = nodes.select("node", "head").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = labelled.groupBy("root").agg(F.min("head").alias("head"))
    return labelled.drop("head").join(heads, "root").select("node", "head")


def near_classes(docs: DataFrame, similarity: tuple[int, int] = GENERAL, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text: str = "text", **how) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs.

    Documents are linked when their sets of distinct word shingles share at least `similarity` (a fraction) of their
    union; a text of fewer words is one shingle. component_id is the smallest doc_id that links reach, null where all
    ids of a component are null; kept says that it is the row's own. A null text is empty; texts without a word are
    linked with nothing, so their component is themselves. Repeated rows come back as often as they came, with equal
    results. Other columns play no part. An empty table gives an empty table.
    """
    rows = sketches(docs, shingle, id_col, text)
    found = classes(docs, rows, similarity, shingle, id_col, text, **how).select("node", F.col("head.doc_id").alias("head_id"))
    out = rows.select("doc_id", "n", "node").join(found, "node", "left").withColumn(
        "component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("head_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, similarity: tuple[int, int] = GENERAL, shingle: int = SHINGLE, mark=None, **how) -> DataFrame:
    """One row of each component of similar texts, with all its columns: the smallest doc_id's, null ids last, of equal ids
    the smallest text hash's.

    Texts without a word count as alike here. Of rows with equal id and text one stays. An empty table gives an empty
    table.
    """
    rows = sketches(docs, shingle, mark=mark)
    order = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "k")
    wordless = rows.filter("node is null").agg(F.min(order).alias("head"))
    found = classes(docs, rows, similarity, shingle, **how).select("head").distinct().union(wordless.filter("head is not null"))
    heads = found.select(F.col("head.doc_id").alias("head_id"), F.col("head.k").alias("head_k"))
    marked = _rows_of(docs, heads, "left_semi", "doc_id", "text")
    k = marked.columns[-1]
    return marked.dropDuplicates(["doc_id", k]).drop(k)


def op13(spark, sf_dir):
    """Near-duplicate components of all documents: five-word shingles, 85 of 100 of the union shared."""
    return near_classes(table(spark, sf_dir, "documents"), CONTRACT)


QUERIES = {"op13_minhash_signature_join": op13}

#: The same classes by comparing all pairs that share a shingle.
ORACLES = {"op13_minhash_signature_join": r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^ 	-
]+') as w from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as shared from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
  group by all),
edges as (
  select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * shared >= 85 * (p.n + q.n - shared)),
reach as (
  select doc_id as x, doc_id as y from documents union select r.x, e.y from reach r join edges e on e.x = r.y),
least as (select x, min(y) as component_id from reach group by x)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join least on least.x = d.doc_id left join sizes on sizes.doc_id = d.doc_id
"""}
