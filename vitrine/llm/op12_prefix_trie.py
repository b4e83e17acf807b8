"""Conversation prefix trie with adaptive radix trees over fixed-width turn ids.

1. A turn's id is 20 bytes: half of the SHA-256 of its role and text, then the
   text's size, big-endian. A conversation's key is the ids of its turns in a
   row, so a prefix of turns is a prefix of bytes at a multiple of 20. Texts
   never leave the first stage.
2. Conversations of one key are combined before the exchange: (key, n, smallest
   id). Distinct keys are range-partitioned and sorted, so a prefix that very
   many conversations share is spread over as many tasks as its keys ask for.
3. Each task walks its sorted keys in blocks of bounded size and builds an
   adaptive radix tree of each block: nodes of 4, 16, 48 and 256 children that
   grow as needed, and one node for a whole path without a branch. A walk over
   the tree emits a row per turn-aligned depth, also those inside a compressed
   path; branches at other depths only pass their sums up.
4. A node whose keys lie in several blocks is emitted by each with a part of its
   sums. A block knows how many turns its first key shares with the key before
   it, and whether the key after it extends its last: so each node is counted
   as new, and each leaf as a leaf, exactly once, and all sums just add up. Keys
   next to a partition border meet in a table of one row per partition.
5. One grouping by node id adds the parts; a join with the parents names them.
6. Ids of equal conversations are sorted, combined into pieces of a few
   thousand, and the pieces of a node hashed in order, one at a time.

A node's id is half of the SHA-256 of its key prefix; 10^12 nodes share one with
a chance under 10^-14. A block, a conversation and a piece are held in memory,
nothing else.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import Input, written

#: Bytes of a turn id: a digest, then the size of the text.
DIGEST, SIZE = 16, 4
WIDTH = DIGEST + SIZE
#: A block ends at this many keys or bytes of keys, whichever comes first.
BLOCK_KEYS, BLOCK_BYTES = 20_000, 4 << 20
#: Conversation ids hashed at once.
PIECE_IDS = 4096
#: Conversations that share a beginning when rebuilt: those of five ids in a row.
BASE = 5


# ----------------------------------------------------------- radix tree


class Node:
    """A compressed path ``path``, what ends at its end, and the children by their first byte.

    The layout follows the number of children: sorted byte lists of up to 4 and
    16 children, an index of 256 bytes into up to 48 children, and 256 slots.
    """

    __slots__ = ("path", "n", "least", "kind", "index", "kids")

    def __init__(self, path: bytes):
        self.path, self.n, self.least = path, 0, None
        self.kind, self.index, self.kids = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.kind == 256:
            return self.kids[byte]
        if self.kind == 48:
            at = self.index[byte]
            return self.kids[at - 1] if at else None
        at = self.index.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> None:
        """Add or replace the child of ``byte``; a full layout grows into the next."""
        if self.kind == 256:
            self.kids[byte] = node
            return
        if self.kind == 48:
            if at := self.index[byte]:
                self.kids[at - 1] = node
                return
            if len(self.kids) == 48:
                slots: list[Node | None] = [None] * 256
                for b, at in enumerate(self.index):
                    if at:
                        slots[b] = self.kids[at - 1]
                self.kind, self.index, self.kids = 256, bytearray(), slots
                self.kids[byte] = node
                return
            self.kids.append(node)
            self.index[byte] = len(self.kids)
            return
        at = bisect_left(self.index, byte)
        if at < len(self.index) and self.index[at] == byte:
            self.kids[at] = node
            return
        if len(self.kids) < self.kind:
            self.index.insert(at, byte)
            self.kids.insert(at, node)
        elif self.kind == 4:
            self.kind = 16
            self.put(byte, node)
        else:
            places = bytearray(256)
            for i, b in enumerate(self.index):
                places[b] = i + 1
            self.kind, self.index = 48, places
            self.put(byte, node)

    def children(self) -> list[Node]:
        """In the order of their bytes."""
        if self.kind == 256:
            return [k for k in self.kids if k is not None]
        if self.kind == 48:
            return [self.kids[at - 1] for at in self.index if at]
        return self.kids


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is shared, a[:high] is not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def insert(root: Node, key: bytes, n: int, least: int) -> Node:
    """Add ``n`` conversations of ``key``, the smallest id ``least``; returns where it ends. The root's path is empty."""
    node, at = root, 0
    while at < len(key):
        nxt = node.child(key[at])
        if nxt is None:
            leaf = Node(key[at:])
            node.put(key[at], leaf)
            node = leaf
            break
        rest = key[at : at + len(nxt.path)]
        same = shared(nxt.path, rest)
        if same < len(nxt.path):  # the path forks, or the key ends inside it
            fork = Node(nxt.path[:same])
            nxt.path = nxt.path[same:]
            fork.put(nxt.path[0], nxt)
            node.put(key[at], fork)
            nxt = fork
        node, at = nxt, at + same
    node.n += n
    node.least = least if node.least is None else min(node.least, least)
    return node


#: Of an emitted row: node id, its parent's, depth, and the parts of its sums.
PART = "node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def turn_nodes(block: list[tuple[bytes, int, int]], before: int, extended: bool) -> Iterator[tuple]:
    """``PART`` rows of a block of sorted keys (key, n, smallest id), one per turn-aligned depth of its radix tree.

    ``before``: turns that the block's first key shares with the key before it
    (-1: there is none); so many depths of the first key are not new here.
    ``extended``: the key after the block's last one starts with it.
    """
    root = Node(b"")
    for entry in block:
        last = insert(root, *entry)
    deepest = -1  # the first node met at a depth lies on the first key, as far as that goes
    prefix, frames = bytearray(), []
    stack: list[tuple] = [(root, 0, hashlib.sha256(), None, None)]
    while stack:
        node, start, state, above, marks = stack.pop()
        if marks is None:  # on the way down: the turn-aligned depths inside this path
            del prefix[start:]
            prefix += node.path
            end, done, marks = len(prefix), start, []
            for depth in [0] if node is root else range(start // WIDTH + 1, end // WIDTH + 1):
                upto = depth * WIDTH
                state.update(prefix[done:upto])
                nid, done = state.copy().digest()[:DIGEST], upto
                new = depth > before or depth <= deepest
                deepest = max(deepest, depth)
                marks.append((nid, above, depth, int.from_bytes(prefix[upto - SIZE : upto]) if depth else 0, new))
                above = nid
            state.update(prefix[done:])
            kids = node.children()
            leaf = node.n > 0 and not kids and not (extended and node is last)
            frames.append([node.n, node.least, 0, int(leaf), 0])
            stack.append((node, start, None, None, marks))
            stack.extend((kid, end, state.copy(), above, None) for kid in reversed(kids))
        else:  # on the way up: the sums of all below
            n, least, children, leaves, saved = frames.pop()
            for nid, parent, depth, size, new in reversed(marks):
                saved += size * (n - new)
                yield nid, parent, depth, least, n, children, leaves, saved
                children = int(new)
            if frames:
                up = frames[-1]
                up[0] += n
                up[1] = least if up[1] is None else min(up[1], least)
                up[2:] = [up[2] + children, up[3] + leaves, up[4] + saved]


def blocks(rows: Iterable[tuple]) -> Iterator[tuple]:
    """``PART`` rows of sorted (part, key, n, least, before, extended), by trees of at most a block of keys.

    ``before`` and ``extended`` tell of the neighbours of the part's first and last key.
    """
    block, size, part, before, after = [], 0, None, -1, False
    for p, key, n, least, shares, goes_on in rows:
        if block and (p != part or len(block) >= BLOCK_KEYS or size >= BLOCK_BYTES):
            last = block[-1][0]
            yield from turn_nodes(block, before, after if p != part else key.startswith(last))
            before, block, size = shared(last, key) // WIDTH, [], 0
        if p != part:
            part, before, after = p, shares, goes_on
        block.append((key, n, least))
        size += len(key)
    if block:
        yield from turn_nodes(block, before, after)


def borders(rows: Iterable[tuple]) -> Iterator[tuple]:
    """(part, turns its first key shares with the key before it, whether the key after it extends its last key)."""
    waiting = None
    for part, first, last in rows:
        before = -1
        if waiting:
            before = shared(waiting[2], first) // WIDTH
            yield waiting[0], waiting[1], first.startswith(waiting[2])
        waiting = (part, before, last)
    if waiting:
        yield waiting[0], waiting[1], False


def streamed(df: DataFrame, call, schema: str, rows_out: int = 10_000) -> DataFrame:
    """``call`` from an iterator of row tuples of a partition to row tuples of ``schema``, in Arrow batches."""

    made = T.StructType.fromDDL(schema)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(made)

        def batch(rows):
            columns = list(zip(*rows)) or [()] * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        out = []
        for row in call(rows):
            out.append(row)
            if len(out) >= rows_out:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    return df.mapInArrow(run, made)


# ------------------------------------------------------------- the table


def turn_ids(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, seq): each conversation's turn ids (40 hex digits), by turn, then role, then id; null turn first."""
    src = Input(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    role, text = (F.coalesce(src[c].cast("string"), F.lit("")) for c in ("role", "text"))
    spelled = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)  # tells role and text apart
    digest = F.substring(F.sha2(spelled.cast("binary"), 256), 1, 2 * DIGEST)
    size = F.lpad(F.hex(F.octet_length(text).cast("long")), 2 * SIZE, "0")
    turn = F.struct(src["turn"].alias("turn"), role.alias("role"), F.concat(digest, size).alias("tid"))
    turns = src.df.where(src["conv"].isNotNull()).select(src["conv"].cast("long").alias("conv_id"), turn.alias("t"))
    turns = turns.withColumn("half", half(F.col("conv_id"))).repartition("half")
    seq = F.transform(F.sort_array(F.collect_list("t")), lambda t: t["tid"])
    return turns.groupBy("half", "conv_id").agg(seq.alias("seq"))


def half(conv_id: Column) -> Column:
    return conv_id - conv_id % BASE


def rebuilt(convs: DataFrame) -> DataFrame:
    """Each conversation with its first h turns taken from the first of its half-decade, h by its id (0 to 8).

    At most nine conversations share a half-decade, so its window is small.
    """
    from pyspark.sql import Window

    most = 8
    of_base = F.when(F.col("conv_id") == F.col("half"), F.slice("seq", 1, most))
    base = F.coalesce(F.max(of_base).over(Window.partitionBy("half")), F.array().cast("array<string>"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1)).cast("int")
    taken = convs.withColumn("h", h).withColumn("base", base)
    own = F.slice("seq", F.col("h") + 1, F.size("seq"))
    return taken.withColumn("seq", F.concat(F.slice("base", F.lit(1), F.col("h")), own))


def ends(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Pieces (node, first id, text) of sorted (node, conv_id): at most ``PIECE_IDS`` ids of one node, comma-joined."""
    node, ids = None, []
    for nid, conv in rows:
        if ids and (nid != node or len(ids) >= PIECE_IDS):
            yield node, ids[0], ",".join(map(str, ids))
            ids = []
        node = nid
        ids.append(conv)
    if ids:
        yield node, ids[0], ",".join(map(str, ids))


def hashed(rows: Iterable[tuple]) -> Iterator[tuple]:
    """(node, SHA-256) of sorted pieces (node, first id, text), joined by commas; one piece in memory at a time."""
    node, state = None, None
    for nid, _, text in rows:
        if nid != node:
            if state:
                yield node, state.hexdigest()
            node, state = nid, hashlib.sha256(text.encode())
        else:
            state.update(b"," + text.encode())
    if state:
        yield node, state.hexdigest()


def prefix_trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    rebuild: bool = False,
) -> DataFrame:
    """One row per distinct sequence of first turns: node, parent (ids), conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    A turn is its role and text; a null role or text is empty. Turns are ordered
    by turn (null first; ties by role, then by turn id, so repeated rows are
    further turns). Members of a node are the conversations that start with it;
    ``conv_id`` is the smallest. ``saved_tokens`` adds (n_convs - 1) times the
    bytes of the last text over the subtree; ``ends_sha256`` is over the ids of
    the members that end there. Rows without a conversation id belong to no
    conversation and take no part; extra columns are ignored. An empty table
    has no conversation and gives no node, not even a root.

    ``rebuild`` first gives conversations common beginnings (see ``rebuilt``).
    A conversation is one row of 20 bytes a turn inside the operator.
    """
    convs = turn_ids(conversations, conv_col, turn_col, role_col, text_col)
    convs = rebuilt(convs) if rebuild else convs
    convs = written(convs.select("conv_id", F.unhex(F.array_join("seq", "")).alias("key")), "op12-keys")
    distinct = convs.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    parts = distinct.repartitionByRange("key").sortWithinPartitions("key")
    parts = written(parts.withColumn("part", F.spark_partition_id()), "op12-parts")
    spans = parts.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    spans = spans.coalesce(1).sortWithinPartitions("part")  # a row per partition
    near = written(streamed(spans, borders, "part int, before int, extended boolean"), "op12-borders")
    dealt = parts.join(F.broadcast(near), "part").repartitionByRange("part").sortWithinPartitions("part", "key")
    emitted = streamed(dealt.select("part", "key", "n", "least", "before", "extended"), blocks, PART)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = written(emitted.groupBy("node", "parent", "depth").agg(F.min("conv_id").alias("conv_id"), *sums), "op12-nodes")
    ids = convs.select(F.unhex(F.substring(F.sha2("key", 256), 1, 2 * DIGEST)).alias("node"), "conv_id")
    ids = ids.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    texts = streamed(ids, ends, "node binary, first long, ids string", 64)
    texts = texts.repartition("node").sortWithinPartitions("node", "first")
    digests = streamed(texts, hashed, "node binary, ends_sha256 string")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(digests, "node", "left")
        .join(parents, "parent", "left")
        .select(
            "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie(conversations, rebuild=True).drop("node", "parent")


#: crc32 of a number's digits: eight shifts a bit, a byte at a time.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(1, len({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, _:
    CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)))"""

SQL = f"""
WITH o AS (
  SELECT conv_id AS c, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
h AS (SELECT c, s, {_CRC.format("c::VARCHAR")} % 9 AS h FROM o),
r AS (
  SELECT h.c, list_concat(coalesce(b.s[1:h.h], []), h.s[h.h + 1:]) AS s
  FROM h LEFT JOIN o AS b ON b.c = h.c - h.c % 5
),
p AS (SELECT c, len(s) AS n, s, unnest(range(0, len(s) + 1)) AS d FROM r),
node AS (
  SELECT s[1:d] AS k, d, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends
  FROM p GROUP BY 1, 2
),
kid AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
full_node AS (
  SELECT node.*, coalesce(kid.n_children, 0) AS n_children,
    (n_convs - 1) * coalesce(strlen(node.k[node.d].x), 0) AS own
  FROM node LEFT JOIN kid ON kid.k = node.k
),
up AS (SELECT k, n_children, own, unnest(range(0, d + 1)) AS a FROM full_node),
below AS (
  SELECT k[1:a] AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own) AS saved FROM up GROUP BY 1
)
SELECT f.conv_id, f.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, f.n_convs, f.n_children,
  below.n_leaves, below.saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_node f JOIN below ON below.k = f.k LEFT JOIN node AS parent ON f.d > 0 AND parent.k = f.k[1:f.d - 1]
"""
