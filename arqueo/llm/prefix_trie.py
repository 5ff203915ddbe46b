"""Trie of conversation prefixes by distributed MSD radix partitioning.

Turns become dictionary ids, conversations sequences of ids; equal sequences are one row. The
sequences are dealt into buckets by their first turn. A bucket with more turns than a task should
sort is dealt on: its common prefix (that of its least and greatest sequence) is skipped at once, and
the turn behind it parts the new buckets, until all are small. A round of Spark jobs serves all
large buckets together. Each small bucket is finished by one multikey quicksort, whose recursion
meets exactly the nodes of its subtree. The prefixes that rounds have skipped become nodes from the
totals of the buckets below them, from the last round up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arqueo.llm.common import Tables, materialize

#: A bucket of more turns than this is dealt on, so that no task sorts much more than another.
BUCKET_TURNS = 4096
#: Conversation ids are listed in spans of so many before they are hashed.
SPAN = 4096

NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def encoded_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), digest and chars of each turn in order; texts go no further.

    Turns are ordered by turn (null first), those of one number by role and text; null roles and
    texts are empty. Rows without conv_id are no conversation's.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("place"), F.unhex(F.sha2(whole, 256)).alias("digest"), F.length("text").cast("bigint").alias("chars"))


def dictionary(turns: DataFrame) -> DataFrame:
    """digest, id of each distinct turn. The ids are only stable once the table is written."""
    return turns.select("digest").distinct().withColumn("id", F.monotonically_increasing_id())


def rebuilt(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % group.

    h is crc32 of the decimal id, modulo ``most``; the remainder has the sign of c. All rows of
    ``turns`` keep their columns; a row with null place stands for each conversation, as it may
    have no turn left.
    """

    def shared(conv: Column) -> Column:
        return F.crc32(conv.cast("string").cast("binary")) % most

    own = turns.where(F.col("place") >= shared(F.col("conv_id")))
    convs = turns.select(F.col("conv_id").alias("c")).distinct()
    heads = turns.where((F.col("place") < most - 1) & (F.col("conv_id") % group == 0))
    borrowed = heads.join(convs, F.col("conv_id") == F.col("c") - F.col("c") % group).where(F.col("place") < shared(F.col("c")))
    marks = convs.select(F.col("c").alias("conv_id"))
    kept = [c for c in turns.columns if c != "conv_id"]
    return own.unionByName(borrowed.select(F.col("c").alias("conv_id"), *kept)).unionByName(marks, allowMissingColumns=True)


def sequences(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """conv_id, key and turns (id and chars of each) of every conversation; equal sequences have equal keys."""
    coded = turns.join(ids, "digest", "left")
    step = F.when(F.col("place").isNotNull(), F.struct("place", "id", "chars"))
    listed = coded.groupBy("conv_id").agg(F.array_sort(F.collect_list(step)).alias("s"))
    taken = listed.select("conv_id", F.transform("s", lambda x: F.struct(x["id"].alias("id"), x["chars"].alias("chars"))).alias("turns"))
    key = F.sha2(F.array_join(F.transform("turns", lambda x: x["id"].cast("string")), ","), 256)
    return taken.select("conv_id", F.unhex(key).alias("key"), "turns")


def _members(convs: DataFrame) -> DataFrame:
    """first (the least conv_id), n and ends_sha256 of each key.

    Ids are listed by span before the exchange by key, so a key of very many conversations is
    hashed from few rows, one after another.
    """
    span = F.floor(F.col("conv_id") / SPAN)
    listed = convs.groupBy("key", span.alias("span")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    spans = listed.select("key", "span", F.array_min("ids").alias("first"), F.size("ids").cast("bigint").alias("n"), F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([state.hexdigest()])], ["first", "n", "ends_sha256"])

        key = None
        for batch in batches:
            for k, least, size, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "first", "n", "ids")), strict=True):
                if k == key:
                    state.update(b",")
                    n += size
                else:
                    if key is not None:
                        yield row()
                    key, first, n, state = k, least, size, hashlib.sha256()
                state.update(ids.encode())
        if key is not None:
            yield row()

    return spans.repartition("key").sortWithinPartitions("key", "span").mapInArrow(hashed, "first bigint, n bigint, ends_sha256 string")


def _common(a: str, b: str) -> Column:
    """How many turns two sequences begin with alike."""
    apart = F.array_position(F.zip_with(f"{a}.id", f"{b}.id", lambda x, y: x.eqNullSafe(y)), False)
    return F.when(apart > 0, apart - 1).otherwise(F.size(a)).cast("int")


def _radix(tables: Tables, unique: DataFrame, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """The sequences in their buckets, and for each round the chain of nodes of each large bucket.

    Buckets: round, up (the least conversation of the node above), depth (of that node), first, n,
    ends_sha256 and turns from there. A round's large buckets are disjoint, so ``up`` tells them
    apart. Chains: up, depth, conv_id, n, steps (the skipped turns), ends_sha256, n_children.
    """
    root = unique.agg(F.min("first").alias("up"), F.sum("n").alias("n"), F.min(F.when(F.size("turns") == 0, F.col("ends_sha256"))).alias("ends_sha256"))
    root = tables.write(root.where("up is not null"))
    now = unique.where(F.size("turns") > 0).join(F.broadcast(root.select("up")))
    now = tables.write(now.withColumn("depth", F.lit(0).cast("bigint")))
    chains = [(root.select(F.lit(None).cast("bigint").alias("up"), F.lit(0).cast("bigint").alias("depth"), F.col("up").alias("conv_id"), "n", F.array().cast("array<bigint>").alias("steps"), "ends_sha256"), now)]
    done = []
    while True:
        head = F.col("turns")[0]["id"].alias("head")
        stats = now.groupBy("up", head).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.size("turns")).alias("size"), F.sum("n").alias("total"),
            F.min("first").alias("conv_id"), F.min("turns").alias("lo"), F.max("turns").alias("hi"), F.min("depth").alias("at"),
        )
        large = stats.where((F.col("size") > limit) & (F.col("rows") > 1)).withColumn("skip", _common("lo", "hi"))
        large = tables.write(large.select("up", "head", "conv_id", "total", "at", "skip", F.slice(F.col("lo.chars"), F.lit(1), F.col("skip")).alias("steps")))
        number = len(done)
        if large.isEmpty():
            done.append(now.withColumn("round", F.lit(number)))
            break
        found = now.withColumn("head", head).join(large.select("up", "head", F.col("conv_id").alias("node"), "skip"), ["up", "head"], "left")
        found = tables.write(found)
        done.append(found.where("node is null").drop("head", "node", "skip").withColumn("round", F.lit(number)))
        inside = found.where("node is not null")
        ended = inside.where(F.size("turns") == F.col("skip")).select(F.col("node").alias("conv_id"), "ends_sha256")
        rest = inside.where(F.size("turns") > F.col("skip"))
        now = tables.write(rest.select(
            "first", "n", "ends_sha256", F.slice("turns", F.col("skip") + 1, F.size("turns")).alias("turns"),
            F.col("node").alias("up"), (F.col("depth") + F.col("skip")).alias("depth"),
        ))
        chain = large.join(ended, "conv_id", "left").select("up", F.col("at").alias("depth"), "conv_id", F.col("total").alias("n"), "steps", "ends_sha256")
        chains.append((chain, now))
    buckets = done[0]
    for x in done[1:]:
        buckets = buckets.unionByName(x)
    out = []
    for chain, below in chains:
        heads = below.groupBy(F.col("up").alias("conv_id")).agg(F.count_distinct(F.col("turns")[0]["id"]).alias("n_children"))
        out.append(tables.write(chain.join(heads, "conv_id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))))
    return buckets, out


def _quicksort(rows: list[tuple], up: int, depth: int) -> list[list]:
    """Nodes of one bucket. rows: ids, chars, first, n, ends of each sequence, no two with equal ids.

    Multikey quicksort with an explicit stack: a part whose turns at a place are equal is a node. A node
    is [conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends, index of its parent].
    """
    nodes: list[list] = []
    work = [(rows, 0, up, -1)]
    while work:
        part, at, above, index = work.pop()
        pivot = part[len(part) // 2][0][at]
        less = [r for r in part if r[0][at] < pivot]
        more = [r for r in part if r[0][at] > pivot]
        same = [r for r in part if r[0][at] == pivot] if less or more else part
        work += [(x, at, above, index) for x in (less, more) if x]
        conv, total = min(r[2] for r in same), sum(r[3] for r in same)
        ends = next((r[4] for r in same if len(r[0]) == at + 1), None)
        deeper = [r for r in same if len(r[0]) > at + 1] if ends is not None else same
        nodes.append([conv, depth + at + 1, above, total, 0, 0, (total - 1) * same[0][1][at], ends or _NO_ENDS, index])
        if index >= 0:
            nodes[index][4] += 1
        if deeper:
            work.append((deeper, at + 1, conv, len(nodes) - 1))
    # A node stands behind its parent.
    for node in reversed(nodes):
        node[5] = node[5] or 1
        if node[8] >= 0:
            nodes[node[8]][5] += node[5]
            nodes[node[8]][6] += node[6]
    return nodes


def _finished(buckets: DataFrame) -> DataFrame:
    """The nodes of all buckets, with their round, and whether they are a bucket's top."""
    schema = f"{NODE}, round int, is_top boolean"
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    kinds = [pa.int64()] * 7 + [pa.string(), pa.int32(), pa.bool_()]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("round", "up", "head", "depth", "ids", "chars", "first", "n", "ends_sha256")), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []
        for (number, up, _, depth), rows in groupby(rows_of(batches), lambda r: r[:4]):
            nodes = _quicksort([r[4:] for r in rows], up, depth)
            ready += [(*x[:8], number, x[8] < 0) for x in nodes]
            if len(ready) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready, strict=True), kinds, strict=True)], names)
                ready = []
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready, strict=True), kinds, strict=True)], names)

    flat = buckets.select("round", "up", F.col("turns")[0]["id"].alias("head"), "depth", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars"), "first", "n", "ends_sha256")
    dealt = flat.repartition("round", "up", "head").sortWithinPartitions("round", "up", "head")
    return dealt.mapInArrow(run, schema)


def _chain_nodes(chain: DataFrame, below: DataFrame) -> DataFrame:
    """The nodes of large buckets' common prefixes, from the totals of what lies below them.

    chain: as of :func:`_radix`; below: up, n_leaves, saved_tokens summed over the buckets under each.
    """
    whole = chain.join(below.withColumnRenamed("up", "conv_id"), "conv_id", "left").select(
        "up", "depth", "conv_id", "n", "steps", "ends_sha256", "n_children",
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved"),
    )
    # Suffix sums over the chain: a node saves for itself and for what follows.
    own = F.transform("steps", lambda c: (F.col("n") - 1) * c)
    sums = F.reverse(F.aggregate(F.reverse(own), F.array(F.col("saved")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))))
    nodes = whole.withColumn("own", own).withColumn("sums", sums)
    # The root has no turn of its own, so its chain is one node long.
    last = F.size("steps")
    listed = nodes.select("*", F.explode(F.when(F.col("up").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), last))).alias("i"))
    return listed.select(
        "conv_id", (F.col("depth") + F.col("i")).cast("bigint").alias("depth"),
        F.when(F.col("i") > 1, F.col("conv_id")).otherwise(F.col("up")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(F.col("i") < last, 1).otherwise(F.col("n_children")).cast("bigint").alias("n_children"), "n_leaves",
        F.when(F.col("i") > 0, F.element_at("sums", F.greatest("i", F.lit(1)))).otherwise(F.col("saved")).alias("saved_tokens"),
        F.when(F.col("i") == last, F.coalesce("ends_sha256", F.lit(_NO_ENDS))).otherwise(_NO_ENDS).alias("ends_sha256"),
        (F.col("i") <= 1).alias("is_top"),
    )


def trie(conversations: DataFrame, bucket_turns: int = BUCKET_TURNS, rebuild: bool = False) -> DataFrame:
    """A row for each distinct sequence of first turns of ``conversations`` (conv_id, turn, role, text).

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (what a
    shared prefix saves, in code points of text, over the node's subtree) and ends_sha256 (of the
    ids, in order and parted by commas, of the conversations that end there). Null roles and texts are
    empty; rows without conv_id are left out; turns of one number are ordered by role and text, so
    repeated rows are turns of their own. An empty table has no node. Other columns are ignored.
    With ``rebuild`` conversations share prefixes first, as :func:`rebuilt` says.
    """
    tables = Tables(conversations.sparkSession)
    turns = tables.write(encoded_turns(conversations.select("conv_id", "turn", "role", "text")))
    ids = tables.write(dictionary(turns))
    marks = turns.select("conv_id").distinct()
    whole = rebuilt(turns) if rebuild else turns.unionByName(marks, allowMissingColumns=True)
    convs = tables.write(sequences(whole, ids))
    tables.drop(turns, ids)
    members = tables.write(_members(convs.select("key", "conv_id")))
    unique = tables.write(members.join(convs.select(F.col("conv_id").alias("first"), "turns"), "first"))
    tables.drop(convs, members)
    buckets, chains = _radix(tables, unique, bucket_turns)
    nodes = tables.write(_finished(buckets))
    parts = [nodes.drop("round", "is_top")]
    tops = nodes.where("is_top").select("round", F.col("parent_conv_id").alias("up"), "n_leaves", "saved_tokens")
    upper = None
    for number in reversed(range(len(chains))):
        under = tops.where(F.col("round") == number).drop("round")
        if upper is not None:
            under = under.unionByName(upper.where("is_top").select(F.col("parent_conv_id").alias("up"), "n_leaves", "saved_tokens"))
        below = under.groupBy("up").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        upper = tables.write(_chain_nodes(chains[number], below))
        parts.append(upper.drop("is_top"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    result = materialize(out)
    tables.drop_all()
    return result
