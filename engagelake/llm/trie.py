"""Operator 13: the prefix trie of conversations by smallest-member ownership.

A node is a distinct sequence of first turns; its members are the conversations that begin with it, and its owner is the smallest of
them. Whoever owns a node owns all nodes behind it on the own path, since fewer members share them: each
conversation owns a suffix of its path. So one number for each conversation, the depth where its suffix begins, tells all of its nodes, and
what a subtree saves is a sum over its members: the tokens (here bytes) of all their turns below, less those of the nodes that they own.
One group-by of the prefixes sums this, the leaves owned by members, and the members' own next nodes (each child is owned by one of them).

A prefix is named by its depth and by two 64-bit exclusive ors of its turns' hashes, each with its place: a running
exclusive or along the conversation, in windows. Texts stay where they are read; hashes and lengths travel.

No key's rows meet in one task. Turns are numbered by a sort over ranges (conversation, turn), which a very long conversation spans; windows
run over ``CHUNK`` turns of a conversation, chunks are put together by their totals; the root and other prefixes with very many members
are partial aggregates, and come back to their rows by ``graph.spread_join``. Ids that end at one node reach their digest in sorted packets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import graph, shared

#: Turns of a conversation that one window takes; ids in a packet of a digest.
CHUNK, PACKET = 1024, 4096
#: Conversations that share a base, and first turns that can come from it.
FAMILY, SHARED_TURNS = 5, 9

NODE = ["depth", "x1", "x2"]


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, k1, k2, bytes): hashes and size of every turn, numbered from 0 within its conversation, null turns first."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")}
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), *text.values()).alias("k1"), F.xxhash64(F.lit(2), *text.values()).alias("k2"),
        F.octet_length(text["text"]).cast("long").alias("bytes"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2")]
    spark = conversations.sparkSession
    ranged = turns.repartitionByRange(shared.partitions(spark), *order).sortWithinPartitions(*order)
    # the number of a row counts up in the order of the ranges: partition in the upper bits, row in the lower 33
    laid = shared.written(ranged.withColumn("m", F.monotonically_increasing_id()).drop("turn"))
    pid, row = F.shiftright("m", 33), F.col("m").bitwiseAND((1 << 33) - 1)
    counts = laid.groupBy(pid.alias("pid")).agg(F.count("*").alias("n")).orderBy("pid").collect()  # a row for each partition
    before, offsets = 0, []
    for r in counts:
        offsets.append((r.pid, before))
        before += r.n
    known = F.broadcast(spark.createDataFrame(offsets, "pid long, before long"))
    placed = laid.withColumn("pid", pid).join(known, "pid").select("conv_id", "k1", "k2", "bytes", (F.col("before") + row).alias("row"))
    sizes = placed.groupBy("conv_id").agg(F.min("row").alias("first"), F.count("*").alias("turns"))
    return graph.spread_join(placed, sizes, ["conv_id"], "turns", before).select("conv_id", "turns", (F.col("row") - F.col("first")).alias("at"), "k1",
        "k2", "bytes")


def plain(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, bytes) of conversations as they are."""
    return turns.select("conv_id", (F.col("at") + 1).alias("depth"), "k1", "k2", "bytes")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, bytes) of conversations that begin with the first turns of their family's base.

    Conversation c takes h turns, crc32 of c modulo 9, from the largest multiple of five not above c, and goes on with its own
    after its first h. Turn numbers, hashes and sizes move, no texts.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    convs = turns.where("at = 0").select("conv_id", "turns")
    families = convs.groupBy(base.alias("base")).agg(F.max(F.when(F.col("conv_id") == base, F.col("turns"))).alias("base_turns"),
        F.collect_list("conv_id").alias("members"))  # five at most
    own = turns.where(F.col("at") >= h).withColumn("base", base)
    size = convs.join(families, base == F.col("base")).select("conv_id", "turns", F.coalesce("base_turns", F.lit(0)).alias("base_turns"))
    total = turns.count()
    own = graph.spread_join(own.drop("turns"), size, ["conv_id"], "turns", total).select("conv_id", (F.least(h, "base_turns") + F.col("at") - h + 1).alias("depth"), "k1",
        "k2", "bytes")
    lent = turns.where((F.col("conv_id") == base) & (F.col("at") < SHARED_TURNS)).drop("turns").withColumnRenamed("conv_id", "base").join(families, "base")
    lent = lent.withColumn("conv_id", F.explode("members")).where(F.col("at") < h).select("conv_id", (F.col("at") + 1).alias("depth"), "k1", "k2", "bytes")
    return own.unionByName(lent)


def with_prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, x1, x2, bytes, upto, turns) for every prefix of every conversation of ``convs``, the empty one included.

    ``upto`` sums the bytes of the prefix; ``turns`` is the conversation's length.
    """
    terms = [F.xxhash64("depth", "k1", "k2").alias("t1"), F.xxhash64("k2", "k1", "depth").alias("t2")]
    terms = turns.select("conv_id", "depth", *terms, "bytes", F.floor((F.col("depth") - 1) / CHUNK).alias("chunk"))
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("t1"), F.lit(0).cast("long").alias("t2"),
        F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("chunk"))
    all_ = terms.unionByName(root)
    totals = all_.groupBy("conv_id", "chunk").agg(F.bit_xor("t1").alias("c1"), F.bit_xor("t2").alias("c2"), F.sum("bytes").alias("cb"),
        F.max("depth").alias("last"))
    ahead = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    before = totals.select("conv_id", "chunk", F.coalesce(F.bit_xor("c1").over(ahead), F.lit(0)).alias("c1"),
        F.coalesce(F.bit_xor("c2").over(ahead), F.lit(0)).alias("c2"), F.coalesce(F.sum("cb").over(ahead), F.lit(0)).alias("cb"),
        F.max("last").over(whole).alias("turns"))
    along = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return all_.join(before, ["conv_id", "chunk"]).select("conv_id", "depth", F.bit_xor("t1").over(along).bitwiseXOR(F.col("c1")).alias("x1"),
        F.bit_xor("t2").over(along).bitwiseXOR(F.col("c2")).alias("x2"), "bytes", (F.sum("bytes").over(along) + F.col("cb")).alias("upto"), "turns")


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256): a digest of the sorted ids of each node in ``ends`` (conv_id, depth, x1, x2).

    Ids are sorted over ranges, where each task writes those of a node as packets of text; a node's packets then go through its digest
    one after another. None is held whole.
    """
    spark = ends.sparkSession
    n, order = shared.partitions(spark), [*NODE, "conv_id"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in order), strict=True))
        out = []
        for node, group in groupby(rows, itemgetter(0, 1, 2)):
            held = []
            for r in group:
                held.append(r[3])
                if len(held) == PACKET:
                    out.append((*node, held[0], ",".join(map(str, held))))
                    held = []
            if held:
                out.append((*node, held[0], ",".join(map(str, held))))
            if len(out) >= 1000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip((*NODE, "least", "ids"), r, strict=True)) for r in rows],
            pa.schema([(c, pa.int64()) for c in (*NODE, "least")] + [("ids", pa.string())]))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in (*NODE, "ids")), strict=True))
        out = []
        for node, group in groupby(rows, itemgetter(0, 1, 2)):
            digest = hashlib.sha256(next(group)[3].encode())
            for r in group:
                digest.update(b"," + r[3].encode())
            out.append((*node, digest.hexdigest()))
            if len(out) >= 1000:
                yield made(out)
                out = []
        if out:
            yield made(out)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*rows, strict=True))[:3]), pa.array([r[3] for r in rows])],
            [*NODE, "ends_sha256"])

    packets = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(packed,
        "depth long, x1 long, x2 long, least long, ids string")
    return packets.repartition(n, *NODE).sortWithinPartitions(*NODE, "least").select(*NODE, "ids").mapInArrow(digested,
        "depth long, x1 long, x2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, rebuild: bool = False) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rebuild``: conversations share the first turns of their family's base (see ``rebuilt``). Null roles and texts count as empty; null turns come
    first; turns of one number go in the order of a hash of role and text, so that equal rows are further equal turns; rows
    without a conversation are left out; a conversation without turns is a member of the root. An empty table gives an empty result, without a
    root; other columns are ignored.
    """
    turns = shared.written(numbered(conversations))
    convs = turns.where("at = 0").select("conv_id")
    rows = shared.written(with_prefixes(rebuilt(turns) if rebuild else plain(turns), convs))
    total = rows.count()
    ends = F.col("depth") == F.col("turns")
    nodes = rows.groupBy(*NODE).agg(F.min("conv_id").alias("owner"), F.count("*").alias("members"), F.count_if(ends).alias("ended"))
    marked = graph.spread_join(rows, nodes, NODE, "members", total)
    owned = F.col("owner") == F.col("conv_id")
    suffix = marked.groupBy("conv_id").agg(F.min(F.when(owned, F.col("depth"))).alias("since"),
        F.coalesce(F.min(F.when(owned, F.col("upto") - F.col("bytes"))), F.max("upto")).alias("not_owned"),
        F.max_by("owner", F.when(~owned, F.col("depth"))).alias("above"), F.max("depth").alias("turns"),
        F.count_if(owned & ends & (F.col("ended") == F.col("members"))).alias("leaf"))
    # what a conversation does not own of its path ends where its suffix begins
    about = graph.spread_join(rows.drop("turns"), suffix, ["conv_id"], "turns", total)
    parent = F.when(F.col("depth") > F.col("since"), F.col("conv_id")).otherwise(F.col("above"))
    child = F.col("since").isNotNull() & (F.col("depth") + 1 >= F.col("since")) & (F.col("depth") < F.col("turns"))
    out = about.groupBy(*NODE).agg(F.min(F.struct("conv_id", parent.alias("parent"))).alias("least"), F.count("*").alias("n_convs"),
        F.count_if(child).alias("n_children"), F.sum("leaf").alias("n_leaves"),
        F.sum(F.greatest(F.lit(0), F.col("not_owned") - (F.col("upto") - F.col("bytes")))).alias("saved_tokens"))
    digests = end_digests(rows.where(ends))
    none = hashlib.sha256().hexdigest()
    return out.join(digests, NODE, "left").select("least.conv_id", "depth", F.col("least.parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(shared.table(spark, sf_dir, "conversations"), rebuild=True)
