"""The prefix trie of many sequences, by van Emde Boas recursion.

A sequence is cut at half its depth (the largest power of two below its
length).  The upper half stays in its forest; the cut prefix gets a name, made
of the forest's name and the upper half's content, and the lower half goes into
the forest of that name.  Upper and lower halves are then cut in the same way,
independently of each other, down to single elements: a node is an element in a
forest.  Contents are combined by halves too, so no name waits for the one
before it.  The lowest levels of the recursion run inside a block of a
sequence, the others across the blocks, one exchange for several levels; no
task holds a sequence.

Totals go the other way.  What a forest saves is split among its members: each
node counts for its smallest member.  A block adds up its own share, the share
of the blocks below is grafted on its last element, level by level, and a node
sums the shares of its members.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.frames import written

BLOCK_BITS = 6  # a block holds 64 elements, a block of blocks 64 blocks
ROOT = bytes(16)
EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing
IDS_BITS = 12  # ids of one end are written down 4,096 neighbours at a time


# --- names ---------------------------------------------------------------------------


def _hashed(kind: bytes, a: bytes, b: bytes) -> bytes:
    return blake2b(a + b, digest_size=16, person=kind).digest()


def cut(forest: bytes, contents: list[bytes], found: list[bytes]) -> bytes:
    """Append for each element the forest it lies in; return the content of the whole."""
    if len(contents) == 1:
        found.append(forest)
        return contents[0]
    half = 1 << (len(contents) - 1).bit_length() - 1
    upper = cut(forest, contents[:half], found)
    lower = cut(_hashed(b"cut", forest, upper), contents[half:], found)
    return _hashed(b"content", upper, lower)


def _elements(column) -> tuple[np.ndarray, list[bytes], pa.StructArray]:
    """Offsets of the rows of a list column, its elements as 16 bytes each, and their fields."""
    offsets = column.offsets.to_numpy() - column.offsets[0].as_py()
    fields = column.flatten()
    raw = np.stack([fields.field("hi").to_numpy(), fields.field("lo").to_numpy()], axis=1).tobytes()
    return offsets, [raw[i:i + 16] for i in range(0, len(raw), 16)], fields


def _contents(batches):
    """(seq, at, content) of whole blocks."""
    for batch in batches:
        offsets, elements, _ = _elements(batch["items"])
        contents = [cut(ROOT, elements[a:b], []) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch["seq"], batch["block"], pa.array(contents, pa.binary())], names=["seq", "at", "content"])


def _forests(batches):
    """(seq, at, forest) of the blocks in each block of blocks, whose own forest is known."""
    for batch in batches:
        seqs, ats, forests = [], [], []
        for seq, forest, items in zip(batch["seq"].to_pylist(), batch["forest"].to_pylist(), batch["items"].to_pylist(), strict=True):
            cut(forest, [item["content"] for item in items], forests)
            seqs.extend([seq] * len(items))
            ats.extend(item["at"] for item in items)
        yield pa.RecordBatch.from_arrays([pa.array(seqs, pa.int64()), pa.array(ats, pa.int64()), pa.array(forests, pa.binary())], names=["seq", "at", "forest"])


def _above(blocks: DataFrame) -> DataFrame:
    """(seq, content) of the blocks of blocks; only whole ones are ever an upper half."""
    def combine(batches):
        for batch in batches:
            contents = [cut(ROOT, [item["content"] for item in items], []) for items in batch["items"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["seq"], batch["up"], pa.array(contents, pa.binary())], names=["seq", "at", "content"])
    return blocks.mapInArrow(combine, "seq bigint, at bigint, content binary")


def block_forests(blocks: DataFrame, last: int, bits: int = BLOCK_BITS) -> DataFrame:
    """(seq, at, forest) for blocks (seq, at, content) numbered from 0 to at most ``last``."""
    grouped = blocks.groupBy("seq", F.shiftright("at", bits).alias("up")).agg(F.sort_array(F.collect_list(F.struct("at", "content"))).alias("items"))
    if last >> bits:
        grouped = written(grouped, "blocks")
        grouped = grouped.join(block_forests(_above(grouped), last >> bits, bits).withColumnRenamed("at", "up"), ["seq", "up"])
    else:
        grouped = grouped.withColumn("forest", F.lit(ROOT))
    return grouped.select("seq", "forest", "items").mapInArrow(_forests, "seq bigint, at bigint, forest binary")


NAMED = "seq bigint, block bigint, length bigint, first bigint, hi array<bigint>, lo array<bigint>, weight array<bigint>, upto array<bigint>"


def _named(batches):
    """Names of the nodes along each block, and the weights up to each."""
    for batch in batches:
        offsets, elements, fields = _elements(batch["items"])
        weight = fields.field("weight").to_numpy()
        running = np.cumsum(weight)
        names, upto = [], np.empty(len(weight), np.int64)
        for forest, a, b in zip(batch["forest"].to_pylist(), offsets[:-1], offsets[1:], strict=True):
            inside: list[bytes] = []
            cut(forest, elements[a:b], inside)
            names.extend(_hashed(b"node", f, e) for f, e in zip(inside, elements[a:b], strict=True))
            upto[a:b] = running[a:b] - running[a] + weight[a]
        pair = np.frombuffer(b"".join(names), "<i8").reshape(-1, 2)
        first = pa.array(fields.field("pos").to_numpy()[offsets[:-1]], pa.int64())
        lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.ascontiguousarray(v), pa.int64())) for v in (pair[:, 0], pair[:, 1], weight, upto)]
        yield pa.RecordBatch.from_arrays([batch["seq"], batch["block"], batch["length"], first, *lists],
                                         names=["seq", "block", "length", "first", "hi", "lo", "weight", "upto"])


def named_blocks(elements: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Blocks of every sequence with the names of their nodes, for elements (seq, length, pos from 0, hi, lo, weight)."""
    blocks = written(elements.groupBy("seq", F.shiftright("pos", bits).alias("block")).agg(
        F.max("length").alias("length"), F.sort_array(F.collect_list(F.struct("pos", "hi", "lo", "weight"))).alias("items")), "blocks")
    last = blocks.agg(F.max("block")).first()[0] or 0
    short = blocks.where(F.col("length") < 1 << bits).withColumn("forest", F.lit(ROOT))
    if last:
        many = blocks.where(F.col("length") >= 1 << bits)
        contents = many.select("seq", "block", "items").mapInArrow(_contents, "seq bigint, at bigint, content binary")
        forests = block_forests(contents, last, bits).withColumnRenamed("at", "block")
        short = short.unionByName(many.join(forests, ["seq", "block"]))
    return short.mapInArrow(_named, NAMED)


# --- totals --------------------------------------------------------------------------


def grafted(blocks: DataFrame, last: int, bits: int = BLOCK_BITS) -> DataFrame:
    """(seq, at, below): for blocks (seq, at, share) the shares of all later blocks of their sequence."""
    marked = blocks.withColumn("up", F.shiftright("at", bits))
    later = Window.partitionBy("seq", "up").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
    inside = marked.withColumn("below", F.coalesce(F.sum("share").over(later), F.lit(0)))
    if last >> bits:
        above = written(marked.groupBy("seq", F.col("up").alias("at")).agg(F.sum("share").alias("share")), "shares")
        outside = grafted(above, last >> bits, bits).select("seq", F.col("at").alias("up"), F.col("below").alias("outside"))
        inside = inside.join(outside, ["seq", "up"]).withColumn("below", F.col("below") + F.col("outside"))
    return inside.select("seq", "at", "below")


def _at(name: str, index: Column) -> Column:
    return F.get(F.col(name), index.cast("int"))


def _end_hashes(batches):
    """SHA-256 over the texts of each node's blocks of ids, which come sorted."""
    from hashlib import sha256
    key, state = None, None

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], pa.string())], names=["hi", "lo", "ends_sha256"])
    for batch in batches:
        rows = []
        for hi, lo, ids in zip(batch["hi"].to_pylist(), batch["lo"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if (hi, lo) == key:
                state.update(b"," + ids.encode())
            else:
                if key is not None:
                    rows.append((*key, state.hexdigest()))
                key, state = (hi, lo), sha256(ids.encode())
        yield out(rows)
    if key is not None:
        yield out([(*key, state.hexdigest())])


def trie(elements: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """One row per node of the prefix trie of sequences given as ``elements``.

    ``elements`` has one row for each position of a sequence: seq (id), length
    (its last position), pos (0 to length; position 0 is the root, equal in all
    sequences), hi and lo (128 bits that stand for the element) and weight.
    Gives conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (each node's weight times its members
    but one, over the subtree) and ends_sha256 (over the ids of members that
    end in the node).  Hot nodes are counted before they are exchanged, and
    members that end in one node are written down in ranges of ids; the hash
    itself goes over them in order, range by range.  No elements, no rows.
    """
    named = written(named_blocks(elements, bits), "named")
    along = named.select("seq", "length", "first", F.posexplode(F.arrays_zip("hi", "lo")).alias("k", "name"))
    counted = along.groupBy(F.col("name.hi").alias("hi"), F.col("name.lo").alias("lo")).agg(
        F.min("seq").alias("seq"), F.min(F.col("first") + F.col("k")).alias("depth"), F.max("length").alias("deepest"))
    # from which depth on a sequence is the smallest member, and whether its end is a leaf that it stands for
    stands = counted.groupBy("seq").agg(F.min("depth").alias("start"), F.max((F.col("depth") == F.col("deepest")).cast("int")).alias("leaf"))
    blocks = named.join(stands, "seq", "left").withColumns({
        "start": F.coalesce("start", F.col("length") + 1), "leaf": F.coalesce("leaf", F.lit(0)),
    }).withColumn("stop", F.least(F.col("start") - F.col("first"), F.size("hi").cast("bigint")) - 1)  # last element that counts as saved
    blocks = written(blocks.withColumn("share", F.when(F.col("stop") >= 0, _at("upto", F.col("stop"))).otherwise(0)), "shares")
    last = blocks.agg(F.max("block")).first()[0] or 0
    weighed = blocks.where(F.col("length") < 1 << bits).withColumn("below", F.lit(0).cast("bigint"))
    if last:
        many = blocks.where(F.col("length") >= 1 << bits)
        below = grafted(many.select("seq", F.col("block").alias("at"), "share"), last, bits).withColumnRenamed("at", "block")
        weighed = weighed.unionByName(many.join(below, ["seq", "block"]))
    rows = weighed.select(
        "seq", "length", "start", "leaf", "stop", "below", "first", F.when(F.col("stop") >= 0, _at("upto", F.col("stop"))).alias("all"),
        F.posexplode(F.arrays_zip("hi", "lo", "weight", "upto")).alias("k", "e"),
    ).withColumn("depth", F.col("first") + F.col("k"))
    saved = F.when(F.col("k") <= F.col("stop"), F.col("all") - F.col("e.upto") + F.col("e.weight")).otherwise(0) + F.col("below")
    child = (F.col("depth") + 1).between(F.col("start"), F.col("length"))
    nodes = written(rows.groupBy(F.col("e.hi").alias("hi"), F.col("e.lo").alias("lo")).agg(
        F.min("seq").alias("conv_id"), F.min("depth").alias("depth"), F.min_by("start", "seq").alias("start"), F.count("*").alias("n_convs"),
        F.sum(child.cast("bigint")).alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum(saved).alias("saved_tokens")), "nodes")

    def name_at(pos: Column) -> list[Column]:
        return [_at(side, pos - F.col("first")).alias(side) for side in ("hi", "lo")]

    def holds(pos: Column) -> Column:
        return (pos >= F.col("first")) & (pos < F.col("first") + F.size("hi"))

    above = F.col("start") - 1
    branches = blocks.where((F.col("start") <= F.col("length")) & holds(above)).select(F.col("seq").alias("conv_id"), *name_at(above))
    parents = branches.join(nodes.select("hi", "lo", F.col("conv_id").alias("parent_conv_id")), ["hi", "lo"]).select("conv_id", "parent_conv_id")
    ends = blocks.where(holds(F.col("length"))).select("seq", *name_at(F.col("length")))
    listed = ends.groupBy("hi", "lo", F.shiftright("seq", IDS_BITS).alias("range")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("seq")), lambda s: s.cast("string")), ",").alias("ids"))
    hashes = listed.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "range").select("hi", "lo", "ids").mapInArrow(
        _end_hashes, "hi bigint, lo bigint, ends_sha256 string")
    full = nodes.join(hashes, ["hi", "lo"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))
    inner = full.where((F.col("depth") > F.col("start")) | (F.col("depth") == 0)).withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    tops = full.where((F.col("depth") == F.col("start")) & (F.col("depth") > 0)).join(parents, "conv_id")
    return inner.unionByName(tops, allowMissingColumns=True).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


# --- conversations -------------------------------------------------------------------

SHARED_EVERY, SHARED_MOST = 5, 8  # conversations that share a start, and turns that they share at most


def _numbered(batches):
    """The place of every row in its conversation, within a sorted partition."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    held, count = None, 0
    for batch in batches:
        conv = batch["conv"].to_numpy()
        if not len(conv):
            continue
        new = np.r_[True, conv[1:] != conv[:-1]]
        starts = np.flatnonzero(new)
        place = np.arange(len(conv)) - np.repeat(starts, np.diff(np.r_[starts, len(conv)])) + 1
        if conv[0] == held:
            place[:starts[1] if len(starts) > 1 else len(conv)] += count
        held, count = conv[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays([batch["conv"], pa.array(np.full(len(conv), part), pa.int64()), pa.array(place, pa.int64()),
                                          batch["hi"], batch["lo"], batch["weight"]], names=["conv", "part", "place", "hi", "lo", "weight"])


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths): conv, pos (from 1), hi, lo, weight of every turn, and conv, n of every conversation.

    Rows are sorted in ranges, so a long conversation may lie in many
    partitions; a partition adds what the ones before hold of its first
    conversation, one number for each partition.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    keyed = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").alias("number"), role.alias("role"), F.xxhash64(role, text).alias("hi"),
        F.xxhash64(F.lit("turn"), text, role).alias("lo"), F.octet_length(text).cast("bigint").alias("weight"), F.monotonically_increasing_id().alias("row"))
    order = ["conv", "number", "role", "hi", "lo"]
    placed = written(keyed.repartitionByRange(*order, "row").sortWithinPartitions(*order).select("conv", "hi", "lo", "weight").mapInArrow(
        _numbered, "conv bigint, part bigint, place bigint, hi bigint, lo bigint, weight bigint"), "turns")
    counts = placed.groupBy("conv", "part").agg(F.max("place").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("before", before).where("before IS NOT NULL").select("conv", "part", "before")  # at most one row for each partition
    turns = placed.join(F.broadcast(offsets), ["conv", "part"], "left").select(
        "conv", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "hi", "lo", "weight")
    return turns, counts.groupBy("conv").agg(F.sum("n").alias("n"))


def spliced(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Elements of the rebuilt conversations: the start of the shared one, then the own turns after as many."""
    conv = F.col("conv")
    shared = lengths.withColumns({"base": conv - conv % SHARED_EVERY, "h": F.crc32(conv.cast("string")) % (SHARED_MOST + 1)})
    bases = lengths.where(conv % SHARED_EVERY == 0).select(conv.alias("base"), F.col("n").alias("base_n"))
    plan = written(shared.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))).select(
        "conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "plan")
    heads = turns.where((conv % SHARED_EVERY == 0) & (F.col("pos") <= SHARED_MOST)).withColumnRenamed("conv", "base")
    element = ["seq", "length", "pos", "hi", "lo", "weight"]
    taken = heads.join(plan, "base").where("pos <= taken").withColumnRenamed("conv", "seq").select(element)
    own = turns.join(plan, "conv").where("pos > h").withColumn("pos", F.col("taken") + F.col("pos") - F.col("h")).withColumnRenamed("conv", "seq").select(element)
    zero = F.lit(0).cast("bigint")
    roots = plan.select(conv.alias("seq"), "length", zero.alias("pos"), zero.alias("hi"), zero.alias("lo"), zero.alias("weight"))
    return taken.unionByName(own).unionByName(roots)


def conversation_trie(conversations: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """The prefix trie of rebuilt conversations; columns as of ``trie``.

    Reads conv_id, turn, role and text, whatever else the table holds.  Rows
    without conv_id belong to no conversation and are left out.  Null turns
    come first; rows of one conversation and turn follow each other by role,
    then by the hash of role and text, and repeated rows are turns each.  A null
    role or text is empty.  Texts of any length go in as their hash and their
    number of bytes.  An empty table gives no rows.  Elements are told apart by
    128 bits.
    """
    return trie(spliced(*ordered_turns(conversations)), bits)


CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, b: CASE WHEN xor(a, b) & 1 = 1 THEN xor(xor(a, b) >> 1, 3988292384) ELSE xor(a, b) >> 1 END), 4294967295)"""


def oracle_sql() -> str:
    """The same rows with every ancestor and descendant paired, for small tables."""
    return f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role) AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
plan AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC32} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT p.conv_id, t.pos, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.base AND t.pos <= p.h
  UNION ALL
  SELECT p.conv_id, least(p.h, (SELECT count(*) FROM turns b WHERE b.conv_id = p.base)) + t.pos - p.h, t.role, t.text
  FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND t.pos > p.h),
paths AS (
  SELECT conv_id, 0 AS depth, 'r' AS path, 0 AS bytes FROM plan
  UNION ALL
  SELECT conv_id, pos, 'r' || string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY pos), strlen(text) FROM rebuilt),
lengths AS (SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(bytes) AS bytes,
    CASE WHEN any_value(depth) > 0 THEN left(path, length(path) - 64) END AS parent,
    string_agg(CASE WHEN depth = length THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
  FROM paths JOIN lengths USING (conv_id) GROUP BY path),
children AS (SELECT parent AS path, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT DISTINCT a.path AS path, d.path AS node FROM paths a JOIN paths d ON a.conv_id = d.conv_id AND d.depth >= a.depth),
totals AS (
  SELECT b.path, sum(CASE WHEN c.path IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved_tokens
  FROM below b JOIN nodes n ON n.path = b.node LEFT JOIN children c ON c.path = b.node GROUP BY b.path)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
  t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.path = n.parent LEFT JOIN children c ON c.path = n.path JOIN totals t ON t.path = n.path
"""
