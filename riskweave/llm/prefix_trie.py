"""Prefix trie of conversations by the Euler tour technique.

Two conversations share a node for every sequence of first turns (role, text)
that they share. A prefix is named by its depth and the exclusive-or of 120-bit
hashes of (place, turn), so it is known from a running value; a node is then
named by its smallest member and its depth.

Subtree sums come from the tour, not from walking the tree: every node has an
enter and an exit arc; an enter arc is followed by the first child's enter arc
or its own exit arc, an exit arc by the next sibling's enter arc or the parent's
exit arc. Ranking this linked list gives each arc its position; running sums of
leaves and savings over the positions, at the exit less before the enter, are
the sums of the subtree.

List ranking: tasks first contract the paths that they hold (a conversation's
chain of arcs mostly lies together). Of what is left, hashing picks rulers; the
others jump over doubling distances until they meet a ruler or the end, and
drop out of the joins then; the rulers are ranked in the same way among
themselves. The last few thousand links are ranked in one task. So the work is a small
multiple of the number of arcs, and no task or driver holds the list.

Edge cases: rows without a conversation id take no part; null role and text are
empty; null turns come first; rows of one turn follow in the order of the
SHA-256 sum of role and text; repeated rows are turns of their own; texts and
conversations may be of any length; an empty table gives no rows; further
columns are ignored unless asked for with ``keep``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import staged
from riskweave.llm.running import running
from riskweave.llm.shards import runs_by


def numbered(turns: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """conv_id, nth (from 1, by turn), sha and chars of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", sha.alias("sha"), F.length(text).cast("long").alias("chars"), *keep)
    return running(rows, "conv_id", [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("sha")], name="trie-turns").drop("turn")


def grafted(turns: DataFrame, span: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with turns of another one, and all conversation ids.

    Conversation c takes the first ``crc32(c) % most`` turns of c - c % span (as
    many as that has) in place of as many turns of its own. ``turns`` are
    :func:`numbered`; the result has conv_id, depth, sha, chars.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % most
    base = F.col("conv_id") - F.col("conv_id") % span
    convs = staged(turns.select("conv_id").distinct(), "trie-convs")
    firsts = turns.filter((F.col("conv_id") % span == 0) & (F.col("nth") < most)).select(F.col("conv_id").alias("base"), "nth", "sha", "chars")
    heads = convs.select("conv_id", base.alias("base"), h.alias("h")).join(firsts, "base").filter("nth <= h")
    had = firsts.groupBy("base").agg(F.count("*").alias("had"))
    own = turns.select("conv_id", "nth", "sha", "chars", base.alias("base"), h.alias("h")).filter("nth > h").join(had, "base", "left")
    depth = F.col("nth") - F.col("h") + F.least("h", F.coalesce("had", F.lit(0)))
    return (heads.select("conv_id", F.col("nth").alias("depth"), "sha", "chars")
            .unionByName(own.select("conv_id", depth.alias("depth"), "sha", "chars")), convs)


def contract(arc: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the head of each arc's path among these arcs, and how many arcs lie before it on the path."""
    order = np.argsort(arc)
    at = np.minimum(np.searchsorted(arc, to, sorter=order), len(arc) - 1)
    follows = order[at]
    inside = arc[follows] == to
    back = np.arange(len(arc))  # the arc before, or itself
    back[follows[inside]] = np.flatnonzero(inside)
    before = (back != np.arange(len(arc))).astype(np.int64)
    while True:
        further = back[back]
        if (further == back).all():
            return back, before
        before = before + before[back]
        back = further


def _paths(batches):
    for b in batches:
        if not b.num_rows:
            continue
        arc, to = b.column("arc").to_numpy(), b.column("to").fill_null(-1).to_numpy()
        head, before = contract(arc, to)
        tail = np.zeros(len(arc), np.int64)
        length = np.bincount(head, minlength=len(arc))
        tail[head[before == length[head] - 1]] = np.flatnonzero(before == length[head] - 1)
        own = head == np.arange(len(arc))
        ends = to[tail]
        yield pa.RecordBatch.from_arrays(
            [b.column("arc"), pa.array(arc[head]), pa.array(before), pa.array(ends, mask=~own | (ends < 0)), pa.array(length, mask=~own),
             b.column("leaf"), b.column("saved")], names=["arc", "head", "before", "to", "n", "leaf", "saved"])


def _jump(links: DataFrame) -> DataFrame:
    """Links that are not done, over the next link; ``links``: id, to, n, done."""
    after = links.select(F.col("id").alias("to"), F.col("to").alias("to2"), F.col("n").alias("n2"), F.col("done").alias("done2"))
    moved = links.filter("not done").join(after, "to").select("id", F.col("to2").alias("to"), (F.col("n") + F.col("n2")).alias("n"),
                                                              F.col("done2").alias("done"))
    return staged(links.filter("done").unionByName(moved), "trie-links")


def list_rank(links: DataFrame, few: int = 4096, one_in: int = 16) -> DataFrame:
    """(id, left): the sum of ``n`` from each link to the end of the list.

    ``links``: id, to (null at the end), n. Lists of at most ``few`` links are
    ranked in one task, in longer ones a ruler is ``one_in`` links.
    """
    levels, now = [], staged(links.select("id", "to", "n"), "trie-links")
    while now.count() > few:
        level = F.lit(len(levels))
        ruler = lambda c, level=level: F.pmod(F.xxhash64(c, level), F.lit(one_in)) == 0
        step = now.withColumn("done", F.col("to").isNull() | ruler("to"))
        step = _jump(step)
        while not step.filter("not done").isEmpty():
            step = _jump(step)
        levels.append(step)
        now = staged(step.filter(ruler("id")).select("id", "to", "n"), "trie-rulers")

    def rank(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        held = pa.Table.from_batches(batches)
        ids, to, n = (held.column(c).combine_chunks().fill_null(-1).to_numpy() for c in ("id", "to", "n"))
        order = np.argsort(ids)
        at = order[np.minimum(np.searchsorted(ids, to, sorter=order), len(ids) - 1)]
        stop = len(ids)
        at, left = np.append(np.where(ids[at] == to, at, stop), stop), np.append(n, 0)
        while (at != stop).any():
            left, at = left + left[at], at[at]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(left[:-1])], names=["id", "left"])
    known = staged(now.repartition(1).mapInArrow(rank, "id long, left long"), "trie-ranks")
    for step in reversed(levels):
        known = staged(step.join(known.withColumnRenamed("id", "to"), "to", "left").select(
            "id", (F.col("n") + F.coalesce("left", F.lit(0).cast("long"))).alias("left")), "trie-ranks")
    return known


def _digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, joined by commas in ascending order.

    Ranges of ids become strings in many tasks; a node's strings then run
    through one hash, in order, without being held together.
    """
    keys = ["conv_id", "depth"]

    def strings(batches):
        for (conv, depth), part in runs_by(batches, keys):
            ids = part.column("member")
            yield pa.RecordBatch.from_arrays([part.column("conv_id")[:1], part.column("depth")[:1], ids[:1], pa.array([",".join(map(str, ids.to_pylist()))])],
                                             names=["conv_id", "depth", "least", "ids"])

    def digest(batches):
        now, sha = None, None
        for key, part in runs_by(batches, keys):
            if key != now:
                if now is not None:
                    yield row(now, sha)
                now, sha = key, hashlib.sha256()
            else:
                sha.update(b",")
            for k, x in enumerate(part.column("ids").to_pylist()):
                sha.update(("," * (k > 0) + x).encode())
        if now is not None:
            yield row(now, sha)

    def row(key, sha):
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([sha.hexdigest()])],
                                          names=[*keys, "ends_sha256"])
    ranged = ends.select(*keys, "member").repartitionByRange(*keys, "member").sortWithinPartitions(*keys, "member")
    cut = ranged.mapInArrow(strings, "conv_id long, depth long, least long, ids string")
    return cut.repartition(*keys).sortWithinPartitions(*keys, "least").mapInArrow(digest, "conv_id long, depth long, ends_sha256 string")


def trie(rows: DataFrame, convs: DataFrame, few: int = 4096) -> DataFrame:
    """Every node of the trie of ``rows`` (conv_id, depth from 1 without gaps, sha, chars).

    ``convs`` (conv_id) names all conversations, also those without turns. A
    node is (conv_id, depth): its smallest member and its number of turns; so
    its last turn is that conversation's turn at that depth.
    """
    zero = F.lit(0).cast("long")
    placed = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("sha")), 256)
    rows = rows.select("conv_id", F.col("depth").cast("long").alias("depth"), "chars", placed.alias("x")).select(
        "conv_id", "depth", "chars", *(F.conv(F.substring("x", a, 15), 16, 10).cast("long").alias(c) for c, a in (("c1", 1), ("c2", 16))))
    paths = running(rows, "conv_id", [F.col("conv_id"), F.col("depth")], xor=("c1", "c2"), name="trie-paths")
    node = ["depth", "run_c1", "run_c2"]
    deep = paths.groupBy(*node).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("chars").alias("chars"),
        F.min(F.col("run_c1").bitwiseXOR(F.col("c1"))).alias("up1"), F.min(F.col("run_c2").bitwiseXOR(F.col("c2"))).alias("up2"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    first = root.first()
    top = first["conv_id"] if first else None
    nodes = staged(deep.unionByName(root.select("*", *(zero.alias(c) for c in ("depth", "run_c1", "run_c2", "chars", "up1", "up2")))), "trie-nodes")
    # The root's children are many, and their parent is known; the others look theirs up.
    above = nodes.filter("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("run_c1").alias("up1"), F.col("run_c2").alias("up2"),
                                             F.col("conv_id").alias("parent_conv_id"))
    tied = nodes.filter("depth > 1").join(above, ["depth", "up1", "up2"]).unionByName(
        nodes.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(top)).cast("long")))
    order = [F.col("depth"), F.col("parent_conv_id").asc_nulls_first(), F.col("conv_id")]
    tied = running(tied.select("depth", "parent_conv_id", "conv_id", "n_convs", "chars"), None, order, name="trie-siblings").withColumnRenamed("nth", "id")
    children = tied.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")).agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n_children"))
    family = staged(tied.join(children, ["depth", "conv_id"], "left"), "trie-family")
    # Arcs: 2 id enters, 2 id + 1 leaves a node. Siblings have consecutive ids.
    enter, leave = F.col("id") * 2, F.col("id") * 2 + 1
    entering = family.select("conv_id", "depth", enter.alias("arc"), F.coalesce(F.col("first") * 2, leave).alias("to"),
                             F.when(F.col("first").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
                             ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    lasts = family.filter("last is not null").select(F.col("last").alias("id"), leave.alias("up"))
    leaving = family.select("conv_id", "depth", "id").join(lasts, "id", "left").select(
        "conv_id", "depth", leave.alias("arc"), F.coalesce("up", F.when(F.col("depth") > 0, F.col("id") * 2 + 2)).alias("to"),
        zero.alias("leaf"), zero.alias("saved"))
    stretch = F.floor(F.col("depth") / 1024)
    arcs = (entering.unionByName(leaving).repartition("conv_id", stretch).sortWithinPartitions("conv_id", "depth").select("arc", "to", "leaf", "saved")
            .mapInArrow(_paths, "arc long, head long, before long, to long, n long, leaf long, saved long"))
    arcs = staged(arcs, "trie-arcs")
    ranks = list_rank(arcs.filter("arc = head").select(F.col("arc").alias("id"), "to", "n"), few)
    # A list's end has the greatest place: places count down from the end, so they are turned by the sign.
    tour = arcs.join(ranks.withColumnRenamed("id", "head"), "head").select("arc", (F.col("before") - F.col("left")).alias("place"), "leaf", "saved")
    tour = running(tour, None, [F.col("place")], add=("leaf", "saved"), name="trie-tour")
    at_exit = F.col("arc") % 2 == 1
    span = lambda c: F.sum(F.when(at_exit, F.col(f"run_{c}")).otherwise(F.col(c) - F.col(f"run_{c}")))
    below = tour.groupBy(F.floor(F.col("arc") / 2).alias("id")).agg(span("leaf").alias("n_leaves"), span("saved").alias("saved_tokens"))
    # Where conversations end.
    last = paths.groupBy("conv_id").agg(F.max(F.struct(*node)).alias("last")).select("conv_id", *(f"last.{c}" for c in node))
    ends = convs.join(last, "conv_id", "left").select(F.col("conv_id").alias("member"), *(F.coalesce(c, zero).alias(c) for c in node))
    ends = ends.join(nodes.select(*node, "conv_id"), node)
    found = family.join(below, "id").join(_digests(ends), ["conv_id", "depth"], "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
