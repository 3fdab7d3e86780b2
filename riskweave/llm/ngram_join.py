"""Near-duplicate join on word shingles by chosen paths.

A document's set holds the hashes of its runs of five words (lower case, split
at white space; a shorter text is one run of all its words). Equal sets are one
class before anything is compared. Each class keeps 64 min-hashes; a token is a
(position, min-hash) pair, and two sets share a token with the probability of
their Jaccard similarity.

Chosen paths: in every run a set goes to the buckets of 1 / similarity sampled
positions on average. A bucket of at most ``limit`` classes is compared in
full. In a larger bucket every class is compared with a few pivots and loosely
linked to them. A class is settled once it is as similar to a pivot as is
wanted: what is similar to it then shares, by the triangle inequality of
signatures, many positions with that pivot too, and is linked to the pivot or
else, as doubtful, compared with the settled classes in blocks. The unsettled
ones split again on newly sampled positions as long as they are many; then, or
at the last level, they are compared with their whole bucket in blocks. A node
has one child at least, and as many on average as keep the chance that all paths
of a pair end early below what the target recall allows at the last level
(:func:`missed`).

An exact check follows. Candidate links (similarity estimated well below the
threshold) make groups; inside a group the sets themselves are compared, in
blocks of bounded size, and a task returns link counts and a spanning forest,
never the pairs. So a link is missed only if no chain of candidates joins its
ends.

Edge cases: null and empty texts have an empty set and are copies of each other
(similarity 1) and of nothing else; a null id is a document like any other and
never gives its class its name, unless all ids of the class are null; repeated
rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import exclusive_sum, small_if, staged, text_column, text_slices
from riskweave.llm.components import components
from riskweave.llm.shards import runs_by

POSITIONS, PIVOTS = 64, 4
#: Signatures that are sent to every executor at most (13 MB), and pairs of blocks for which no level is split any further.
SIGNATURES, BLOCK_PAIRS = 50_000, 128
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after another, and their offsets."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    coded = lists.values.dictionary_encode()
    words = pc.utf8_lower(coded.dictionary).to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    blank = np.fromiter((not w for w in words), bool, len(words))
    index = np.asarray(coded.indices)
    keep = ~blank[index]
    flat = hashes[index[keep]]
    offsets = exclusive_sum(keep)[offsets]
    counts = np.diff(offsets)
    factor = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        runs = np.zeros(max(0, len(flat) - width + 1), np.uint64)
        for k in range(width):
            runs = runs * factor + flat[k:k + len(runs)]
        runs = mix(runs)
        sets = []
        for at, n in zip(offsets, counts):
            if n >= width:
                sets.append(np.unique(runs[at:at + n - width + 1]))
            else:
                whole = np.uint64(n)
                for h in flat[at:at + n]:
                    whole = whole * factor + h
                sets.append(mix(np.array([whole]))[:1 if n else 0])
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), exclusive_sum(sizes)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def set_names(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set, as two arrays of signed longs."""
    return tuple(segment_sums(mix(flat + np.uint64(s)), offsets).view(np.int64) for s in (1, 0x5851F42D4C957F2D))


def sketches(docs: DataFrame, id_col: str, width: int) -> DataFrame:
    """id, name_a, name_b, size and min-hashes of every document; written once."""
    salt = mix(np.arange(1, POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def run(batches):
        for batch in batches:
            for rows in text_slices(batch, "text"):
                flat, offsets = shingle_sets(rows.column("text"), width)
                n = len(offsets) - 1
                some = np.flatnonzero(np.diff(offsets))
                least = np.zeros((n, POSITIONS), np.uint32)
                if len(some):
                    for k in range(POSITIONS):
                        h = ((flat ^ salt[k]) * MIX2) >> np.uint64(32)
                        least[some, k] = np.minimum.reduceat(h.astype(np.uint32), offsets[some])
                a, b = set_names(flat, offsets)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array(a), pa.array(b), pa.array(np.diff(offsets)),
                     pa.array([r.tobytes() for r in least], pa.binary())], names=["id", "name_a", "name_b", "size", "sig"])
    source = docs.select(F.col(id_col).cast("long").alias("id"), text_column().alias("text"))
    return staged(source.mapInArrow(run, "id long, name_a long, name_b long, size long, sig binary")
                  .withColumn("row", F.monotonically_increasing_id()), "join-sketches")


def token(position) -> F.Column:
    """The 4 bytes of a signature at a position."""
    return F.expr(f"substring(sig, 4 * ({position}) + 1, 4)")


def same(sigs: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many positions agree, for every pair of the two blocks."""
    out = np.zeros((len(sigs), len(others)), np.int16)
    for k in range(POSITIONS):
        out += sigs[:, k, None] == others[None, :, k]
    return out


def spanning(linked: np.ndarray) -> np.ndarray:
    """Smallest place of each row's component under a symmetric link matrix."""
    n = len(linked)
    label = np.arange(n)
    while True:
        now = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1, initial=n))
        now = now[now]
        if (now == label).all():
            return label
        label = now


def forest(batches):
    """Links that join the same nodes as those of each batch, one less than the nodes they join."""
    for b in batches:
        nodes, ends = np.unique(np.concatenate([b.column("a").to_numpy(), b.column("b").to_numpy()]), return_inverse=True)
        one, two = ends[:b.num_rows], ends[b.num_rows:]
        label = np.arange(len(nodes))
        while True:
            now, low = label.copy(), np.minimum(label[one], label[two])
            np.minimum.at(now, one, low)
            np.minimum.at(now, two, low)
            now = now[now]
            if (now == label).all():
                break
            label = now
        off = label != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[label[off]]), pa.array(nodes[off])], names=["a", "b"])


def signatures(column) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint32).reshape(-1, POSITIONS)


def missed(similarity: float, roots: int, depth: int, children: float) -> float:
    """Chance that no path of a pair lasts ``depth`` splits.

    ``roots`` distinct positions, then by node ``children`` positions on average
    (the whole number below it or one more). Exact by the number of positions in
    which the pair agrees, but for positions a node draws once at most.
    """
    out, n, more = 0.0, int(children), children - int(children)
    for agree in range(POSITIONS + 1):
        share, lasts = agree / POSITIONS, 1.0
        for _ in range(depth):
            lasts = 1 - (1 - share * lasts) ** n * (1 - more * share * lasts)
        ends = sum(math.comb(agree, k) * math.comb(POSITIONS - agree, roots - k) * (1 - lasts) ** k
                   for k in range(roots + 1)) / math.comb(POSITIONS, roots)
        out += math.comb(POSITIONS, agree) * similarity ** agree * (1 - similarity) ** (POSITIONS - agree) * ends
    return out


def children_needed(similarity: float, roots: int, depth: int, chance: float) -> float:
    """The least mean number of children, in eighths, at which pairs are missed with ``chance`` at most."""
    return next((k / 8 for k in range(8, 8 * POSITIONS) if missed(similarity, roots, depth, k / 8) <= chance), float(POSITIONS))


def agreement_needed(similarity: float, chance: float) -> int:
    """Positions in which a pair agrees, but for a ``chance``."""
    below = 0.0
    for agree in range(POSITIONS + 1):
        below += math.comb(POSITIONS, agree) * similarity ** agree * (1 - similarity) ** (POSITIONS - agree)
        if below > chance:
            return agree
    return POSITIONS


def candidate_links(classes: DataFrame, similarity: float, recall: float, limit: int, levels: int, slack: float) -> DataFrame:
    """(a, b) of classes that may be similar: a spanning forest of every bucket, not all pairs."""
    least = int((similarity - slack) * POSITIONS)
    runs = max(1, math.ceil(math.log(1 - recall) / math.log(1 / math.e))) if recall < 1 else POSITIONS
    rng = np.random.default_rng(20)
    chosen, extra = [], 1 / similarity - 1
    order = rng.permutation(POSITIONS).tolist()
    for r in range(runs):  # 1 / similarity positions a run on average, new ones as long as there are some
        for _ in range(1 + (rng.random() < extra)):
            chosen.append((r, order[len(chosen) % POSITIONS]))
    spare = max(1 - recall, 1e-9) / 2  # half for paths that end early, half for pairs that agree in few positions
    fan = children_needed(similarity, min(len(chosen), POSITIONS), levels, spare)
    schema = "a long, b long"

    def brute(batches):
        """Full comparison of whole buckets, a bucket's rows next to each other."""
        held, now = [], None

        def compare():
            table = pa.Table.from_batches(held)
            ids = table.column("cid").to_numpy()
            if len(ids) < 2:
                return None
            sigs = signatures(table.column("sig"))
            label = spanning(same(sigs, sigs) >= least)
            off = label != np.arange(len(ids))
            return pa.RecordBatch.from_arrays([pa.array(ids[label[off]]), pa.array(ids[off])], names=["a", "b"])
        for key, part in runs_by(batches, ["node"]):
            if key != now and held:
                if (got := compare()) is not None:
                    yield got
                held = []
            now = key
            held.append(part)
        if held and (got := compare()) is not None:
            yield got

    loose, sure = int((similarity - 0.3) * POSITIONS), math.ceil(similarity * POSITIONS)
    # What agrees enough with a settled class agrees so much with its pivot.
    doubt = sure + agreement_needed(similarity, spare) - POSITIONS

    def against_pivots(batches):
        """A bucket's classes against its pivots; ``label``: a class that it is joined to, the same for all that a chain of pivots joins."""
        for b in batches:
            n = b.num_rows
            mine = signatures(b.column("sig"))
            theirs = signatures(b.column("pivot_sig")).reshape(n, PIVOTS, POSITIONS)
            agree = (mine[:, None, :] == theirs).sum(axis=2)
            ids = b.column("pivots").flatten().to_numpy().reshape(n, PIVOTS)
            told = b.column("pivot_labels").flatten().to_numpy().reshape(n, PIVOTS)
            first, which = np.unique(b.column("node").to_numpy(), return_index=True, return_inverse=True)[1:]
            joined = np.stack([(theirs[first] == theirs[first, k, None]).sum(axis=2) >= loose for k in range(PIVOTS)], axis=1)
            joined |= told[first][:, :, None] == told[first][:, None, :]
            for _ in range(2):  # chains of all four
                joined = (joined[:, :, :, None] & joined[:, None, :, :]).any(axis=2)
            joined = joined[which]
            label = b.column("label").to_numpy()
            near = agree >= loose
            reach = (joined & (near | (told == label[:, None]))[:, :, None]).any(axis=1)
            label = np.where(reach.any(axis=1), np.where(reach, told, np.iinfo(np.int64).max).min(axis=1), label)
            # One link to all pivots that are joined; the pivots' own rows have the links that join them.
            earlier = (near[:, :, None] & joined & np.triu(np.ones((PIVOTS, PIVOTS), bool), 1)).any(axis=1)
            near &= ~earlier | (ids == b.column("cid").to_numpy()[:, None]).any(axis=1)[:, None]
            who, k = np.nonzero(near)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("cid"), pa.array(label), pa.array(agree.max(axis=1) >= sure),
                 pa.array(((agree >= doubt) & ~reach).any(axis=1)),
                 pa.ListArray.from_arrays(pa.array(exclusive_sum(near.sum(axis=1)), pa.int32()), pa.array(ids[who, k]))],
                names=["node", "cid", "label", "settled", "doubtful", "near"])

    sig = small_if(classes.select("cid", "sig"), SIGNATURES)
    paths = classes.select("cid", F.explode(F.array(*(F.xxhash64(F.lit(r), F.lit(p), token(p)) for r, p in chosen)))
                           .alias("node"), F.col("cid").alias("label"))
    links = []
    for level in range(levels + 1):
        # A bucket whose classes are all joined already has no link to find.
        sizes = (paths.groupBy("node").agg(F.count("*").alias("n"), (F.min("label") < F.max("label")).alias("parted"))
                 .filter("parted").drop("parted"))
        alive = staged(paths.join(sizes, "node"), f"join-paths-{level}")
        small = alive.filter(F.col("n") <= limit).join(sig, "cid").select("node", "cid", "sig")
        links.append(staged(small.repartition("node").sortWithinPartitions("node", "cid").mapInArrow(brute, schema), f"join-links-{level}"))
        large = alive.filter(F.col("n") > limit)
        rows = large.count()
        if not rows:
            break
        # From here on only these classes are compared; the others' signatures need no more shuffles.
        compared = large.select("cid")
        compared = F.broadcast(compared) if rows <= 500_000 else small_if(staged(compared.distinct(), f"join-open-{level}"))
        sig = small_if(staged(sig.join(compared, "cid", "left_semi"), f"join-signatures-{level}"), SIGNATURES)
        # The classes with the smallest hashes, so that buckets of one group tend to share their pivots.
        pivots = large.groupBy("node").agg(*(F.min_by(F.struct("cid", "label"), F.xxhash64("cid", F.lit(level * PIVOTS + k))).alias(f"m{k}")
                                             for k in range(PIVOTS)))
        pivots = pivots.select("node", F.posexplode(F.array(*(f"m{k}" for k in range(PIVOTS)))).alias("k", "m")).select("node", "k", "m.*")
        pivots = pivots.join(sig, "cid").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("k", "cid", "label", "sig"))).alias("p"))
        pivots = pivots.select("node", F.col("p.cid").alias("pivots"), F.col("p.label").alias("pivot_labels"),
                               F.concat(*(F.col("p.sig")[k] for k in range(PIVOTS))).alias("pivot_sig"))
        pivots = small_if(staged(pivots, f"join-pivots-{level}"), SIGNATURES // PIVOTS)
        judged = staged(large.join(sig, "cid").join(pivots, "node").select("node", "cid", "label", "sig", "pivots", "pivot_labels", "pivot_sig")
                        .mapInArrow(against_pivots, "node long, cid long, label long, settled boolean, doubtful boolean, near array<long>"),
                        f"join-judged-{level}")
        # Only classes that are not joined yet have links to find, where one of the two is open.
        open_ = F.expr("doubtful or not settled")
        parts = judged.groupBy("node", "label").agg(F.count("*").alias("n"), *(F.count_if(c).alias(x) for x, c in (
            ("open", open_), ("settled", F.col("settled")), ("doubtful", F.col("doubtful")))))
        parts = parts.groupBy("node").agg(F.max_by(F.struct("label", "open"), "n").alias("main"), F.max("n").alias("largest"),
                                          *(F.sum(x).alias(x) for x in ("n", "open", "settled", "doubtful")))
        parts = staged(parts.withColumn("others", F.expr("n - largest")).filter("others > 0 and open > 0"), f"join-parts-{level}")
        # Further splits are worth their shuffle only where blocks alone would be many.
        most = parts.filter(F.col("others") > 8 * limit).agg(F.max(F.expr("n - settled"))).first()[0]
        last = not most or level == levels or most <= 8 * limit
        if not last:
            pairs = _block_counts(parts, limit, True).agg(F.sum(F.expr("asks * told + asks_in * told_in"))).first()[0]
            last = (pairs or 0) <= BLOCK_PAIRS
        parted = judged.join(small_if(_block_counts(parts, limit, last)), "node").withColumn("open", open_)
        # Written level by level: one plan of all levels takes hundreds of MB of the driver.
        met = _blocks(parted, sig, least, last)
        links.append(staged(judged.select(F.explode("near").alias("a"), F.col("cid").alias("b")).filter("a <> b").union(met),
                            f"join-met-{level}"))
        if last:
            break
        # Distinct positions, as an odd step is no divisor of their number.
        part = 10_000
        picks = F.expr(f"transform(sequence(1, {int(fan)} + int(pmod(xxhash64(node, 0), {part}) < {int(part * (fan % 1))})), "
                       f"k -> int(pmod(pmod(xxhash64(node, 1), {POSITIONS}) + k * (2 * pmod(xxhash64(node, 2), {POSITIONS // 2}) + 1), "
                       f"{POSITIONS})))")
        rest = judged.filter("not settled").join(small_if(parts.filter(F.col("others") > 8 * limit).select("node")), "node", "left_semi")
        children = rest.select("node", "cid", "label", picks.alias("picks")).join(sig, "cid").select(
            "node", "cid", "label", "sig", F.explode("picks").alias("p"))
        paths = children.select("cid", F.xxhash64("node", "p", token("p")).alias("node"), "label")
    out = links[0]
    for x in links[1:]:
        out = out.union(x)
    # A class has many links to the pivots of its group: next to those of other classes, few of them join something new.
    return staged(out.repartition("b").distinct().sortWithinPartitions("b").mapInArrow(forest, schema), "join-candidates")


def _block_counts(parts: DataFrame, limit: int, last: bool) -> DataFrame:
    """node, main, few and the numbers of blocks of those that ask and of those that are told (``asks``, ``told``).

    Where ``few`` are outside a bucket's largest part, what is open outside asks
    all, and what is open inside asks the settled ones outside (``asks_in``,
    ``told_in``). Else, at the last level, what is open asks all; before it, the
    doubtful ask the settled ones, which go no further: what may be similar to
    one and has no link to its pivot meets it here, the others split again.
    """
    outside = "open - main.open"
    told = "n" if last else "if(few, n, settled)"
    asks = f"if(few, {outside}, {'open' if last else 'doubtful'})"
    counts = {"asks": asks, "told": told, "asks_in": "if(few, main.open, 0)", "told_in": f"if(few, others - ({outside}), 0)"}
    sized = parts.withColumn("few", F.col("others") <= 8 * limit).select(
        "node", F.col("main.label").alias("main"), "few",
        *(F.ceil(F.expr(n) / (8 * limit)).cast("int").alias(x) for x, n in counts.items()))
    return sized.filter("asks > 0 and told > 0 or asks_in > 0 and told_in > 0")


def _blocks(parted: DataFrame, sig: DataFrame, least: int, last: bool) -> DataFrame:
    """Links of the classes that ask to those that are told (:func:`_block_counts`), block by block."""
    place = lambda n: f"int(pmod(xxhash64(cid), {n}))"

    def units(node, asks, told, a, t):
        """A class that asks meets all blocks of those told, and the other way round."""
        none = "array()"
        both = f"{a} > 0 and {t} > 0"
        return [f"if({both} and {asks}, transform(sequence(0, {t} - 1), k -> struct({node} as node, {place(a)} as block, k as other, 1 as asks)), {none})",
                f"if({both} and {told}, transform(sequence(0, {a} - 1), k -> struct({node} as node, k as block, {place(t)} as other, 0 as asks)), {none})"]
    every = units("node", f"if(few, open and label <> main, {'open' if last else 'doubtful'})", "true" if last else "(few or settled)", "asks", "told")
    every += units("xxhash64(node, 'inside')", "few and open and label = main", "few and not open and label <> main", "asks_in", "told_in")
    units = parted.select("cid", F.explode(F.expr(f"concat({', '.join(every)})")).alias("unit")).select("unit.*", "cid")

    def run(batches):
        held, now = [], None
        for key, part in runs_by(batches, ["node", "block", "other"]):
            if key != now and held:
                yield from compare(held)
                held = []
            now = key
            held.append(part)
        if held:
            yield from compare(held)

    def compare(held):
        table = pa.Table.from_batches(held)
        ids, asks, sigs = (table.column("cid").to_numpy(), table.column("asks").to_numpy().astype(bool),
                           signatures(table.column("sig")))
        if asks.any() and not asks.all():
            linked = same(sigs[asks], sigs[~asks]) >= least
            linked &= ids[asks][:, None] != ids[~asks][None, :]
            n = int(asks.sum())
            both = np.concatenate([ids[asks], ids[~asks]])
            full = np.zeros((len(both), len(both)), bool)
            full[:n, n:], full[n:, :n] = linked, linked.T
            label = spanning(full)
            off = label != np.arange(len(both))
            yield pa.RecordBatch.from_arrays([pa.array(both[label[off]]), pa.array(both[off])], names=["a", "b"])
    keys = ["node", "block", "other"]
    return (units.join(sig, "cid").select(*keys, "cid", "asks", "sig").repartition(*keys)
            .sortWithinPartitions(*keys, "cid").mapInArrow(run, "a long, b long"))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of the sets of two blocks."""
    if len(left) * len(right) <= 64:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])
    flat = np.concatenate([*left, *right])
    kinds, where, times = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[where]  # what one set alone has is in no intersection
    who = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    who, column = who[column >= 0], column[column >= 0]
    out = np.zeros((len(left), len(right)), np.float64)
    step = 8192
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    for lo in range(0, int((times > 1).sum()), step):
        a, z = np.searchsorted(column, [lo, lo + step])
        dense = np.zeros((len(left) + len(right), step), np.float32)
        dense[who[a:z], column[a:z] - lo] = 1
        out += dense[:len(left)] @ dense[len(left):].T
    return np.rint(out).astype(np.int64)


def exact_links(groups: DataFrame, sets: DataFrame, similarity: float, block: int) -> DataFrame:
    """cid, to (smallest linked class of the task's component), links, linked_docs: sums over tasks are exact.

    ``groups``: label, cid, copies; ``sets``: cid, items. A group larger than a
    block is compared block pair by block pair.
    """
    sized = groups.join(groups.groupBy("label").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "label")
    own = sized.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # Block i meets every block j >= i: as "lo" of (i, j) and as "hi" of (h, i).
    spread = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = spread.select("label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                          (F.col("block") <= F.col("other")).alias("lo"), "cid", "copies")

    def run(batches):
        held, now = [], None
        for key, part in runs_by(batches, ["label", "i", "j"]):
            if key != now and held:
                yield from compare(now, held)
                held = []
            now = key
            held.append(part)
        if held:
            yield from compare(now, held)

    def compare(key, held):
        table = pa.Table.from_batches(held)
        ids, copies = table.column("cid").to_numpy(), table.column("copies").to_numpy()
        items = [np.frombuffer(x, np.uint64) for x in table.column("items").to_pylist()]
        size = np.array([len(x) for x in items])
        lo = table.column("lo").to_numpy(zero_copy_only=False)
        left = np.flatnonzero(lo)
        right = left if key[1] == key[2] else np.flatnonzero(~lo)
        if not len(left) or not len(right):
            return
        both = shared_counts([items[k] for k in left], [items[k] for k in right])
        union = size[left][:, None] + size[right][None, :] - both
        linked = (union > 0) & (both >= similarity * union - 1e-9) & (ids[left][:, None] != ids[right][None, :])
        full = np.zeros((len(ids), len(ids)), bool)
        full[np.ix_(left, right)] |= linked
        full[np.ix_(right, left)] |= linked.T
        label = spanning(full)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(ids[label]), pa.array(full.sum(axis=1)), pa.array(full.astype(np.int64) @ copies)],
            names=["cid", "to", "links", "linked_docs"])
    keys = ["label", "i", "j"]
    return staged(small_if(staged(units, "join-units")).join(sets, "cid").select(*keys, "lo", "cid", "copies", "items").repartition(*keys)
                  .sortWithinPartitions(*keys, "cid")
                  .mapInArrow(run, "cid long, to long, links long, linked_docs long"), "join-exact")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", similarity: float = 0.8, width: int = 5,
                    recall: float = 0.9999, limit: int = 64, levels: int = 6, slack: float = 0.25, block: int = 512) -> DataFrame:
    """One row per document: id, class_id, n_links, n_text_links, first.

    class_id: smallest id among the documents joined by chains of links;
    n_links: other documents of similarity ``similarity`` or more, copies
    included; n_text_links: different sets among them; first: true for exactly
    one document of each class, the one with the smallest id.
    """
    if not 0 < slack < similarity <= 1:
        raise ValueError("similarity must be above slack and at most 1")
    sketch = sketches(docs, id_col, width)
    # Of each class its first row, and its smallest id (null: larger than all) with that id's first row.
    named = sketch.groupBy("name_a", "name_b").agg(
        F.min(F.struct("row", "size", "sig", "id")).alias("of"), F.count("*").alias("copies"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("least"))
    classes = staged(named.select("name_a", "name_b", "copies", "least", F.col("of.row").alias("cid"), "of.size", "of.sig",
                                  F.col("of.id").alias("source")), "join-classes")
    links = candidate_links(classes.filter("size > 0"), similarity, recall, limit, levels, slack)
    groups = small_if(components(links).withColumnRenamed("node", "cid"))
    groups = staged(classes.select("cid", "copies", "least", "name_a", "name_b", "source").join(groups, "cid"), "join-groups")

    def collect_sets(batches):
        for batch in batches:
            for rows in text_slices(batch, "text"):
                flat, offsets = shingle_sets(rows.column("text"), width)
                a, b = set_names(flat, offsets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array([flat[x:y].tobytes() for x, y in zip(offsets, offsets[1:])], pa.binary())],
                    names=["name_a", "name_b", "items"])
    # Texts of the classes that are in a group: the document whose sketch the class has taken.
    wanted = small_if(groups.select("source"))
    source = docs.select(F.col(id_col).cast("long").alias("source"), text_column().alias("text"))
    texts = source.join(wanted, source["source"].eqNullSafe(wanted["source"]), "left_semi")
    sets = texts.mapInArrow(collect_sets, "name_a long, name_b long, items binary")
    sets = staged(sets.join(small_if(groups.select("cid", "name_a", "name_b")), ["name_a", "name_b"])
                  .select("cid", "items").dropDuplicates(["cid"]), "join-sets")
    exact = exact_links(groups.select("label", "cid", "copies"), sets, similarity, block)
    final = components(exact.filter("cid <> to").select(F.col("cid").alias("a"), F.col("to").alias("b")))
    # Classes in groups; all others are alone with their copies.
    counted = exact.groupBy("cid").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    members = staged(counted.join(small_if(final.withColumnRenamed("node", "cid")), "cid", "left")
                     .join(small_if(groups.select("cid", "least")), "cid").withColumn("label", F.coalesce("label", "cid")), "join-members")
    heads = staged(members.groupBy("label").agg(F.min("least").alias("head")), "join-heads")
    members = members.join(small_if(heads), "label").select("cid", "head", "links", "linked_docs")
    per_class = classes.select("name_a", "name_b", "cid", "least", "copies").join(small_if(members), "cid", "left").select(
        "name_a", "name_b", F.coalesce("head", "least").alias("head"),
        (F.col("copies") - 1 + F.coalesce("linked_docs", F.lit(0))).alias("n_links"),
        F.coalesce("links", F.lit(0)).alias("n_text_links"))
    # Exactly one row of a class is its first: the first of those with its smallest id.
    return sketch.select("row", "id", "name_a", "name_b").join(small_if(per_class, 100_000), ["name_a", "name_b"]).select(
        F.col("id").alias(id_col), F.col("head.id").alias("class_id"), "n_links", "n_text_links",
        (F.col("row") == F.col("head.row")).alias("first"))
