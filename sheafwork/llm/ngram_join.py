"""N-gram Jaccard join by T-occurrence search.

A document is the set of its distinct word shingles. Documents with equal sets are one node, which takes
care of exact copies. Two nodes link when 100 * intersection >= ``percent`` * union.

0. **Loners.** Of linked sets each has ``percent`` of its shingles in the other. So the shingles of one range of
   hashes (a sample, the same for all sets) are counted: a set that has more of them to itself than it may have in all
   can't link, and takes no further part. Without this, sets that share a few shingles by chance would be tied
   into groups that grow with the table, until nearly all texts are in one.
1. **Routing.** A link bounds how many shingles two sets don't share. A set's sorted hash range is cut
   into one part more than that (and some, for parts that hold nothing), so two linked sets agree on a
   whole part at least. Every part's digest is a routing key; sizes are cut into classes, and a set is
   routed in its own class and the one below, so that the number of parts is the same for both. Keys
   are deduplicated in every task before the exchange, in which a key that a third of all rows
   share then has one entry per task. Nodes with an equal key are tied in a star, not paired.
2. **Groups.** Components of these stars are the groups within which links are searched. A group is cut
   into blocks of bounded size. Every block also holds the group's pivots, a few of its nodes.
3. **Search.** In a block, each set looks up its inverted lists, without sets too small or too large for a link: the
   short ones are merged by a heap, what is in too few of them is skipped, and the long ones are probed by binary
   search for each survivor (DivideSkip). Nodes already known to be connected need no second link.
4. **The rest.** Where blocks of a group stay unconnected, a node can only link outside its class if enough of its
   shingles occur in other classes. That is counted once over all open groups, by ranges of shingles; nodes with too
   few are done. What is left meets in blocks once more, dealt by the greatest shingle instead of the least (linked
   sets mostly share both), and is counted again. Of what is left then, nodes outside the largest class of a group
   are compared with all its blocks, block by block, until every pair of different classes is searched.

Components of the links found are exact: only pairs that are connected anyway are left out.

Defined results: lower case for A-Z only; with fewer words than a shingle, the whole sequence is the
one shingle; a null or wordless text has an empty set, links with nothing and is its own component;
repeated rows (equal ids) are one document; a row without id stays, with its own set and no component;
very long texts are read whole; an empty table gives an empty table; extra columns are ignored.
Shingles, sets and routing keys are compared by 64-bit hashes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from .components import components
from .frugal import over_batches, over_table
from .packed import from_planes, pack, part_bits, planes, unpack
from .presence import told_apart
from .words import batch_words, gram_hashes, mix, slices

WORDS, PERCENT = 4, 85
# Shingles in a block, and pivots of a group that is cut into blocks (on average).
BLOCK, PIVOTS = 400_000, 200
# Routing keys a task gathers before it sends what it has.
GATHERED = 2_000_000
SLICE = 1 << 21
# Shingles whose classes are counted together: texts of one chunk, and shingles of one range.
CHUNK = 1_000_000
# Weight of a probe against a merge step, in the choice of how many lists are long. Both are a few operations on whole
# arrays here; in a block of 1,090 documents that share much, 0.01, 0.1 and 1 took 7.4, 6.9 and 8.0 s.
PROBE_WEIGHT = 0.1
# Shingles that are counted to find loners, as times what a set may have to itself: sets with half of their shingles in
# no other are left out.
SAMPLED = 2
# Bits of a shingle's and of a node's hash that are compared there. Equal ones of different shingles let more sets pass.
KEY_BITS, NAME_BITS = 44, 40
_U = np.uint64


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text."""
    words, starts = batch_words(column, lower=True)
    grams = gram_hashes(words, n)
    sets = []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= n:
            sets.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            sets.append(gram_hashes(words[a:b], int(b - a)) + _U(b - a))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def digest(shingles: np.ndarray) -> int:
    """Node number of a set, as a signed 64-bit number."""
    h = mix(np.cumsum(mix(shingles), dtype=np.uint64)[-1:] * _U(3) + _U(len(shingles)))
    return int(h.view(np.int64)[0])


class Routing:
    """Size classes and numbers of parts for a threshold of ``percent``."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]
        self.schemes: list[tuple[int, int, np.ndarray] | None] = []

    def _until(self, size: int) -> None:
        while self.low[-1] <= size:
            self.low.append(max(self.low[-1] + 1, 100 * self.low[-1] // self.percent + 1))

    def _scheme(self, k: int) -> tuple[int, int, np.ndarray] | None:
        """Parts, allowed empty parts, and the parts' borders, for links inside class k or with k + 1."""
        while len(self.schemes) <= k:
            i = len(self.schemes)
            self._until(self.low[i])
            small = self.low[i + 1] - 1
            differ = (100 - self.percent) * (small + 100 * small // self.percent) // (100 + self.percent)
            spare = 2 + differ // 16
            parts = differ + 1 + spare
            borders = (np.arange(1, parts, dtype=np.float64) / parts * 2.0**64).astype(np.uint64)
            # Without a difference, linked sets are equal and one node already.
            self.schemes.append((parts, spare, borders) if differ else None)
        return self.schemes[k]

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Routing keys of a set."""
        size = len(shingles)
        self._until(size)
        own = int(np.searchsorted(self.low, size, side="right")) - 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles), dtype=np.uint64)])
        found = []
        for k in (own - 1, own):
            scheme = self._scheme(k) if k >= 0 else None
            if scheme is None:
                continue
            parts, spare, borders = scheme
            cuts = np.concatenate([[0], np.searchsorted(shingles, borders), [size]])
            empty = cuts[1:] == cuts[:-1]
            keys = (sums[cuts[1:]] - sums[cuts[:-1]]) * _U(5) + np.arange(parts, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
            # At most ``spare`` parts are empty as a rule, so one more agreeing part holds something. Only
            # where both sets have more, they may agree on empty parts alone, and route by these too.
            keys = mix(keys + mix(np.array([k], np.uint64)))
            found.append(keys if empty.sum() > spare else keys[~empty])
        return np.concatenate(found) if found else np.empty(0, np.uint64)


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys with their least node, and edges from every other node of a key to it."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, bool)
    head = nodes[first][np.cumsum(first) - 1] if len(keys) else nodes
    other = head != nodes
    edges = np.unique(np.stack([nodes[other], head[other]], axis=1), axis=0) if other.any() else np.empty((0, 2), np.int64)
    return keys[first], nodes[first], edges[:, 0], edges[:, 1]


def candidate_edges(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Edges ``a``, ``b`` between nodes that share a routing key."""
    bits = part_bits(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    @over_batches
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routing = Routing(percent)
        keys, nodes, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not keys:
                return
            k, v, a, b = _stars(np.concatenate(keys), np.concatenate(nodes))
            cuts = np.searchsorted(k, np.arange(1 << bits, dtype=np.uint64) << _U(64 - bits))
            shares = np.linspace(0, len(a), (1 << bits) + 1).astype(np.int64)
            for part, (i, j) in enumerate(zip(cuts, np.append(cuts[1:], len(k)))):
                # Edges found here have nothing to do with the part; they only travel along.
                e = slice(shares[part], shares[part + 1])
                columns = [[part], [pack(k[i:j])], [v[i:j].tobytes()], [a[e].tobytes()], [b[e].tobytes()]]
                kinds = (pa.int32(), *[pa.binary()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "keys", "nodes", "a", "b"])

        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                for shingles in shingle_sets(piece.column("text"), n):
                    if len(shingles):
                        own = routing.keys(shingles)
                        keys.append(own)
                        nodes.append(np.full(len(own), digest(shingles)))
                        held += len(own)
                if held > GATHERED:
                    yield from flush()
                    keys, nodes, held = [], [], 0
        yield from flush()

    @over_table
    def tie(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).to_pylist()
        keys = np.concatenate([unpack(k) for k in column("keys")])
        nodes = np.concatenate([np.frombuffer(v, np.int64) for v in column("nodes")])
        _, _, a, b = _stars(keys, nodes)
        near = [np.concatenate([own, *[np.frombuffer(x, np.int64) for x in column(name)]]) for own, name in ((a, "a"), (b, "b"))]
        edges = np.unique(np.stack(near, axis=1), axis=0)
        return pa.table({"a": edges[:, 0], "b": edges[:, 1]})

    routed = docs.select("text").mapInArrow(route, "part int, keys binary, nodes binary, a binary, b binary")
    return routed.groupBy("part").applyInArrow(tie, "a bigint, b bigint")


def _sampled(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Ascending distinct keys of a set's shingles in the sample, which is the lower end of the hashes."""
    share = SAMPLED * (100 - percent)
    if share < 100:
        shingles = shingles[: np.searchsorted(shingles, _U((share << 64) // 100))]
    return np.unique(shingles >> _U(64 - KEY_BITS))


def _cuts(values: np.ndarray, bits: int, of: int) -> np.ndarray:
    """Borders of the parts (by the leading ``bits``) of ascending numbers of ``of`` bits."""
    return np.append(np.searchsorted(values, np.arange(1 << bits, dtype=np.uint64) << _U(of - bits)), len(values))


def _added(names: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, at = np.unique(names, return_inverse=True)
    return own, np.bincount(at, values, len(own)).astype(np.int64)


def able_nodes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``node`` of the sets that may link: all that do, and those the sample of their shingles doesn't rule out.

    A task sends its sampled shingles, each with its node, or once if several of the task's nodes have it, and a balance per
    node: the shingles known to be in several nodes, less those that have to be. Ranges of shingles add what they find.
    A node that comes from several tasks has all of this as often, so that the sign of its sum stays.
    """
    bits = part_bits(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Sums are a small part of what is sent, so they are in fewer parts.
    sum_bits = bits - 2
    strip = _U(64 - NAME_BITS)

    @over_batches
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, needs, held = {}, {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not sets:
                return
            nodes = np.fromiter(sets, np.int64, len(sets)).view(np.uint64)
            sizes = np.array([len(s) for s in sets.values()])
            owner = np.repeat(np.arange(len(nodes)), sizes)
            every = np.concatenate(list(sets.values()))
            order = np.argsort(every, kind="stable")
            every, owner = every[order], owner[order]
            first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.empty(0, np.int64)
            # A set has a key once, so a key that comes again is in another set.
            mixed = np.diff(np.append(first, len(every))) > 1
            known = np.bincount(owner[np.repeat(mixed, np.diff(np.append(first, len(every))))], minlength=len(nodes))
            balance = known - np.fromiter(needs.values(), np.int64, len(nodes))
            keys, names = every[first], nodes[owner[first]] >> strip
            cuts = _cuts(keys, bits, KEY_BITS)
            shares = np.linspace(0, len(nodes), (1 << bits) + 1).astype(np.int64)
            for part, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
                # Balances have nothing to do with the part; they only travel along.
                e = slice(shares[part], shares[part + 1])
                if i == j and e.start == e.stop:
                    continue
                flags = np.packbits(mixed[i:j]).tobytes()
                columns = [[part], [pack(keys[i:j])], [planes(names[i:j])], [flags], [nodes[e].tobytes()], [balance[e].tobytes()]]
                kinds = (pa.int32(), *[pa.binary()] * 5)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "keys", "names", "mixed", "nodes", "balance"]
                )

        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                for shingles in shingle_sets(piece.column("text"), n):
                    if len(shingles) and (node := digest(shingles)) not in sets:
                        sets[node] = _sampled(shingles, percent)
                        needs[node] = len(sets[node]) - (100 - percent) * len(shingles) // 100
                        held += len(sets[node])
                if held > GATHERED:
                    yield from flush()
                    sets, needs, held = {}, {}, 0
        yield from flush()

    @over_table
    def count(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).to_pylist()
        parts = [unpack(k) for k in column("keys")]
        keys = np.concatenate(parts)
        names = np.concatenate([from_planes(x, np.uint64) for x in column("names")])
        mixed = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(column("mixed"), parts)]).astype(bool)
        order = np.argsort(keys, kind="stable")
        keys, names, mixed = keys[order], names[order], mixed[order]
        _, _, shared = _mixed(keys, names, mixed)
        lengths = np.diff(np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))) if len(keys) else np.empty(0, np.int64)
        seen = names[np.repeat(shared, lengths) & ~mixed]
        seen, counts = _added(seen, np.ones(len(seen)))
        nodes = np.concatenate([np.frombuffer(x, np.uint64) for x in column("nodes")])
        nodes, balance = _added(nodes, np.concatenate([np.frombuffer(x, np.int64) for x in column("balance")]))
        rows = {name: [] for name in ("part", "names", "counts", "nodes", "balance")}
        by_name, by_node = _cuts(seen, sum_bits, NAME_BITS), _cuts(nodes, sum_bits, 64)
        for part in np.flatnonzero((by_name[1:] > by_name[:-1]) | (by_node[1:] > by_node[:-1])):
            a, b = slice(by_name[part], by_name[part + 1]), slice(by_node[part], by_node[part + 1])
            values = (part, pack(seen[a]), planes(counts[a]), nodes[b].tobytes(), balance[b].tobytes())
            for name, value in zip(rows, values):
                rows[name].append(value)
        kinds = (pa.int32(), *[pa.binary()] * 4)
        return pa.table({name: pa.array(column, kind) for (name, column), kind in zip(rows.items(), kinds)})

    @over_table
    def judge(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).to_pylist()
        names = np.concatenate([unpack(x) for x in column("names")])
        seen, counts = _added(names, np.concatenate([from_planes(x, np.int64) for x in column("counts")]))
        nodes = np.concatenate([np.frombuffer(x, np.uint64) for x in column("nodes")])
        nodes, balance = _added(nodes, np.concatenate([np.frombuffer(x, np.int64) for x in column("balance")]))
        own = nodes >> strip
        if len(seen):
            at = np.minimum(np.searchsorted(seen, own), len(seen) - 1)
            balance = balance + np.where(seen[at] == own, counts[at], 0)
        # Nodes with one name can't be told apart; what is counted for one of them may be missing at the other.
        twin = own[1:] == own[:-1]
        able = (balance >= 0) | np.append(False, twin) | np.append(twin, False) if len(own) else np.empty(0, bool)
        return pa.table({"node": nodes[able].view(np.int64)})

    sent = docs.select("text").mapInArrow(send, "part int, keys binary, names binary, mixed binary, nodes binary, balance binary")
    counted = sent.groupBy("part").applyInArrow(count, "part int, names binary, counts binary, nodes binary, balance binary")
    return counted.groupBy("part").applyInArrow(judge, "node bigint")


def _able_docs(docs: DataFrame, named: DataFrame, n: int, percent: int) -> DataFrame:
    """One document (``doc_id``, ``text``) per set that may link, that of the least id."""
    able = staged(able_nodes(docs, n, percent), "able-nodes")
    first = named.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    ids = staged(first.join(able, "node").select("doc_id").distinct(), "able-ids")
    texts, _ = told_apart(docs.select("doc_id", "text"), F.col("doc_id"), ids)
    return staged(texts.join(ids, "doc_id", "left_semi"), "able-texts")


class Block:
    """Sets of a block with their inverted lists, and classes of connected nodes."""

    def __init__(self, sets: list[np.ndarray], classes: np.ndarray, percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.classes = classes.copy()
        every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.tokens, rank = np.unique(every, return_inverse=True)
        order = np.lexsort((owner, rank))
        self.lists = owner[order]
        self.offsets = np.searchsorted(rank[order], np.arange(len(self.tokens) + 1))
        # Lists one after the other, with the list's number in front: one ascending array to probe in.
        self.probe = rank[order] * len(sets) + self.lists

    def search(self, shingles: np.ndarray, own_class: int, limit: int) -> Iterator[int]:
        """Sets before ``limit``, outside ``own_class``, that link with ``shingles``."""
        size = len(shingles)
        need = -(-self.percent * size // 100)
        numbers = self._numbers(shingles)
        if len(numbers) < need:
            return
        lengths = self.offsets[numbers + 1] - self.offsets[numbers]
        by_length = numbers[np.argsort(lengths, kind="stable")]
        n_long = min(int(need / (PROBE_WEIGHT * np.log2(int(lengths.max()) + 1) + 1)), need - 1)
        short, long = by_length[: len(by_length) - n_long], by_length[len(by_length) - n_long :]
        for candidate, count in merged(self._open(short, own_class, limit, size), need - n_long):
            total = count + self._probed(long, candidate)
            other = int(self.sizes[candidate])
            if 100 * total >= self.percent * (size + other - total):
                yield candidate

    def _numbers(self, shingles: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.tokens, shingles)
        at[at == len(self.tokens)] = 0
        return at[self.tokens[at] == shingles] if len(self.tokens) else at[:0]

    def _open(self, numbers: np.ndarray, own_class: int, limit: int, size: int) -> list[np.ndarray]:
        """The lists without what is at or after ``limit``, of the own class, or of a size that can't link with
        ``size``; empty ones left out."""
        lengths = self.offsets[numbers + 1] - self.offsets[numbers]
        ends = np.cumsum(lengths)
        members = self.lists[np.arange(lengths.sum()) + np.repeat(self.offsets[numbers] - ends + lengths, lengths)]
        others = self.sizes[members]
        keep = (members < limit) & (self.classes[members] != own_class)
        keep &= (100 * others >= self.percent * size) & (100 * size >= self.percent * others)
        cuts = np.cumsum(np.bincount(np.repeat(np.arange(len(numbers)), lengths)[keep], minlength=len(numbers)))
        return [x for x in np.split(members[keep], cuts[:-1]) if len(x)]

    def _probed(self, long: np.ndarray, candidate: int) -> int:
        wanted = long * len(self.sets) + candidate
        at = np.searchsorted(self.probe, wanted)
        at[at == len(self.probe)] = 0
        return int((self.probe[at] == wanted).sum())


def merged(lists: list[np.ndarray], least: int) -> Iterator[tuple[int, int]]:
    """Numbers found in ``least`` lists or more, with how many: the lists lie in a heap by length, and the two
    shortest are merged until one is left."""
    heap = [(len(x), i, x) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, short = heapq.heappop(heap)
        _, _, other = heap[0]
        # A stable sort of two ascending runs is one merge.
        both = np.sort(np.concatenate([short, other]), kind="stable")
        heapq.heapreplace(heap, (len(both), i, both))
    if not heap:
        return
    values = heap[0][2]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    counts = np.diff(np.append(first, len(values)))
    enough = counts >= least
    yield from zip(values[first[enough]].tolist(), counts[enough].tolist())


def linked_classes(nodes: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Least node each node is connected with by links inside the block."""
    order = np.lexsort((nodes, [len(s) for s in sets]))
    block = Block([sets[i] for i in order], np.arange(len(order)), percent)
    for i, shingles in enumerate(block.sets):
        # After a link, lists are opened anew without the class just joined.
        while (found := next(block.search(shingles, int(block.classes[i]), i), None)) is not None:
            block.classes[block.classes == block.classes[found]] = block.classes[i]
    least = np.full(len(order), np.iinfo(np.int64).max)
    np.minimum.at(least, block.classes, nodes[order])
    classes = np.empty(len(order), np.int64)
    classes[order] = least[block.classes]
    return classes


def crossing_links(
    asked: list[tuple[int, np.ndarray]], held: list[tuple[int, np.ndarray]], percent: int
) -> list[tuple[int, int]]:
    """Classes tied by links between ``asked`` and ``held``, lists of (class, set)."""
    names, classes = np.unique([c for c, _ in [*held, *asked]], return_inverse=True)
    now = np.arange(len(names))
    block = Block([s for _, s in held], classes[: len(held)], percent)
    links = []
    for (name, shingles), own in zip(asked, classes[len(held) :]):
        while (found := next(block.search(shingles, int(now[own]), len(held)), None)) is not None:
            joined = block.classes[found]
            links.append((int(name), int(names[joined])))
            block.classes[block.classes == joined] = now[own]
            now[now == joined] = now[own]
    return links


def nodes_of(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``node`` (null for an empty set), least and greatest shingle of every row."""

    @over_batches
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                sets = shingle_sets(piece.column("text"), n)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([digest(s) if len(s) else None for s in sets], pa.int64()),
                        *[pa.array([int(s[end].view(np.int64)) if len(s) else None for s in sets], pa.int64()) for end in (0, -1)],
                    ],
                    names=["doc_id", "n_shingles", "node", "low", "high"],
                )

    return docs.select("doc_id", "text").mapInArrow(name, "doc_id bigint, n_shingles bigint, node bigint, low bigint, high bigint")


def _dealt(rows: DataFrame, end: str) -> DataFrame:
    """``rows`` (``unit``, ``n``, ``node``) with ``block`` and ``blocks`` of their unit, by the shingle in ``end``.

    Of linked sets most share the least shingle, and most the greatest, so they mostly meet in one block. Nodes of
    one shingle that are too many for a block are cut by their number.
    """
    per_key = rows.groupBy("unit", end).agg(F.sum("n").alias("_k")).withColumn("_pieces", F.ceil(F.col("_k") / BLOCK))
    crowded = staged(per_key.filter("_pieces > 1").select("unit", end, "_pieces"), "crowded-shingles")
    sizes = staged(rows.groupBy("unit").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks")), "unit-sizes")
    piece = F.pmod(F.xxhash64("node"), F.coalesce("_pieces", F.lit(1)))
    placed = rows.join(sizes, "unit").join(crowded, ["unit", end], "left")
    return placed.withColumn("block", F.pmod(F.xxhash64(end, piece), F.col("blocks")).cast("int")).drop("_pieces")


def _members(docs: DataFrame, named: DataFrame, groups: DataFrame) -> DataFrame:
    """Nodes of groups with their text, block and number of blocks: ``node``, ``unit``, ``block``,
    ``blocks``, ``pivot``, ``text``. Groups that fit into one block share units."""
    least = [F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")]
    speakers = named.filter("node IS NOT NULL").groupBy("node").agg(*least)
    members = staged(groups.join(speakers, "node").withColumnRenamed("component", "group"), "members")
    sizes = members.groupBy("group").agg(F.sum("n").alias("_n"), F.count("*").alias("_nodes"))
    sizes = staged(sizes.withColumn("blocks", F.ceil(F.col("_n") / BLOCK).cast("int")), "group-sizes")
    small = sizes.filter("blocks = 1").agg(F.sum("_n").alias("n")).first()["n"] or 0
    units = small // BLOCK + 1
    alone = F.col("blocks") == 1
    drawn = F.pmod(F.xxhash64("node", F.lit("pivot")), F.lit(1 << 20)) / float(1 << 20)
    told = ["node", "doc_id", "n", "low", "high"]
    known = members.join(sizes, "group")
    few = known.filter(alone).select(
        *told, F.pmod(F.xxhash64("group"), F.lit(units)).alias("unit"), "blocks", F.lit(-1).alias("block"), F.lit(False).alias("pivot")
    )
    many = known.filter(~alone).select(*told, F.col("group").alias("unit"), (drawn < PIVOTS / F.col("_nodes")).alias("pivot"))
    placed = few.unionByName(_dealt(many, "low"))
    # Documents outside all groups are not exchanged.
    texts, _ = told_apart(docs.select("doc_id", "text"), F.col("doc_id").cast("bigint"), members.select("doc_id"))
    return placed.join(texts, "doc_id").drop("doc_id")


def _sets(table: pa.Table, n: int) -> tuple[np.ndarray, list[np.ndarray], pa.Table]:
    """Nodes of a block and their sets, once each, and the rows they came from."""
    nodes = table.column("node").to_numpy()
    sets = [s for chunk in table.column("text").chunks for s in shingle_sets(chunk, n)]
    # An id may come with several texts; only the node's own counts.
    own = np.array([i for i, s in enumerate(sets) if len(s) and digest(s) == nodes[i]], np.int64)
    own = own[np.unique(nodes[own], return_index=True)[1]]
    return nodes[own], [sets[i] for i in own], table.take(own)


def _runs(sets: list[np.ndarray], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of sets, the least class each is in, and whether it is in others as well."""
    every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(classes, [len(s) for s in sets])
    return _mixed(every, owner, np.zeros(len(every), bool))


def _mixed(shingles: np.ndarray, classes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(shingles, kind="stable")
    shingles, classes, known = shingles[order], classes[order], known[order]
    if not len(shingles):
        return shingles, classes, known
    first = np.flatnonzero(np.append(True, shingles[1:] != shingles[:-1]))
    least, most = np.minimum.reduceat(classes, first), np.maximum.reduceat(classes, first)
    return shingles[first], least, (least != most) | np.logical_or.reduceat(known, first)


def still_open(rest: DataFrame, n: int, percent: int) -> DataFrame:
    """``node`` of the rows (``node``, ``class``, ``text``, ``n`` shingles) that may link outside their class.

    Texts are taken together by chunks of some ``CHUNK`` shingles. Every chunk sends each of its shingles once, with its
    class, to the range the shingle is in, so a shingle of very many texts has one entry per chunk; the range
    answers with those that are in several classes.
    """
    total = rest.agg(F.sum("n").alias("n")).first()["n"] or 0
    ranges = 1 << max(1, (total // CHUNK).bit_length())
    chunked = rest.select("node", "class", "text", F.pmod(F.xxhash64("node", F.lit("count")), F.lit(total // CHUNK + 1)).alias("chunk"))

    @over_table
    def send(table: pa.Table) -> pa.Table:
        _, sets, rows = _sets(table, n)
        keys, classes, mixed = _runs(sets, rows.column("class").to_numpy())
        cuts = np.searchsorted(keys, (np.arange(ranges, dtype=np.uint64) * _U((1 << 64) // ranges)))
        rows = {name: [] for name in ("range", "chunk", "keys", "names", "classes", "mixed")}
        for number, (i, j) in enumerate(zip(cuts, np.append(cuts[1:], len(keys)))):
            names, index = np.unique(classes[i:j], return_inverse=True)
            parts = (number, table.column("chunk")[0].as_py(), pack(keys[i:j]), names.tobytes(), planes(index), np.packbits(mixed[i:j]).tobytes())
            for column, value in zip(rows.values(), parts):
                column.append(value)
        kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
        return pa.table({name: pa.array(column, kind) for (name, column), kind in zip(rows.items(), kinds)})

    @over_table
    def answer(table: pa.Table) -> pa.Table:
        sent = table.to_pylist()
        keys = [unpack(r["keys"]) for r in sent]
        classes = [np.frombuffer(r["names"], np.int64)[from_planes(r["classes"], np.int64)] for r in sent]
        mixed = [np.unpackbits(np.frombuffer(r["mixed"], np.uint8), count=len(k)).astype(bool) for r, k in zip(sent, keys)]
        every, _, found = _mixed(np.concatenate(keys), np.concatenate(classes), np.concatenate(mixed))
        shared = every[found]
        told = [pack(k[~m & np.isin(k, shared, assume_unique=True)]) for k, m in zip(keys, mixed)]
        return pa.table({"chunk": pa.array([r["chunk"] for r in sent], pa.int64()), "keys": pa.array(told, pa.binary())})

    def judge(texts: pa.Table, answers: pa.Table) -> pa.Table:
        nodes, sets, rows = _sets(texts, n)
        keys, _, mixed = _runs(sets, rows.column("class").to_numpy())
        shared = np.sort(np.concatenate([keys[mixed], *[unpack(k) for k in answers.column("keys").to_pylist()]]))
        common = [int(np.isin(s, shared, assume_unique=True).sum()) for s in sets]
        able = [i for i, (s, c) in enumerate(zip(sets, common)) if 100 * c >= percent * len(s)]
        return pa.table({"node": pa.array(nodes[able], pa.int64())})

    sent = chunked.groupBy("chunk").applyInArrow(send, "range int, chunk bigint, keys binary, names binary, classes binary, mixed binary")
    answers = sent.groupBy("range").applyInArrow(answer, "chunk bigint, keys binary")
    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(judge, "node bigint")


def links(docs: DataFrame, named: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows ``a``, ``b`` of node numbers: enough links to connect what links connect."""
    docs = _able_docs(docs, named, n, percent)
    groups = components(candidate_edges(docs, n, percent))
    members = staged(_members(docs, named, groups), "block-members")

    @over_table
    def within(table: pa.Table) -> pa.Table:
        nodes, sets, _ = _sets(table, n)
        return pa.table({"a": nodes, "b": linked_classes(nodes, sets, percent)})

    others = members.filter("pivot").withColumn("_to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    guests = others.filter("_to <> block").withColumn("block", F.col("_to")).drop("_to")
    in_blocks = members.unionByName(guests).select("unit", "block", "node", "text")
    found = staged(in_blocks.groupBy("unit", "block").applyInArrow(within, "a bigint, b bigint"), "block-links")

    large = members.filter("blocks > 1").drop("pivot", "block", "blocks")
    rest = _open_groups(large, found)
    if rest is None:
        return found
    # Nodes that may link elsewhere meet once more, by the other end of their sets, and what is found counts.
    able = _open_nodes(rest, n, percent)
    dealt = _dealt(able, "high").select("unit", "block", "node", "text")
    again = staged(dealt.groupBy("unit", "block").applyInArrow(within, "a bigint, b bigint"), "block-links")
    found = found.unionByName(again)
    rest = _open_groups(able.drop("class", "asks"), found)
    if rest is None:
        return found
    return found.unionByName(staged(_crossing(_open_nodes(rest, n, percent), n, percent), "crossing-links"))


def _open_groups(rows: DataFrame, found: DataFrame) -> DataFrame | None:
    """``rows`` (``unit``, ``node``) of groups the links leave in several classes, with ``class`` and ``asks``, false
    for a group's largest class; None if there are no such groups."""
    own = rows.select(F.col("node").alias("a")).distinct()
    known = components(found.join(own, "a", "left_semi")).withColumnRenamed("component", "class")
    classed = rows.join(known, "node", "left").withColumn("class", F.coalesce("class", "node"))
    counted = classed.groupBy("unit", "class").agg(F.count("*").alias("_k"))
    largest = counted.groupBy("unit").agg(F.max_by("class", F.struct("_k", "class")).alias("_main"), F.count("*").alias("_classes"))
    # Groups that are one class by now have nothing left to search.
    open_groups = staged(largest, "classes").filter("_classes > 1").drop("_classes")
    if open_groups.isEmpty():
        return None
    asks = F.col("class") != F.col("_main")
    return staged(classed.join(open_groups, "unit").withColumn("asks", asks).drop("_main"), "open-groups")


def _open_nodes(rest: DataFrame, n: int, percent: int) -> DataFrame:
    able = staged(still_open(rest, n, percent), "open-nodes")
    return staged(rest.join(able, "node"), "open-groups")


def _crossing(rest: DataFrame, n: int, percent: int) -> DataFrame:
    """Links between classes: nodes that ask, chunk by chunk, against every block of their unit."""
    asking = rest.filter("asks").groupBy("unit").agg(F.ceil(F.sum(F.octet_length("text")) / (BLOCK * 6)).cast("int").alias("chunks"))
    rest = _dealt(rest, "low").join(staged(asking, "asking"), "unit")
    chunk = F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("chunks")).cast("int")
    askers = rest.filter("asks").select(
        "unit", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), chunk.alias("chunk"), "node", "text", "class", "asks"
    )
    held = rest.select(
        "unit", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "node", "text", "class", F.lit(False).alias("asks")
    )

    @over_table
    def across(table: pa.Table) -> pa.Table:
        sides = []
        for side in (True, False):
            _, sets, rows = _sets(table.filter(pc.equal(table.column("asks"), side)), n)
            sides.append(list(zip(rows.column("class").to_pylist(), sets)))
        found = crossing_links(*sides, percent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return askers.unionByName(held).groupBy("unit", "block", "chunk").applyInArrow(across, "a bigint, b bigint")


def joined(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    named = staged(nodes_of(rows, n), "named")
    with_id = rows.filter("doc_id IS NOT NULL")
    tied = staged(components(links(with_id, named.filter("doc_id IS NOT NULL"), n, percent)), "tied")
    placed = staged(
        named.join(tied, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component")), "placed"
    )
    least = staged(placed.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("_least")), "least-ids")
    out = placed.join(least, "component", "left")
    return out.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("_least", "doc_id")).alias("component_id")
    )
