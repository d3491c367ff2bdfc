"""Near-duplicate documents by SimHash and a generalised pigeonhole search."""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import by_batch, components, forget, roots, stored

SEED = 42
#: Rows with one block value that are compared in one task at once; more are dealt to pairs of groups.
CELL = 2048
#: Pairs that are compared, or links that are held, at once.
STEP = 1 << 19
#: Hot block values up to this number go to all tasks (12 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Columns of the parity sketch of a set, 64 bits each.
PARITY = ("odd0", "odd1", "odd2", "odd3")
#: Min-wise hashes that make one band, and the share of pairs at the similarity asked for that may agree in no band.
BAND = 4
MISSED = 1e-7


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words, lower-cased in ASCII and joined by spaces; of all words if they are fewer."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]).tolist()
    starts, ends = [0, *ends[:-1]], ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e - 1], SEED) for s, e in zip(starts, ends)), np.uint64, len(ends))


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits, each set if more than half of the hashes have it. No hash: zero."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        ones += _bits(hashes[k:k + (1 << 16)]).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``key`` and ``fingerprint`` (long) of every row; null, empty and blank texts have fingerprint zero."""

    def step(batch):
        values = np.array([fingerprint(shingle_hashes(t, shingle)) for t in batch.column(1).to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=[key, "fingerprint"])

    kept = docs.select(key, text)
    return kept.mapInArrow(by_batch(step), kept.select(key, F.lit(0).cast("long").alias("fingerprint")).schema)


def parities(hashes: np.ndarray) -> np.ndarray:
    """Of different hashes, whether the number in each of 256 ranges is odd, as four words of 64 bits.

    The sketches of two sets differ in no more bits than the sets have elements that the other lacks.
    """
    count = np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=64 * len(PARITY))
    return np.packbits(count & 1, bitorder="little").view(np.uint64)


# --- bands of min-wise hashes ---------------------------------------------------------------------------

def permutations(similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Factors and terms of the hashes of as many bands as it takes: two sets agree in a band with odds of similarity ** BAND."""
    odds = similarity ** BAND
    bands = max(1, math.ceil(math.log(MISSED) / math.log1p(-odds))) if odds < 1 else 1
    draw = np.random.RandomState(SEED)
    factors, terms = (draw.randint(0, 1 << 32, (bands * BAND, 1), np.uint32) for _ in "ab")
    return factors | np.uint32(1), terms


def band_values(hashes: np.ndarray, drawn: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One value (long) for each band of min-wise hashes of a set, by the ``permutations`` drawn; no element, no value.

    Whether two sets share a value depends on their Jaccard similarity alone, not on which elements differ.
    """
    if not len(hashes):
        return np.zeros(0, np.int64)
    factors, terms = drawn
    short, least = (hashes >> np.uint64(32)).astype(np.uint32), np.full(len(factors), (1 << 32) - 1, np.uint32)
    for k in range(0, len(short), 1024):
        moved = short[None, k:k + 1024] * factors
        moved += terms
        np.minimum(least, moved.min(1), out=least)
    values = np.arange(len(factors) // BAND, dtype=np.uint64)
    for column in least.reshape(-1, BAND).T:
        values = (values ^ column) * np.uint64(0x9E3779B97F4A7C15)
        values ^= values >> np.uint64(29)
    return values.view(np.int64)


# --- which bits belong together, and how far each part is searched -------------------------------------

def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(points: DataFrame, column: str) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have bits i and j set, over all of them."""

    def step(batches):
        total = np.zeros((64, 64))
        for batch in batches:
            bits = _bits(np.asarray(batch.column(0)).astype(np.int64)).astype(np.float32)
            total += bits.T @ bits
            yield pa.RecordBatch.from_pydict({"cell": pa.array([-1], pa.int32()), "n": pa.array([len(bits)], pa.int64())})
        at = np.nonzero(total.ravel())[0]
        yield pa.RecordBatch.from_pydict({"cell": at.astype(np.int32), "n": total.ravel()[at].astype(np.int64)})

    rows = points.select(column).mapInArrow(step, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    found = {r["cell"]: r["n"] for r in rows}  # 4,097 at most
    return found.get(-1, 0), np.array([found.get(k, 0) for k in range(64 * 64)], float).reshape(64, 64)


def correlated_parts(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The 64 bits in parts of nearly equal width, bits that go together in the same part."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.clip(share * (1 - share), 1e-12, None))
    tied = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(tied, 0)
    free, found = set(range(64)), []
    for k in range(parts):
        width = (64 + k) // parts
        part = [max(sorted(free), key=lambda i: tied[i, sorted(free)].sum())]
        while len(part) < width:
            rest = sorted(free - set(part))
            part.append(max(rest, key=lambda i: tied[i, part].sum()))
        free -= set(part)
        found.append(sorted(part))
    return found


def block_values(values: np.ndarray, part: list[int]) -> np.ndarray:
    """The part's bits of each fingerprint, moved together."""
    out = np.zeros(len(values), np.uint64)
    for place, bit in enumerate(part):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """A threshold from -1 (not searched) up for each part, summing to ``total``, at the least cost.

    ``costs[i][t + 1]`` is the cost of part i at threshold t.
    """
    best = {0: (0.0, [])}
    for cost in costs:
        after = {}
        for spent, (so_far, chosen) in best.items():
            for t, c in enumerate(cost, start=-1):
                if spent + t not in after or so_far + c < after[spent + t][0]:
                    after[spent + t] = so_far + c, [*chosen, t]
        best = after
    return best.get(total, (math.inf, []))


def _estimates(same: float, n: int, differ: np.ndarray, most: int) -> list[float]:
    """Pairs expected within 0..most bits of a part: those that agree on all of it, counted, times the odds of each flip."""
    agree, odds = np.clip(1 - differ, 1e-9, 1), np.clip(differ, 1e-9, 1) / np.clip(1 - differ, 1e-9, 1)
    sums = np.zeros(most + 1)
    sums[0] = 1
    for x in odds:
        sums[1:] = sums[1:] + sums[:-1] * x
    return list(max(same, n * (n - 1) / 2 * float(np.prod(agree))) * np.cumsum(sums))


def plan(points: DataFrame, column: str, max_bits: int, parts: tuple[int, ...]) -> tuple[list[list[int]], list[int]]:
    """Parts and thresholds: fingerprints that differ in ``max_bits`` bits or fewer are within the threshold of some part.

    Thresholds of m parts sum to ``max_bits - m + 1`` (each may be -1), which is the generalised pigeonhole
    principle. The counts that the choice rests on are taken over all fingerprints.
    """
    n, both = bit_counts(points, column)
    share = np.diag(both) / max(n, 1)
    layouts = [correlated_parts(n, both, m) for m in parts]
    flat = [part for layout in layouts for part in layout]

    def step(batch):
        values = np.asarray(batch.column(0)).astype(np.int64).view(np.uint64)
        return pa.RecordBatch.from_pydict({
            "part": np.repeat(np.arange(len(flat), dtype=np.int32), len(values)),
            "value": np.concatenate([block_values(values, part) for part in flat]).view(np.int64)})

    equal = {r["part"]: r["pairs"] for r in points.select(column).mapInArrow(by_batch(step), "part int, value long")
             .groupBy("part", "value").count().groupBy("part")
             .agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")).collect()}
    found, first = [], 0
    for layout in layouts:
        costs = []
        for k, part in enumerate(layout, start=first):
            most = min(max_bits, 3, len(part))
            pairs = _estimates(equal.get(k, 0.0), n, 2 * share[part] * (1 - share[part]), most)
            # A probe costs about as much as 50 comparisons; half the flips are probed.
            rows = [n * 50.0 * (1 + sum(math.comb(len(part), s) for s in range(1, t + 1)) / 2) for t in range(most + 1)]
            costs.append([0.0, *(p + r for p, r in zip(pairs, rows))])
        cost, thresholds = allocate(costs, max_bits - len(layout) + 1)
        found.append((cost, layout, thresholds))
        first += len(layout)
    return min(found, key=lambda x: x[0])[1:]


# --- probing and verifying -------------------------------------------------------------------------------

def _signatures(layout, thresholds, hot=None):
    """Rows (key, role, node, fp, size, further columns): role 0 under the fingerprint's own block values, 1 under those it probes.

    With ``hot``, keys in order and the number of groups of each, also ``groups``: that number, or 1.
    """
    flips = []
    for part, most in zip(layout, thresholds):
        masks = [sum(1 << p for p in at) for s in range(1, most + 1) for at in itertools.combinations(range(len(part)), s)]
        flips.append(np.array(masks, np.uint64))

    def step(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                yield from piece(batch.slice(start, 1024))

    def piece(batch):
        node, size = np.asarray(batch.column(0)), np.asarray(batch.column(2))
        values = np.asarray(batch.column(1)).astype(np.int64).view(np.uint64)
        for k, (part, most, masks) in enumerate(zip(layout, thresholds, flips)):
            if most < 0:
                continue
            own = block_values(values, part)
            probes = own[:, None] ^ masks[None, :]
            # Of two values, the greater one probes the less.
            who, which = np.nonzero(probes < own[:, None])
            keys = np.concatenate([own, probes[who, which]]) | np.uint64(k << 56)
            rows = np.concatenate([np.arange(len(own)), who])
            yield pa.RecordBatch.from_pydict({
                "key": keys.view(np.int64), "role": (np.arange(len(rows)) >= len(own)).astype(np.int8),
                "node": node[rows], "fp": values[rows].view(np.int64), "size": size[rows]} | {
                batch.schema.names[k]: np.asarray(batch.column(k))[rows] for k in range(3, batch.num_columns)} | (
                {} if hot is None else {"groups": _groups_of(hot, keys.view(np.int64))}))

    return step


def _groups_of(hot, keys):
    known, groups = hot
    if not len(known):
        return np.ones(len(keys), np.int32)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, groups[at], 1).astype(np.int32)


def _band_signatures(hot=None):
    """Rows like those of ``_signatures``, all of role 0, under the values of the bands; without ``hot`` the keys alone."""

    def step(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                yield piece(batch.slice(start, 1024))

    def piece(batch):
        found = [np.frombuffer(x, np.int64) for x in batch.column(0).to_pylist()]
        keys = np.concatenate(found)
        if hot is None:
            return pa.RecordBatch.from_pydict({"key": keys})
        rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
        node, size = np.asarray(batch.column(1)), np.asarray(batch.column(2))
        return pa.RecordBatch.from_pydict({
            "key": keys, "role": np.zeros(len(rows), np.int8), "node": node[rows], "fp": np.zeros(len(rows), np.int64), "size": size[rows]} | {
            batch.schema.names[k]: np.asarray(batch.column(k))[rows] for k in range(3, batch.num_columns)} | {
            "groups": _groups_of(hot, keys)})

    return step


SIGNATURES = "key long, role byte, node long, fp long, size int"


def _with(schema: str, further: list[str]) -> str:
    return ", ".join([schema, *(f"{c} long" for c in further)])


def _further(points: DataFrame) -> list[str]:
    return [c for c in PARITY if c in points.columns]


def _near(run, role, node, fp, size, label, max_bits, similarity=0, odd=()):
    """For rows in order of their run, index rows first: the places of index rows and later rows of their run that are near.

    With a similarity, pairs are left out whose sets cannot have it: sizes too far apart, or too many elements that
    only one has, by the parity sketches ``odd``.
    """
    ends = np.append(np.nonzero(run[1:] != run[:-1])[0] + 1, len(run))
    last = ends[np.searchsorted(ends, np.arange(len(run)), side="right")]
    many = np.where(role == 0, last - np.arange(len(run)) - 1, 0)
    total, start = np.cumsum(many), 0
    while start < len(run):
        done = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, done + STEP, side="right")))
        left = np.repeat(np.arange(start, stop), many[start:stop])
        if len(left):
            right = left + 1 + np.arange(len(left)) + done - np.repeat(total[start:stop] - many[start:stop], many[start:stop])
            near = (np.bitwise_count(fp[left] ^ fp[right]) <= max_bits) & (label[left] != label[right])
            left, right = left[near], right[near]
            if similarity:
                low, high = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
                can = low >= similarity * high
                if odd:
                    differ = sum(np.bitwise_count(x[left] ^ x[right]).astype(np.int64) for x in odd)
                    # Of two sets that alike, (1 - s) / (1 + s) of both sizes are in one only; rounding rejects nothing.
                    can &= (differ - 1e-6) * (1 + similarity) <= (1 - similarity) * (low.astype(np.int64) + high)
                left, right = left[can], right[can]
            yield left, right
        start = stop


def _by_run(batches):
    """Rows sorted by key, cell and role, with the number of their run; a run comes whole unless its probes are very many.

    Of such a run the index rows come again with the next probes.
    """
    tail = None
    for batch in batches:
        got = [np.asarray(batch.column(i)) for i in range(batch.num_columns)]
        for i in (5, *range(8, len(got))):
            got[i] = got[i].astype(np.int64).view(np.uint64)
        if tail is not None:
            got = [np.concatenate(x) for x in zip(tail, got)]
        key, lo, hi = got[:3]
        new = np.append(0, ((key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])).astype(np.int64))
        whole = int(np.nonzero(new)[0][-1]) if new.any() else 0
        if whole:
            yield np.cumsum(new)[:whole], [x[:whole] for x in got]
        tail = [x[whole:] for x in got]
        if len(tail[0]) > 1 << 18:
            yield np.zeros(len(tail[0]), np.int64), tail
            tail = [x[tail[3] == 0] for x in tail]
    if tail is not None and len(tail[0]):
        yield np.zeros(len(tail[0]), np.int64), tail


def _stars(max_bits):
    """Links that connect what is near, within a task."""

    def step(batches):
        kept = []
        for run, (_, _, _, role, node, fp, size, label) in _by_run(batches):
            for left, right in _near(run, role, node, fp, size, label, max_bits):
                kept.append((node[left], node[right]))
                if sum(len(a) for a, _ in kept) > STEP:
                    a, b = roots(*(np.concatenate(x) for x in zip(*kept)))
                    kept = [(a, b)]
                    if len(a) > STEP // 2:
                        kept = []
                        yield pa.RecordBatch.from_pydict({"a": a, "b": b})
        if kept:
            a, b = roots(*(np.concatenate(x) for x in zip(*kept)))
            for k in range(0, len(a), 1 << 18):
                yield pa.RecordBatch.from_pydict({"a": a[k:k + (1 << 18)], "b": b[k:k + (1 << 18)]})

    return step


PAIRS = "kind byte, a long, b long, key long, lo int, hi int, role byte, fp long, size int"


def _pairs(max_bits, similarity, most):
    """Near pairs as rows of kind 0: for each row of a run the first ``most`` rows before it that are near.

    The rows of pairs beyond that come along as kind 1.
    """

    def step(batches):
        for run, (key, lo, hi, role, node, fp, size, label, *odd) in _by_run(batches):
            further = PARITY[:len(odd)]
            names = [c.split()[0] for c in _with(PAIRS, further).split(", ")]
            seen, rows = np.zeros(len(run), np.int64), np.zeros(len(run), bool)
            for left, right in _near(run, role, node, fp, size, label, max_bits, similarity, odd):
                order = np.argsort(right, kind="stable")
                left, right = left[order], right[order]
                begin = np.append(True, right[1:] != right[:-1]) if len(right) else np.zeros(0, bool)
                group = np.cumsum(begin) - 1
                rank = np.arange(len(right)) - np.nonzero(begin)[0][group] + seen[right]
                np.add.at(seen, right, 1)
                first = rank < most
                rows[left[~first]] = rows[right[~first]] = True
                a, b = node[left[first]], node[right[first]]
                for k in range(0, len(a), 1 << 18):
                    x, y = a[k:k + (1 << 18)], b[k:k + (1 << 18)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.zeros(len(x), np.int8)), pa.array(x), pa.array(y)] + [pa.nulls(len(x), t) for t in (
                            pa.int64(), pa.int32(), pa.int32(), pa.int8(), pa.int64(), pa.int32(), *[pa.int64()] * len(odd))],
                        names=names)
            if rows.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(rows.sum(), np.int8)), pa.array(node[rows]), pa.array(node[rows]), *(pa.array(x[rows]) for x in (
                        key, lo, hi, role)), pa.array(fp[rows].view(np.int64)), pa.array(size[rows]), *(pa.array(x[rows].view(np.int64)) for x in odd)],
                    names=names)

    return step


def _cells(points: DataFrame, max_bits: int, parts: tuple[int, ...]) -> DataFrame:
    """The signature rows of ``points``, dealt to cells: by their ``bands`` (binary) if they have them, else by ``fp``.

    ``label`` says what is connected already; without it a row is connected with itself alone.

    A block value with more than ``CELL`` fingerprints is dealt to groups, and each pair of groups is a cell of its
    own; probes of it go to each group once. So a task holds two groups, whatever the value's share of the rows.
    """
    further, banded = _further(points) + [c for c in ("label",) if c in points.columns], "bands" in points.columns
    if banded:
        points = points.select("bands", "node", "size", *further)
        exact, signatures = points.select("bands").mapInArrow(_band_signatures(), "key long"), _band_signatures
    else:
        points = points.select("node", "fp", "size", *further)
        layout, thresholds = plan(points, "fp", max_bits, parts)
        exact = points.select("node", "fp", "size").mapInArrow(_signatures(layout, [min(t, 0) for t in thresholds]), SIGNATURES)
        signatures = functools.partial(_signatures, layout, thresholds)
    hot = stored(exact.groupBy("key").count().filter(F.col("count") > CELL).select(
        "key", F.ceil(F.col("count") / CELL).cast("int").alias("groups")), "hot-blocks")
    schema = _with(SIGNATURES, further)
    if hot.count() <= BROADCAST_ROWS:
        known = hot.orderBy("key").collect()
        known = np.array([r["key"] for r in known], np.int64), np.array([r["groups"] for r in known], np.int32)
        rows = points.mapInArrow(signatures(known), schema + ", groups int")
    else:
        none = np.zeros(0, np.int64), np.zeros(0, np.int32)
        rows = points.mapInArrow(signatures(none), schema + ", groups int").drop("groups").join(hot, "key", "left").withColumn(
            "groups", F.coalesce("groups", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), "groups").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    lo = F.when(F.col("role") == 0, F.least("own", "other")).otherwise(F.col("other"))
    hi = F.when(F.col("role") == 0, F.greatest("own", "other")).otherwise(F.col("other"))
    label = F.col("label" if "label" in points.columns else "node").alias("label")
    return rows.select("key", lo.alias("lo"), hi.alias("hi"), "role", "node", "fp", "size", label, *_further(points))


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "role", "node")


def near_links(points: DataFrame, max_bits: int, parts: tuple[int, ...] = (2, 3, 4)) -> DataFrame:
    """Links ``a``, ``b`` that connect the nodes of ``points`` (``node`` long, ``fp`` long, ``size`` int; nodes distinct).

    As many as it takes to connect what pairs at ``max_bits`` bits or fewer connect; no pairs within a group are emitted
    beyond that.
    """
    return _dealt(_cells(points, max_bits, parts)).mapInArrow(_stars(max_bits), "a long, b long")


def verified_groups(points: DataFrame, max_bits: int, parts: tuple[int, ...], similarity: float, verify,
                    rounds: tuple[int, ...] = (1, 64)) -> DataFrame:
    """``node``, ``root`` of the components of near pairs that ``verify`` leaves.

    Near are pairs whose ``fp`` differ in ``max_bits`` bits or fewer. Where ``points`` has ``bands``, pairs that share a band and
    that those have not connected are tried after them, whatever their bits.
    Pairs whose sets cannot have that Jaccard similarity, by their sizes and by the columns ``PARITY`` where ``points``
    has them, are left out where they are found: texts of one mould that are not alike make no rows.
    ``verify(pairs, nodes)`` takes pairs ``a``, ``b`` and the nodes that later pairs of this search may have (None: no others than
    before), and returns those that hold.
    In each run a row first meets as many rows before it as the first round says; where it has more, the run waits for
    the next round and the pairs that are not connected by then. The last round takes all of them. So a large group
    that holds together is connected through its first members, and every pair that could still connect something
    is tried.
    """
    searches, links, joined = [c for c in ("fp", "bands") if c in points.columns], [], None
    for search in searches:
        marked = points.drop(*(c for c in searches if c != search))
        if joined is not None:
            marked = stored(marked.join(joined, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root"), "labelled")
        rows, bits = _cells(marked, max_bits, parts), max_bits if search == "fp" else 64
        for number, most in enumerate((*rounds, 1 << 62)):
            found = stored(_dealt(rows).mapInArrow(_pairs(bits, similarity, most), _with(PAIRS, _further(points))), "pairs")
            pairs = found.filter("kind = 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            waiting = found.filter("kind = 1")
            later = None if number else waiting.select(F.col("a").alias("node")).distinct()
            links.append(stored(verify(pairs, later), "links"))
            joined = components(functools.reduce(DataFrame.union, links), "near-duplicates")
            if waiting.isEmpty():
                break
            rows = waiting.join(joined.withColumnRenamed("node", "a"), "a", "left").select(
                "key", "lo", "hi", "role", F.col("a").alias("node"), "fp", "size", F.coalesce("root", "a").alias("label"), *_further(points))
    return joined


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``key``, ``fingerprint`` (long), ``component_id``: the least key reachable by links of ``max_bits`` bits or fewer.

    One row for each row of ``docs``. Rows with equal fingerprints are linked, so repeated rows, exact copies and all
    texts without a word form one component each; only distinct fingerprints are searched. A null key is never the
    least unless the component has no other; then ``component_id`` is null. Other columns are ignored. An empty
    table gives an empty result.
    """
    marks = stored(fingerprints(docs, key, text, shingle).withColumnRenamed(key, "_key"), "fingerprints")
    distinct = stored(marks.groupBy("fingerprint").agg(F.min("_key").alias("_least")), "distinct")
    points = distinct.select(F.col("fingerprint").alias("node"), F.col("fingerprint").alias("fp"), F.lit(0).alias("size"))
    joined = components(near_links(points, max_bits), "simhash")
    # Most fingerprints have no link; they are their own component.
    named = distinct.join(joined, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("_root"))
    least = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = named.join(least, "_root").select("fingerprint", "component_id")
    return marks.join(named, "fingerprint").select(F.col("_key").alias(key), "fingerprint", "component_id")


# --- one document of each group --------------------------------------------------------------------------

def _sketches(check: int, marks: dict):
    """With a column for each of ``marks``: its type, and what it makes of the text and its different hashes."""

    def step(batch):
        found, sizes, odd = {name: [] for name in marks}, [], []
        for text in batch.column(2).to_pylist():
            checked = np.unique(shingle_hashes(text, check))
            for name, (_, mark) in marks.items():
                found[name].append(mark(text, checked))
            sizes.append(len(checked))
            odd.append(parities(checked))
        return pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), *(pa.array(found[name], kind) for name, (kind, _) in marks.items()), pa.array(sizes, pa.int32()),
            *(pa.array(x.view(np.int64)) for x in np.ascontiguousarray(np.array(odd).T))],
            names=["_key", "node", *marks, "size", *PARITY])

    return by_batch(step)


def _alike(similarity: float):
    def step(batch):
        left, right = ([np.frombuffer(x, np.uint64) for x in batch.column(k).to_pylist()] for k in (2, 3))
        keep = []
        for x, y in zip(left, right):
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both >= similarity * (len(x) + len(y) - both))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return by_batch(step)


def unique_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 2, max_bits: int = 3,
                     check: int = 5, similarity: float = 0.8, parts: tuple[int, ...] = (3, 4, 5), bands: bool = True) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the one with the least key.

    Two texts are near duplicates if the sets of their ``check``-word shingles have a Jaccard similarity of ``similarity``
    or more, which is computed exactly. It is computed for the pairs whose fingerprints (over the different runs of ``shingle``
    words) are at ``max_bits`` bits or fewer, all of which the pigeonhole search finds. Pairs that are alike beyond so many bits
    come after them, from ``bands`` of min-wise hashes, unless these have connected them: a pair at ``similarity`` shares no band
    with odds of ``MISSED``, whichever words differ, and one more alike with less. Groups are connected components.
    Equal texts are one group; null texts and texts
    without a word are equal in this. Of rows with equal key and text any one stays; null keys come last. An empty
    table stays empty.
    """
    blank = F.coalesce(F.col(text), F.lit(""))
    words = F.when(blank.rlike(r"[^\x20\x09-\x0D]"), blank).otherwise("")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(key).alias("_key"),
                       F.xxhash64(words).alias("node"), words.alias("_text"))
    sketches = {"fp": (pa.int64(), lambda text, checked: int(
        np.uint64(fingerprint(np.unique(shingle_hashes(text, shingle)))).view(np.int64)))}
    empty = {"fp": F.lit(0).cast("long")}
    if bands:
        drawn = permutations(similarity)  # here, so that executors get the numbers with the function
        sketches["bands"], empty["bands"] = (pa.binary(), lambda text, checked: band_values(checked, drawn).tobytes()), F.lit(b"")
    marks = stored(rows.select("_key", "node", "_text").mapInArrow(_sketches(check, sketches), rows.select(
        "_key", "node", *(c.alias(name) for name, c in empty.items()), F.lit(0).alias("size"),
        *(F.lit(0).cast("long").alias(c) for c in PARITY)).schema), "sketches")
    nodes = stored(marks.groupBy("node").agg(
        F.min("_key").alias("_least"), *(F.first(c).alias(c) for c in (*sketches, "size", *PARITY))), "texts")

    def sets(batch):
        found = [np.unique(shingle_hashes(t, check)).tobytes() for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "set"])

    known = []

    def verify(pairs, later):
        pairs = stored(pairs, "candidates")
        if later is not None:
            # The text of one row for each node that has a partner, or may yet get one in this search.
            wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).union(later).distinct()
            for before in known:
                wanted = wanted.join(before, "node", "left_anti")
            chosen = wanted.join(nodes, "node").select(F.struct("node", F.col("_least").alias("key")).alias("_of"))
            texts = rows.select(F.struct("node", F.col("_key").alias("key")).alias("_at"), "node", "_text").join(
                chosen, F.col("_at") == F.col("_of"), "left_semi").select("node", "_text").dropDuplicates(["node"])
            known.append(stored(texts.mapInArrow(by_batch(sets), "node long, set binary"), "shingles"))
        shingles = functools.reduce(DataFrame.union, known)
        left, right = (shingles.select(F.col("node").alias(n), F.col("set").alias(f"_{n}")) for n in "ab")
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "_a", "_b")
        return both.mapInArrow(_alike(similarity), "a long, b long")

    roots_of = verified_groups(nodes, max_bits, parts, similarity, verify)
    named = nodes.join(roots_of, "node", "left").select("node", "_least", F.coalesce("root", "node").alias("_root"))
    # The least key of the group, and of texts that share it the least.
    winners = named.groupBy("_root").agg(F.min(F.struct(F.col("_least").isNull(), "_least", "node")).alias("w")).select(
        F.struct(F.col("w.node"), F.col("w._least").alias("key")).alias("_of"))
    counts = marks.groupBy(F.struct("node", F.col("_key").alias("key")).alias("_of")).agg(F.count(F.lit(1)).alias("_rows"))
    winners = stored(winners.join(counts, "_of"), "kept")
    kept = rows.select(F.struct("node", F.col("_key").alias("key")).alias("_at"), "_row").join(
        winners, F.col("_at") == F.col("_of"))
    single = kept.filter("_rows = 1").select("_row.*")
    return single.union(kept.filter("_rows > 1").dropDuplicates(["_of"]).select("_row.*"))
