"""SimHash near-duplicates by tiled exact comparison.

Every text gets a 64-bit SimHash over its word shingles. Equal fingerprints are
merged first, so copies cost nothing further. The distinct fingerprints are cut
into tiles by the population counts of their two 32-bit halves or, where such
cells would be many tiles each, of their four 16-bit parts; a pair of tiles is
skipped when these counts alone differ by more than the radius in sum. Large
tiles are refined once more inside their task, by parts of half the size. Every
other pair is compared exactly with numpy exclusive-or and bit counts. A tile
pair hands on a spanning forest of its links instead of all of them, and
connected components of those follow by repeated star contraction.

Defined cases: a text without words (empty, null) has fingerprint zero and links
like any other; a text with fewer words than a shingle hashes its whole word
sequence; repeated rows are ordinary members of a group; rows with a null id get
a fingerprint and the component of its group (null if no member has an id); an
empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from .common import fresh, materialize, mix, utf8

SEED = 42
CHUNK = 1 << 16
#: Pairs that are compared in the time it takes to choose a group's partners.
GROUP_PAIRS = 1 << 17


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one text: bit set where over half of the shingle hashes have it."""
    words = text.lower().split()  # on bytes: A-Z only, and the six ASCII spaces
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        hashes, total = [xxhash.xxh64_intdigest(b" ".join(words), SEED)], 1
        counts = _bit_counts(hashes)
    else:
        flat = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        total = n - shingle + 1
        counts = np.zeros(64, np.int64)
        for lo in range(0, total, CHUNK):
            hi = min(total, lo + CHUNK)
            spans = zip(starts[lo:hi].tolist(), ends[lo + shingle - 1 : hi + shingle - 1].tolist())
            counts += _bit_counts([xxhash.xxh64_intdigest(flat[a:b], SEED) for a, b in spans])
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: list[int]) -> np.ndarray:
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id_col, fp) for every row; ``fp`` is the fingerprint as a signed long."""
    kind = docs.schema[id_col].dataType

    def run(batches):
        for batch in batches:
            buf, offs = utf8(batch.column(1))
            raw = buf.tobytes()
            fps = np.array([fingerprint(raw[a:b], shingle) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind.simpleString()}, fp long")
    return out.withColumnRenamed("id", id_col)


# ------------------------------------------------------------------ links


class _Forest:
    """Union-find over positions of one tile pair."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> int | None:
        """Join two trees; the root that is none any more, if they were two."""
        i, j = sorted((self.root(i), self.root(j)))
        if i == j:
            return None
        self.up[j] = i
        return j


def _refined(values: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of ``values`` by the bit counts of their parts, each group's counts, and where groups start (and the end)."""
    counts = np.bitwise_count(np.ascontiguousarray(values).view(f"<u{8 // parts}").reshape(-1, parts))
    code = counts.astype(np.int64) @ ((64 // parts + 1) ** np.arange(parts))
    order = np.argsort(code, kind="stable")
    cuts = np.flatnonzero(np.diff(code[order], prepend=-1))
    return order, counts[order[cuts]].astype(np.int16), np.append(cuts, len(values))


def _blocks(x: np.ndarray, y: np.ndarray | None, radius: int, parts: int, pairs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in x and in y (None: x) whose pairs hold every link, at most about ``pairs`` pairs at a time.

    Large tiles are grouped by the bit counts of ``parts`` parts, and groups
    whose counts differ by more than the radius in sum are left out.
    """
    other = x if y is None else y
    order, mine, at = _refined(x, parts)
    if len(x) * len(other) <= len(mine) * GROUP_PAIRS:  # too little to save by it
        groups = [(np.arange(len(x)), np.arange(len(other)))]
    else:
        order2, theirs, at2 = (order, mine, at) if y is None else _refined(y, parts)
        sizes = np.diff(at2)

        def near(g: int) -> np.ndarray:
            close = np.abs(theirs - mine[g]).sum(axis=1) <= radius
            if y is None:
                close[:g] = False
            return order2[np.repeat(close, sizes)]

        groups = ((order[at[g] : at[g + 1]], near(g)) for g in range(len(mine)))
    for i, j in groups:
        step = max(1, pairs // max(1, len(j)))
        for lo in range(0, len(i) if len(j) else 0, step):
            yield i[lo : lo + step], j


def _tile_links(x: np.ndarray, y: np.ndarray | None, radius: int, parts: int = 4, pairs: int = 1 << 21) -> list[tuple[int, int]]:
    """Spanning forest of the links between two tiles (``y`` None: within one).

    Positions in y follow those of x. Every pair that the counts of ``parts``
    parts don't tell apart is compared; a pair is only looked at again while its
    two ends are in different trees.
    """
    other = x if y is None else y
    base = 0 if y is None else len(x)
    forest, links = _Forest(len(x) + (0 if y is None else len(y))), []
    label = np.arange(len(forest.up))
    for left_at, right_at in _blocks(x, y, radius, parts, pairs):
        near = np.bitwise_count(x[left_at][:, None] ^ other[right_at][None, :]) <= radius
        if y is None:
            near &= left_at[:, None] != right_at[None, :]
        while True:
            rows = np.flatnonzero(near.any(axis=1))
            if not len(rows):
                break
            cross = near[rows] & (label[left_at[rows]][:, None] != label[base + right_at][None, :])
            left, right = np.flatnonzero(cross.any(axis=1)), np.flatnonzero(cross.any(axis=0))
            if not len(left):
                break
            # the first open link of every row, and of every column
            i = left_at[np.concatenate((rows[left], rows[cross[:, right].argmax(axis=0)]))]
            j = right_at[np.concatenate((cross[left].argmax(axis=1), right))] + base
            gone = []
            for i, j in zip(i.tolist(), j.tolist()):
                if (old := forest.join(i, j)) is not None:
                    links.append((i, j))
                    gone.append(old)
            if len(gone) <= 32:
                for old in gone:
                    label[label == old] = forest.root(old)
            else:
                old = np.unique(label)
                label = np.array([forest.root(i) for i in old.tolist()])[np.searchsorted(old, label)]
    return links


class Grid:
    """Cells of fingerprints by the bit counts of their 2 or 4 equal parts, large cells in several tiles.

    ``size``: fingerprints in each cell, an array with an axis for each part.
    """

    def __init__(self, size: np.ndarray, radius: int, tile_rows: int):
        self.parts, self.width, self.radius = size.ndim, size.shape[0], radius
        self.size, self.tiles = size, -(-size // tile_rows)
        steps = np.indices((2 * radius + 1,) * self.parts).reshape(self.parts, -1).T - radius
        self.ball = steps[np.abs(steps).sum(axis=1) <= radius]

    def costs(self) -> tuple[int, int]:
        """Fingerprints sent to tile pairs, and pairs of fingerprints in these."""
        sent = pairs = 0
        for step in self.ball.tolist():
            here = tuple(slice(max(0, -d), self.width - max(0, d)) for d in step)
            there = tuple(slice(max(0, d), self.width - max(0, -d)) for d in step)
            sent += int((self.size[here] * self.tiles[there]).sum())
            pairs += int((self.size[here].astype(float) * self.size[there]).sum())
        return sent, (pairs + int(self.size.sum())) // 2

    def cell(self, fps: np.ndarray) -> np.ndarray:
        """Counts of the parts, a row for each fingerprint."""
        return np.bitwise_count(np.ascontiguousarray(fps).view(f"<u{8 // self.parts}").reshape(-1, self.parts)).astype(np.int64)


def grids(fps: DataFrame, radius: int, tile_rows: int) -> list[Grid]:
    """The grids of 2 and of 4 parts, from one count of at most 17**4 cells."""
    part = lambda k: F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF).cast("long")))
    code = sum((part(k) * 17 ** (3 - k) for k in range(4)), F.lit(0))
    counted = fps.groupBy(code.cast("int").alias("c")).agg(F.count("*").alias("n")).toArrow()
    size = np.zeros(17**4, np.int64)
    size[counted["c"].to_numpy()] = counted["n"].to_numpy()
    four = size.reshape((17,) * 4)
    two = np.zeros((33, 33), np.int64)
    a, b, c, d = np.indices(four.shape)
    np.add.at(two, (a + b, c + d), four)
    return [Grid(two, radius, tile_rows), Grid(four, radius, tile_rows)]


def links(fps: DataFrame, radius: int = 4, tile_rows: int = 65_536, grid: Grid | None = None) -> DataFrame:
    """(a, b): a spanning set of the links of the distinct fingerprints in ``fps`` (column fp).

    A fingerprint is sent once to every tile pair its tile is in; a task holds
    two tiles of about ``tile_rows`` rows. Of the two grids that one is taken
    that sends less: cells by two parts while these fit a tile, by four when
    they would be many tiles each. All pairs that a grid leaves out are
    further apart than the radius, so the links are the same.
    """
    spark = fps.sparkSession
    grid = grid or min(grids(fps, radius, tile_rows), key=lambda g: g.costs()[0])
    # at most 17**4 numbers, whatever the input
    tiles, ball, width = grid.tiles.reshape(-1).astype(np.int32), grid.ball, grid.width
    places = width ** np.arange(grid.parts - 1, -1, -1)

    def deal(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            counts = grid.cell(fp)
            cell = counts @ places
            own = (mix(fp) % np.maximum(tiles[cell], 1).astype(np.uint64)).astype(np.int64)
            for step in ball:
                there = counts + step
                mate = there @ places
                inside = ((there >= 0) & (there < width)).all(axis=1)
                times = np.where(inside, tiles[np.where(inside, mate, 0)], 0).astype(np.int64)
                ends = np.cumsum(times)
                lo = 0
                while lo < len(fp):  # about a million rows at a time
                    hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + (1 << 20), "right")))
                    at = np.repeat(np.arange(lo, hi), times[lo:hi])
                    theirs = np.arange(len(at)) - np.repeat(ends[lo:hi] - times[lo:hi] - (ends[lo - 1] if lo else 0), times[lo:hi])
                    lo = hi
                    if not len(at):
                        continue
                    mine, c, m = own[at], cell[at], mate[at]
                    # a tile pair is named by its smaller tile first
                    second = (c > m) | ((c == m) & (mine > theirs))
                    cols = [np.where(second, m, c), np.where(second, theirs, mine), np.where(second, c, m), np.where(second, mine, theirs)]
                    arrays = [*(pa.array(x.astype(np.int32)) for x in cols), pa.array(second), pa.array(fp[at].view(np.int64))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["c1", "t1", "c2", "t2", "second", "fp"])

    sent = fps.select("fp").mapInArrow(deal, "c1 int, t1 int, c2 int, t2 int, second boolean, fp long")
    finer = 2 * grid.parts

    def run(batches):
        held: list[np.ndarray] = []
        key = None

        def done():
            both = np.concatenate(held)
            values, flags = both["fp"], both["second"]
            x, y = values[~flags], values[flags]
            if key[0] == key[2] and key[1] == key[3]:
                nodes, found = x, _tile_links(x, None, radius, finer)
            else:
                nodes, found = np.concatenate((x, y)), _tile_links(x, y, radius, finer)
            if found:
                at = np.array(found)
                return pa.RecordBatch.from_arrays([pa.array(nodes[at[:, k]].view(np.int64)) for k in (0, 1)], names=["a", "b"])
            return None

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
            rows = np.empty(n, [("fp", np.uint64), ("second", bool)])
            rows["fp"] = batch.column(5).to_numpy().view(np.uint64)
            rows["second"] = batch.column(4).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), n]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                now = tuple(keys[lo].tolist())
                if key is not None and now != key:
                    if (out := done()) is not None:
                        yield out
                    held = []
                key = now
                held.append(rows[lo:hi])
        if held and (out := done()) is not None:
            yield out

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ["c1", "t1", "c2", "t2"]
    dealt = sent.repartition(n, *names).sortWithinPartitions(*names)
    return dealt.mapInArrow(run, "a long, b long")


# ------------------------------------------------------------------ components


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components of (a, b) links; ``root`` is the smallest node of each.

    Alternating large-star and small-star contraction until nothing changes.
    Each round is written to the shared folder; the minima are written on their
    own so that a hub's rows can be split in the join.
    """
    spark = edges.sparkSession
    now = materialize(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    if now.isEmpty():
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        # large star: neighbours larger than the node go to its smallest neighbour
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "stars")
        large = materialize(
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links"
        )
        # small star: the node and its smaller neighbours go to the smallest of them
        down = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "stars")
        small = large.join(down, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            down.select("a", F.col("m").alias("b"))
        )
        now = materialize(small.distinct(), "links")
        # a star per component: the same rows twice in a row
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def _rooted(prints: DataFrame, least: str, radius: int, tile_rows: int) -> DataFrame:
    """(fp, least, root): each distinct fingerprint with the smallest ``least`` and its component's smallest fingerprint."""
    nodes = materialize(prints.groupBy("fp").agg(F.min(least).alias("least")), "nodes")
    comps = components(links(nodes.select("fp"), radius, tile_rows))
    linked = comps.unionAll(comps.select(F.col("root").alias("node"), "root").distinct())
    return nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, tile_rows: int = 65_536
) -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of ``docs``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    prints = materialize(fingerprints(rows, "doc", "text", shingle), "prints")
    rooted = _rooted(prints, "doc", radius, tile_rows)
    # the root is the smallest fingerprint; the component's name is its smallest id
    named = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    labels = materialize(rooted.join(named, "root").select("fp", "component_id"), "labels")
    return prints.join(labels, "fp").select(
        F.col("doc").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, tile_rows: int = 65_536
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with its smallest id.

    A row is known by its id and a mark of its text, so an id that stands in
    several groups, or twice in one, costs no group its row: each group keeps
    the smallest (id, mark), and of rows equal in both the first by the other
    columns. Rows with a null id are kept, as no group can be named by them.
    """
    mark = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    doc = F.when(F.col(f"`{id_col}`").isNotNull(), F.struct(F.col(f"`{id_col}`").alias("id"), mark.alias("mark")))
    rows = docs.select(doc.alias("doc"), F.col(f"`{text_col}`").alias("text"))
    prints = materialize(fingerprints(rows, "doc", "text", shingle), "prints")
    rooted = _rooted(prints, "doc", radius, tile_rows)
    i, m, n = fresh(docs, "id", "mark", "n")
    keep = rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.id").alias(i), F.col("least.mark").alias(m))
    keep = materialize(keep.where(F.col(i).isNotNull()), "keep")
    kept = docs.join(keep, (F.col(f"`{id_col}`") == F.col(i)) & (mark == F.col(m)), "left_semi")
    rest = [f.name for f in docs.schema if f.name != id_col and isinstance(f.dataType, AtomicType)]
    order = Window.partitionBy(F.col(f"`{id_col}`"), mark).orderBy(*[F.col(f"`{c}`") for c in (text_col, *[c for c in rest if c != text_col])])
    one = kept.withColumn(n, F.row_number().over(order)).where(F.col(n) == 1).drop(n)
    return one.unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
