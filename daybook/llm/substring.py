"""Exact substring deduplication with difference-cover anchors.

A window is ``window`` (13) consecutive words of one document. A word goes if a
window over it also starts in a document with a smaller id, judged on the input.

Anchors are hashes of ``13 - 7 + 1 = 7`` words, taken only where the word's
place modulo 7 is in the difference cover {0, 1, 3}: for any two places some
shift under 7 puts both on the cover, so every shared window holds an anchor
that both documents take at the same distance from its start.

1. Anchors that occur in two documents or more, each with the place where the
   smallest document has it (aggregated before the shuffle).
2. Each document's anchors that are among them. Anchors on one diagonal against
   the same smallest document that follow each other without a gap are a
   verified run: windows inside it go.
3. What is left to extend: windows that hold a shared anchor and lie in no
   verified run. Their whole 13 words are hashed (128 bits) and the smallest
   document of each is found; a window goes if that is smaller than its own.

No step pairs the members of a group, so a passage in a third of all documents
costs one row for each occurrence.

Defined cases: null and empty texts have no words; rows with a null id keep
every word and take nothing from others; rows that share an id don't affect each
other; repeated rows give repeated results; other input columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, materialize, slices, spread, utf8

PERIOD = 7
COVER = np.isin(np.arange(PERIOD), [0, 1, 3])
SLICE = 4 << 20
#: A place within a document: 32 bits of its text's CRC-32, then 31 bits of word number.
PLACE = 31


def _tags(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    raw = memoryview(buf)
    return np.array([zlib.crc32(raw[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())], np.int64)


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """(h, doc, place) of every anchor of documents with at least one window."""
    size = window - PERIOD + 1

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            buf, offs = utf8(batch.column(1))
            for lo, hi in slices(offs, SLICE):
                part, at = buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
                words = Words(part, at)
                take = COVER[words.place % PERIOD] & words.whole(size) & (words.count >= window)[words.row]
                row = words.row[take]
                place = (_tags(part, at)[row] << PLACE) | words.place[take]
                h = words.windows(size)[take].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, ids[lo:hi][row], place)], names=["h", "doc", "place"])

    return docs.where("doc is not null and text is not null").select("doc", "text").mapInArrow(run, "h long, doc long, place long")


def _kept(raw: bytes, gone: np.ndarray | None) -> tuple[int, int, bytes]:
    words = raw.split()
    removed = 0 if gone is None else int(gone.sum())
    if removed:
        kept = [w for w, g in zip(words, gone.tolist()) if not g]
    else:
        kept = words
    return len(words), removed, b" ".join(kept)


def _covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    return spread(starts, starts + window, n)


def _runs(anchor: np.ndarray, source: np.ndarray, diagonal: np.ndarray, doc: int, n: int, window: int) -> np.ndarray:
    """Starts of the windows that verified runs against smaller documents cover."""
    size = window - PERIOD + 1
    good = source < doc
    a, m, diagonal = anchor[good], source[good], diagonal[good]
    verified = np.zeros(max(0, n - window + 1), bool)
    if len(a):
        order = np.lexsort((a, diagonal, m))
        a, m, diagonal = a[order], m[order], diagonal[order]
        new = np.concatenate(([True], (m[1:] != m[:-1]) | (diagonal[1:] != diagonal[:-1]) | (a[1:] - a[:-1] > size)))
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:] - 1, [len(a) - 1]))
        lo, hi = a[first], a[last] + size - window + 1
        verified = spread(lo[hi > lo], hi[hi > lo], len(verified))
    return verified


def _lists(values: pa.Array, lengths: list[int | None]) -> pa.Array:
    """Lists of these lengths over ``values``; None: a null list."""
    ends = np.cumsum([0, *[n or 0 for n in lengths]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([n is None for n in lengths]))


_FIRST = (
    "doc long, tag long, n_words long, n_removed long, kept string, text string, "
    "verified array<int>, open array<struct<w1:long,w2:long,at:int>>"
)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """(id_col, n_words, n_removed, text) per row: the kept words joined by one space."""
    if window < 2 * PERIOD - 1:
        raise ValueError(f"window must be at least {2 * PERIOD - 1} words")
    slim = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    anchors = _anchors(slim, window)
    shared = materialize(
        anchors.groupBy("h")
        .agg(F.min("doc").alias("m"), F.max("doc").alias("top"), F.min_by("place", "doc").alias("m_place"))
        .where("m < top")
        .drop("top"),
        "anchors",
    )
    at = F.col("place").bitwiseAND(F.lit((1 << PLACE) - 1).cast("long"))
    mine = anchors.join(shared, "h").select(
        "doc", F.shiftright("place", PLACE).alias("tag"),
        F.struct(at.cast("int").alias("at"), "m", (F.col("m_place") - at).alias("diagonal")).alias("anchor"),
    )
    # sets: no longer than the text, however often the row is repeated; in order they are small when written
    lists = materialize(mine.groupBy("doc", "tag").agg(F.sort_array(F.collect_set("anchor")).alias("found")), "anchored")
    tagged = slim.withColumn("tag", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))

    def first(batches):
        for batch in batches:
            ids, tags = batch.column(0), batch.column(2)
            found = batch.column(3)
            buf, offs = utf8(batch.column(1))
            for lo, hi in slices(offs, SLICE):
                part, at = buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
                raw = part.tobytes()
                flagged = [i for i in range(lo, hi) if found[i].is_valid]
                hashed = Words(part, at) if flagged else None
                if flagged:
                    w1, w2 = hashed.windows(window), hashed.windows(window, second=True)
                out, ranges, opened = [], [], []
                for i in range(lo, hi):
                    text = raw[at[i - lo] : at[i - lo + 1]]
                    gone, edges, more = None, None, None
                    if found[i].is_valid:
                        k, n = hashed.first[i - lo], int(hashed.count[i - lo])
                        rows = found[i].values
                        anchor, m, diagonal = (rows.field(c).to_numpy().astype(np.int64) for c in range(3))
                        sure = _runs(anchor, m, diagonal, ids[i].as_py(), n, window)
                        # windows that hold an anchor whole
                        holds = spread(np.maximum(anchor - PERIOD + 1, 0), np.minimum(anchor + 1, n - window + 1), len(sure))
                        more = np.flatnonzero(holds & ~sure)
                        if len(more):
                            edges = np.flatnonzero(np.diff(np.concatenate(([0], sure.astype(np.int8), [0]))))
                            more = (w1[k + more], w2[k + more], more)
                        else:
                            gone, more = _covered(np.flatnonzero(sure), n, window), None
                    if more is None:
                        words, removed, kept = _kept(text, gone)
                        out.append((words, removed, kept.decode(), None))
                    else:
                        out.append((None, None, None, text.decode()))
                    ranges.append(edges)
                    opened.append(more)
                w = [np.concatenate([x[k] for x in opened if x is not None] or [np.zeros(0, np.int64)]) for k in range(3)]
                spots = pa.StructArray.from_arrays(
                    [pa.array(w[0].view(np.int64)), pa.array(w[1].view(np.int64)), pa.array(w[2].astype(np.int32))], names=["w1", "w2", "at"]
                )
                bounds = pa.array(np.concatenate([x for x in ranges if x is not None] or [np.zeros(0)]).astype(np.int32))
                cols = [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), tags.slice(lo, hi - lo), *cols, _lists(bounds, [None if x is None else len(x) for x in ranges]),
                     _lists(spots, [None if x is None else len(x[0]) for x in opened])],
                    names=["doc", "tag", "n_words", "n_removed", "kept", "text", "verified", "open"],
                )

    judged = materialize(tagged.join(lists, ["doc", "tag"], "left").select("doc", "text", "tag", "found").mapInArrow(first, _FIRST), "judged")
    undecided = judged.where("open is not null")
    windows = undecided.select("doc", "tag", F.explode("open").alias("w")).select("doc", "tag", "w.*")
    least = materialize(
        windows.groupBy("w1", "w2").agg(F.min("doc").alias("m"), F.max("doc").alias("top")).where("m < top").drop("top"), "windows"
    )
    more = windows.join(least, ["w1", "w2"]).where("doc > m").groupBy("doc", "tag").agg(F.collect_set("at").alias("more"))

    def second(batches):
        for batch in batches:
            ids, texts, verified, more = (batch.column(k) for k in range(4))
            out = []
            for i in range(batch.num_rows):
                raw = texts[i].as_py().encode()
                n = len(raw.split())
                edges = verified[i].values.to_numpy().astype(np.int64)
                starts = spread(edges[::2], edges[1::2], max(0, n - window + 1))
                if more[i].is_valid:
                    starts[more[i].values.to_numpy()] = True
                words, removed, kept = _kept(raw, _covered(np.flatnonzero(starts), n, window))
                out.append({"doc": ids[i].as_py(), "n_words": words, "n_removed": removed, "kept": kept.decode()})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=settled_schema)

    settled_schema = pa.schema([("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    settled = undecided.select("doc", "tag", "text", "verified").join(more, ["doc", "tag"], "left")
    late = settled.select("doc", "text", "verified", "more").mapInArrow(second, "doc long, n_words long, n_removed long, kept string")
    early = judged.where("open is null").select("doc", "n_words", "n_removed", "kept")
    return early.unionByName(late).select(F.col("doc").alias(id_col), "n_words", "n_removed", F.col("kept").alias("text"))


def kept_digest(deduped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_words, n_removed, kept_sha256) of ``substring_dedup``'s rows."""
    return deduped.select(id_col, "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
