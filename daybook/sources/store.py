"""The stored table: versioned snapshots plus a day-partitioned change log.

Layout under ``root`` (any Hadoop-compatible shared path)::

    snapshot/day=YYYY-MM-DD/v=A/   full table as of that day (Parquet)
    changes/day=YYYY-MM-DD/v=A/    that day's change rows (keys, op, before, after)
    commits/YYYY-MM-DD_A_KIND_S    one empty file per committed day
    schemas/S.json                 the table's schema on the days that name it
    renames/YYYY-MM-DD_A.json      columns that got new names on a day, {old: new}
    sums/day=YYYY-MM-DD/v=A/n=N/   checksums of a kept version by key bucket (compare)
    counts/day=YYYY-MM-DD/v=A/c=C/ the day's count deltas of a reported column (group_count)
    merged/level=J/block=I/v=A/    net changes of 2**J days (compact_log)
    ladder/I_J_A_M_S               one empty file per merged block

Every run of a day writes an *attempt* ``A`` of its own. The day is switched to
it by one marker that names both folders, created last; until then readers see
the previous attempt, whole, and a run that fails at any step (key check, type
conflict, diff, write) leaves the day as it was. Of several markers of a day
the highest attempt counts; the others and their folders are removed after the
switch. ``KIND`` is ``sN`` while the snapshot version is kept (bucketed into N
files, 0: plain) and ``log`` once it is pruned or where none was written; with
``sN.B`` the day's version is that of its attempt ``B``.

A day may come late, between committed days ``P`` and ``N``: its own changes
follow ``P`` and those of ``N`` now follow it. Both are written as new attempts
and both days are switched by one marker, whose name joins theirs with ``+``;
``N`` keeps its snapshot version. The same corrects an older day.

One non-recursive listing of ``commits`` tells every day's state, never a
listing of the part files, which at 100 TB number tens of thousands per version.

:meth:`Store.compact_log` adds merged blocks of 2, 4, 8, ... days (see
``ladder``), which time travel then opens instead of single days.

Day ``D`` is always diffed against the newest committed day before it, from its
snapshot or, if that is pruned, from the replayed table. A finished day prunes
the versions before its base (``keep_snapshot_every`` days apart some are kept,
and the last before each change of schema), so the newest day can be rerun.

The columns may change from day to day. Each day's changes have the columns of
that day's dump, time travel returns the columns of the day it travels to, and
``read_log`` gives the union of all columns. A column that goes on under a new
name (``integrate(..., renames=)``) keeps its values: the day has no change where
only the name is new, time travel carries the values over the day, and
``read_log`` and the reports of counts give one column under its last name.

With ``buckets=N`` every snapshot version is written bucketed by the key into
``N`` files. Two bucketed versions then diff with no shuffle at all, and the
key check is a per-bucket aggregate of the written attempt: each day reads and
shuffles only its own dump, once, while writing it -- the previous snapshot is
never shuffled again. Unique keys hash evenly, so buckets don't skew; pick
``N`` so that one bucket of the snapshot is a few hundred MB. Bucketed versions
are read and written through catalog entries that exist for one call, under a
name of their own; the session's catalog must allow CREATE and DROP TABLE.
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import to_day
from ..operators.checksums import SUMS, bucket_of, bucket_sums, unequal_buckets
from ..operators.compare import CLASSES, compare, compare_summary, rates
from ..operators.compose import compose
from ..operators.counts import count_deltas, counts_from, top_n_from
from ..operators.diff import DELETE, INSERT, UPDATE, change_log_schema, first_load, snapshot_diff
from ..operators.keys import normalize_key, require_valid_key, require_valid_keys
from ..operators.replay import apply_changes, build_change_log, stack_dumps, undo_to
from ..operators.renames import check_renames, fitting_renames, renamed_columns
from ..operators.schema import align_columns, as_keys, nullable
from . import ladder
from .io import day_dir, empty_frame, write_parquet
from .ladder import Block

# Fixed form of a commit marker's name: day, attempt, kind, schema.
COMMIT_MARK = re.compile(r"(\d{4}-\d{2}-\d{2})_(\d{6}-[0-9a-f]{8})_(log|s\d+(?:\.\d{6}-[0-9a-f]{8})?)_([0-9a-f]{16})")

# Spark's name of a bucket's file ends in the bucket's number.
BUCKET_FILE = re.compile(r"_(\d{5,})\.c\d+")
#: Key buckets of the checksums of versions that aren't bucketed.
SUM_BUCKETS = 1024


def schema_id(schema: T.StructType) -> str:
    return hashlib.sha256(nullable(schema).json().encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Version:
    """One committed day: its attempt, whether its snapshot is kept (and in how many buckets), its schema."""

    day: dt.date
    attempt: str
    kind: str
    schema: str

    @property
    def marker(self) -> str:
        return f"{self.day.isoformat()}_{self.attempt}_{self.kind}_{self.schema}"

    @property
    def kept(self) -> bool:
        return self.kind != "log"

    @property
    def buckets(self) -> int:
        return int(self.kind[1:].split(".")[0]) if self.kept else 0

    @property
    def snapshot(self) -> str:
        """The attempt whose snapshot folder this version has."""
        return self.kind.partition(".")[2] or self.attempt


class _Fs:
    """Listing, markers and small files through the session's Hadoop FileSystem."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, p: str):
        path = self._jvm.org.apache.hadoop.fs.Path(p)
        return path, path.getFileSystem(self._conf)

    def names(self, p: str) -> list[str]:
        path, fs = self._path(p)
        return [st.getPath().getName() for st in fs.listStatus(path)] if fs.exists(path) else []

    def exists(self, p: str) -> bool:
        path, fs = self._path(p)
        return bool(fs.exists(path))

    def mkdirs(self, p: str) -> None:
        path, fs = self._path(p)
        fs.mkdirs(path)

    def delete(self, p: str) -> None:
        path, fs = self._path(p)
        fs.delete(path, True)

    def put(self, file: str, text: str = "") -> None:
        path, fs = self._path(file)
        out = fs.create(path, True)
        try:
            if text:
                out.write(bytearray(text.encode()))
        finally:
            out.close()


class Listing:
    """The committed days, each in its newest attempt."""

    def __init__(self, versions: dict[dt.date, Version], superseded: list[Version], joint: dict[str, list[Version]] | None = None):
        self.versions = dict(sorted(versions.items()))
        self.superseded = superseded
        #: markers of two days at once, not yet replaced by markers of their own
        self.joint = joint or {}

    @property
    def changes(self) -> list[dt.date]:
        return list(self.versions)

    @property
    def snapshots(self) -> list[dt.date]:
        return [d for d, v in self.versions.items() if v.kept]

    complete = snapshots

    @property
    def buckets(self) -> dict[dt.date, int]:
        return {d: v.buckets for d, v in self.versions.items() if v.buckets}

    def before(self, day: dt.date) -> Version | None:
        """The newest committed day before ``day``."""
        return next((self.versions[d] for d in reversed(self.versions) if d < day), None)

    def after(self, day: dt.date) -> Version | None:
        """The first committed day after ``day``."""
        return next((v for d, v in self.versions.items() if d > day), None)

    def epochs(self) -> list[list[Version]]:
        """The committed days in runs of one schema."""
        out: list[list[Version]] = []
        for v in self.versions.values():
            if not out or out[-1][-1].schema != v.schema:
                out.append([])
            out[-1].append(v)
        return out


class Store:
    """A keyed table kept as daily snapshots and changes under ``root``.

    ``keep_snapshot_every``: of the snapshot versions older than the newest
    day's base, those of every n-th calendar day are kept (default 7; None keeps
    all, a full copy a day).
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: str | Sequence[str],
        keep_snapshot_every: int | None = 7,
        strategy: str = "struct",
        broadcast_limit: int | None = None,
        buckets: int | None = None,
    ):
        if buckets is not None and buckets < 1:
            raise ValueError("buckets must be a positive number")
        if keep_snapshot_every is not None and keep_snapshot_every < 1:
            raise ValueError("keep_snapshot_every must be a positive number of days or None")
        self.spark = spark
        self.buckets = buckets
        self.strategy = strategy
        self.broadcast_limit = broadcast_limit
        self.root = root.rstrip("/")
        self.keys = as_keys(keys)
        self.keep_snapshot_every = keep_snapshot_every
        self.snapshot_root = f"{self.root}/snapshot"
        self.change_root = f"{self.root}/changes"
        self.commit_root = f"{self.root}/commits"
        self.sums_root = f"{self.root}/sums"
        self.counts_root = f"{self.root}/counts"
        self.merged_root = f"{self.root}/merged"
        self.ladder_root = f"{self.root}/ladder"
        self.renames_root = f"{self.root}/renames"
        self._fs = _Fs(spark)
        self._schemas: dict[str, T.StructType] = {}

    # -- listing ---------------------------------------------------------
    def listing(self) -> Listing:
        """What is stored, from one listing of the markers."""
        found: dict[tuple[dt.date, str], Version] = {}
        joint: dict[str, list[Version]] = {}
        for name in self._fs.names(self.commit_root):
            parts = [COMMIT_MARK.fullmatch(part) for part in name.split("+")]
            if not all(parts):
                continue
            versions = [Version(dt.date.fromisoformat(m[1]), m[2], m[3], m[4]) for m in parts]
            if len(versions) > 1:
                joint[name] = versions
            for v in versions:
                same = found.get((v.day, v.attempt))
                if same is None or same.kept:  # beside "log" a kept marker is what a prune left
                    found[v.day, v.attempt] = v
        newest: dict[dt.date, Version] = {}
        for v in sorted(found.values(), key=lambda v: v.attempt):
            newest[v.day] = v
        return Listing(newest, [v for v in found.values() if newest[v.day] is not v], joint)

    def snapshot_days(self) -> list[dt.date]:
        return self.listing().snapshots

    def change_days(self) -> list[dt.date]:
        return self.listing().changes

    def complete_days(self) -> list[dt.date]:
        """Days whose changes are committed and whose snapshot version is kept."""
        return self.listing().complete

    def latest_day(self) -> dt.date | None:
        """The newest committed day."""
        days = self.change_days()
        return days[-1] if days else None

    # -- done files of an ingestion -------------------------------------------
    def file_names(self, folder: str) -> list[str]:
        """Names in a folder (one listing)."""
        return sorted(self._fs.names(folder))

    def ingested(self) -> list[str]:
        return self.file_names(f"{self.root}/ingested")

    def record_ingested(self, name: str) -> None:
        self._fs.put(f"{self.root}/ingested/{name}")

    # -- schemas -----------------------------------------------------------
    def _schema(self, sid: str) -> T.StructType:
        if sid not in self._schemas:
            text = self.spark.read.text(f"{self.root}/schemas/{sid}.json", wholetext=True).first()[0]
            self._schemas[sid] = T.StructType.fromJson(json.loads(text))
        return self._schemas[sid]

    def _record(self, schema: T.StructType) -> str:
        sid = schema_id(schema)
        file = f"{self.root}/schemas/{sid}.json"
        if sid not in self._schemas and not self._fs.exists(file):
            self._fs.put(file, nullable(schema).json())
        self._schemas[sid] = nullable(schema)
        return sid

    # -- renamed columns -------------------------------------------------------
    def _renames_file(self, day: dt.date, attempt: str) -> str:
        return f"{self.renames_root}/{day.isoformat()}_{attempt}.json"

    def _renames(self, v: Version | None) -> dict[str, str]:
        """``{old: new}`` of the columns that go on under new names on a committed day."""
        file = v and self._renames_file(v.day, v.attempt)
        if file is None or not self._fs.exists(file):
            return {}
        return json.loads(self.spark.read.text(file, wholetext=True).first()[0])

    def _record_renames(self, day: dt.date, attempt: str, renames: Mapping[str, str]) -> None:
        if renames:
            self._fs.put(self._renames_file(day, attempt), json.dumps(dict(renames)))

    def _resolve_renames(self, renames, prev: DataFrame | None, dump: DataFrame, recorded: Sequence[Version | None]) -> dict[str, str]:
        """What :meth:`integrate` is given, finds (``"detect"``) or, with None, takes over from days that it replaces."""
        if prev is None:
            return {}
        if renames == "detect":
            return renamed_columns(prev, dump, self.keys)
        if renames is not None:
            return check_renames(renames, prev.schema, dump.schema, self.keys)
        if set(prev.columns) == set(dump.columns):
            return {}
        return next((found for v in recorded if (found := fitting_renames(self._renames(v), prev.schema, dump.schema))), {})

    def _last_names(self, ls: Listing) -> dict[dt.date, dict[str, str]]:
        """For each committed day, the names under which its columns go on, where these differ.

        Of two columns that would meet under one name the renamed one keeps its own.
        """
        out: dict[dt.date, dict[str, str]] = {}
        onward: dict[str, str] = {}
        for epoch in reversed(ls.epochs()):
            names = self._schema(epoch[0].schema).fieldNames()
            mine = {c: onward[c] for c in names if onward.get(c, c) != c}
            taken = [mine.get(c, c) for c in names]
            mine = {c: n for c, n in mine.items() if taken.count(n) == 1}
            out.update({v.day: mine for v in epoch})
            renames = self._renames(epoch[0])
            # a column without a successor of its own name ends here, whatever has that name later
            onward = {**{c: mine.get(c, c) for c in names}, **{old: mine.get(new, new) for old, new in renames.items()}}
        return out

    # -- attempts ------------------------------------------------------------
    def _attempt(self, ls: Listing, days: Sequence[dt.date]) -> str:
        """A new attempt's name, above every committed attempt of ``days``."""
        last = max((int(ls.versions[d].attempt[:6]) for d in days if d in ls.versions), default=0)
        return f"{last + 1:06d}-{uuid.uuid4().hex[:8]}"

    def _folder(self, root: str, day, attempt: str) -> str:
        return f"{day_dir(root, day)}/v={attempt}"

    def _commit(self, version: Version, replaced: Version | None) -> None:
        """Switch the day to ``version``; then remove what it replaces."""
        self._fs.put(f"{self.commit_root}/{version.marker}")
        if replaced is not None:
            self._remove(replaced)

    def _remove(self, v: Version, live: Version | None = None) -> None:
        """Remove a replaced version, but not the snapshot that ``live`` has of it."""
        self._fs.delete(f"{self.commit_root}/{v.marker}")
        if live is None or not live.kept or live.snapshot != v.snapshot:
            self._drop_snapshot(v)
        for root in (self.change_root, self.counts_root):
            self._fs.delete(self._folder(root, v.day, v.attempt))
        self._fs.delete(self._renames_file(v.day, v.attempt))

    def _drop_snapshot(self, v: Version) -> None:
        for root in (self.snapshot_root, self.sums_root):
            self._fs.delete(self._folder(root, v.day, v.snapshot))

    def _tidy(self) -> None:
        """What a switch leaves: joint markers become markers of each day, replaced versions go."""
        ls = self.listing()
        for name, versions in ls.joint.items():
            for v in versions:
                if ls.versions[v.day].attempt == v.attempt:
                    self._fs.put(f"{self.commit_root}/{ls.versions[v.day].marker}")
            self._fs.delete(f"{self.commit_root}/{name}")
        for v in ls.superseded:
            self._remove(v, ls.versions[v.day])

    # -- reads -------------------------------------------------------------
    def read_snapshot(self, day=None, listing: Listing | None = None) -> DataFrame:
        """The snapshot version of ``day``; by default the table on the newest day."""
        ls = listing or self.listing()
        if day is None and ls.versions:
            newest = ls.changes[-1]
            return self._table(ls, newest)
        v = ls.versions.get(to_day(day)) if day is not None else None
        if v is None or not v.kept:
            raise FileNotFoundError(f"no snapshot version for {day} under {self.snapshot_root}")
        return self._version_frame(v)

    def _version_frame(self, v: Version) -> DataFrame:
        return self._snapshot_frame(self._folder(self.snapshot_root, v.day, v.snapshot), self._schema(v.schema), v.buckets)

    def _snapshot_frame(self, path: str, schema: T.StructType, buckets: int | None) -> DataFrame:
        """One snapshot folder; a bucketed one is read as a bucketed relation
        (so joins and groupings on the key need no shuffle). Its catalog
        entry is transient and has a name of its own: registered, resolved,
        dropped -- the frame keeps the relation, the catalog keeps nothing,
        the files stay."""
        schema = nullable(schema)
        if not buckets:
            return self.spark.read.schema(schema).parquet(path)
        name = f"daybook_{uuid.uuid4().hex}"
        keys = ", ".join(f"`{k}`" for k in self.keys)
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet "
            f"CLUSTERED BY ({keys}) INTO {int(buckets)} BUCKETS LOCATION '{location}'"
        )
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files are kept

    def _write_snapshot(self, df: DataFrame, path: str) -> None:
        """Write a snapshot version into a new folder; bucketed by the key
        into ``buckets`` files when the store is bucketed (one shuffle of
        ``df``, which later diffs and key checks then never repeat)."""
        if not self.buckets:
            write_parquet(df, path)
            return
        name = f"daybook_{uuid.uuid4().hex}"
        try:
            (
                df.repartition(self.buckets, *[F.col(f"`{k}`") for k in self.keys])
                .write.bucketBy(self.buckets, *self.keys)
                .sortBy(*self.keys)
                .option("path", path)
                .saveAsTable(name)
            )
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files are kept

    def log_schema(self, listing: Listing | None = None) -> T.StructType:
        """The change log's schema on the newest day."""
        ls = listing or self.listing()
        if not ls.versions:
            raise FileNotFoundError(f"nothing stored under {self.root}")
        return change_log_schema(empty_frame(self.spark, self._schema(ls.versions[ls.changes[-1]].schema)), self.keys)

    def _changes(self, versions: Sequence[Version]) -> DataFrame:
        """The change rows of committed days of one schema, those days' folders only."""
        log = change_log_schema(empty_frame(self.spark, self._schema(versions[0].schema)), self.keys)
        schema = T.StructType([*nullable(log).fields, T.StructField("v", T.StringType())])
        paths = [self._folder(self.change_root, v.day, v.attempt) for v in versions]
        return self.spark.read.schema(schema).option("basePath", self.change_root).parquet(*paths).drop("v")

    def read_log(self, after=None, until=None, listing: Listing | None = None) -> DataFrame:
        """The change log of the committed days in ``(after, until]``.

        Days of one schema are read with that schema; over several the images
        have the union of the columns (the newest day's first, null where a day
        lacks one; a column whose type changed is given as text). Renamed columns
        have the last name they got on any committed day.
        """
        ls = listing or self.listing()
        lo, hi = (to_day(x) if x is not None else None for x in (after, until))
        days = [v for d, v in ls.versions.items() if (lo is None or d > lo) and (hi is None or d <= hi)]
        if not days:
            return empty_frame(self.spark, self.log_schema(ls))
        last = self._last_names(ls) if len(ls.epochs()) > 1 else {}
        groups: dict[tuple, list[Version]] = {}
        for v in reversed(days):  # the newest schema first
            groups.setdefault((v.schema, *sorted(last.get(v.day, {}).items())), []).append(v)
        frames = [self._named(self._changes(vs), last.get(vs[0].day)) for vs in groups.values()]
        if len(frames) == 1:
            return frames[0]
        fields: dict[str, T.DataType] = {}
        for f in (f for df in frames for f in df.schema["after"].dataType.fields):
            fields[f.name] = f.dataType if fields.get(f.name, f.dataType) == f.dataType else T.StringType()

        def widened(df: DataFrame, image: str):
            have = {f.name for f in df.schema[image].dataType.fields}
            cols = [(F.col(image).getField(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in fields.items()]
            return F.when(F.col(image).isNotNull(), F.struct(*cols)).alias(image)

        kinds = {k: frames[0].schema[k].dataType for k in self.keys}
        wide = [
            df.select(*[F.col(f"`{k}`").cast(t).alias(k) for k, t in kinds.items()], "op", widened(df, "before"), widened(df, "after"), "day")
            for df in frames
        ]
        return functools.reduce(lambda a, b: a.unionByName(b), wide)

    @staticmethod
    def _named(changes: DataFrame, names: Mapping[str, str] | None) -> DataFrame:
        """Change rows whose images have other names of columns."""
        if not names:
            return changes
        fields = changes.schema["after"].dataType.fields
        dtype = T.StructType([T.StructField(names.get(f.name, f.name), f.dataType) for f in fields])
        return changes.withColumns({side: F.col(side).cast(dtype) for side in ("before", "after")})  # by position

    # -- daily integration -------------------------------------------------
    def integrate(
        self,
        dump: DataFrame,
        day,
        validate: bool = True,
        strategy: str | None = None,
        on_extra: str = "drop",
        cast: bool = False,
        late: str = "error",
        renames: Mapping[str, str] | str | None = None,
    ) -> dict:
        """Record ``dump`` as the table on ``day``.

        1. refuses what can't be compared (column types) before writing anything;
        2. writes the snapshot into a new attempt (one scan of the dump);
        3. checks the key contract on that copy, reading the key columns only;
        4. diffs it against the newest committed day before ``D``, writes the
           attempt's changes, and switches the day to the attempt.
        A run that fails in between removes its attempt and changes nothing.
        A column that the dump lacks leaves the table (its values stay in the
        kept snapshots), stays as nulls (``on_extra="keep"``) or is refused
        (``"error"``). Returns the day's counts, observed during the writes (no
        extra pass).

        A day before the newest one is refused (``late="error"``) or inserted
        (``"insert"``): the changes of the next committed day are written anew,
        as a diff of its table and this dump, and one marker switches both days;
        the counts then name that day as ``next``. An older day that is stored
        already is corrected so.

        ``renames`` (``{old: new}``) names columns of the day before that go on
        under new names; ``"detect"`` finds them (:func:`renamed_columns`, one more
        join where columns come and go). By default a day that is corrected keeps
        its renames, and one inserted before a day with renames has them if they
        fit its columns (``{}``: none). The counts then name them as ``renames``.
        """
        if late not in ("error", "insert"):
            raise ValueError(f"late must be error or insert, not {late!r}")
        d = to_day(day)
        if len(self.keys) == 1:
            dump = normalize_key(dump, self.keys[0])  # P01: an ``id`` column becomes the key
        ls = self.listing()
        follower = ls.after(d)
        if follower and late == "error":
            raise ValueError(f"{d} is before already integrated day {follower.day}; insert it or rebuild from there instead")
        base = ls.before(d)
        prev = self._table(ls, base.day) if base else None
        renames = self._resolve_renames(renames, prev, dump, [ls.versions.get(d), follower])
        if prev is not None:
            aligned = align_columns(prev, dump.schema, on_extra=on_extra, cast=cast, renames=renames)
            if on_extra == "keep":
                dump = align_columns(dump, aligned.schema)
            prev = align_columns(prev, dump.schema, cast=cast, renames=renames)
        following = self._table(ls, follower.day) if follower else None
        next_renames: dict[str, str] = {}
        if following is not None:
            next_renames = fitting_renames(self._renames(follower), dump.schema, following.schema)
            align_columns(dump, following.schema, cast=cast, renames=next_renames)  # refused here if it can't be compared
        attempt = self._attempt(ls, [d, *([follower.day] if follower else [])])
        snap_dir, change_dir = (self._folder(root, d, attempt) for root in (self.snapshot_root, self.change_root))
        written = [snap_dir, change_dir, *[self._renames_file(v, attempt) for v in (d, *([follower.day] if follower else []))]]
        snap_obs, chg_obs, next_obs = Observation("snapshot"), Observation("changes"), Observation("next")
        try:
            self._write_snapshot(dump.observe(snap_obs, F.count(F.lit(1)).alias("rows")), snap_dir)
            new = self._snapshot_frame(snap_dir, dump.schema, self.buckets)  # schema known: no footer job
            if validate:
                require_valid_key(new, self.keys, f"dump of {d}")
            self._write_changes(prev, new, d, change_dir, chg_obs, strategy)
            versions = [Version(d, attempt, f"s{self.buckets or 0}", self._record(dump.schema))]
            self._record_renames(d, attempt, renames)
            if follower:
                next_dir = self._folder(self.change_root, follower.day, attempt)
                written.append(next_dir)
                before = align_columns(new, following.schema, cast=cast, renames=next_renames)
                self._write_changes(before, following, follower.day, next_dir, next_obs, strategy)
                self._record_renames(follower.day, attempt, next_renames)
                kind = f"s{follower.buckets}.{follower.snapshot}" if follower.kept else "log"
                versions.append(Version(follower.day, attempt, kind, follower.schema))
        except BaseException:
            for path in written:
                self._fs.delete(path)
            raise
        if follower:
            self._fs.put(f"{self.commit_root}/{'+'.join(v.marker for v in versions)}")
            self._tidy()
        else:
            self._commit(versions[0], ls.versions.get(d))
            if ls.superseded or ls.joint:  # left by a run that stopped between switch and removal
                self._tidy()
        self._prune()
        none = {"inserts": 0, "updates": 0, "deletes": 0}
        counts = {"day": d, "rows": 0, **self._counts(snap_obs), **none, **self._counts(chg_obs)}
        if follower:
            counts["next"] = {"day": follower.day, **none, **self._counts(next_obs)}
        if renames:
            counts["renames"] = renames
        return counts

    def _write_changes(self, prev: DataFrame | None, new: DataFrame, day: dt.date, path: str, seen: Observation, strategy: str | None) -> None:
        """The changes from ``prev`` (None: a first load) to ``new`` into a new folder."""
        op = F.col("op")
        if prev is not None:
            changes = snapshot_diff(
                prev,
                new,
                self.keys,
                day,
                strategy=strategy or self.strategy,
                broadcast_limit=self.broadcast_limit,
                validate=False,  # new: checked before; prev: checked on its own day
            )
            # A day's changes are a small slice of the table: right-sized files
            # instead of one file per shuffle partition.
            changes = changes.hint("rebalance")
        else:
            changes = first_load(new, self.keys, day)  # all rows, one projection: no shuffle
        observed = changes.observe(
            seen,
            F.count_if(op == INSERT).alias("inserts"),
            F.count_if(op == UPDATE).alias("updates"),
            F.count_if(op == DELETE).alias("deletes"),
        )
        write_parquet(observed.drop("day"), path)

    @staticmethod
    def _counts(seen: Observation) -> dict[str, int]:
        try:
            return {k: int(v or 0) for k, v in seen.get.items()}
        except Py4JJavaError:  # an empty relation that the optimizer folded away has no metrics
            return {}

    def _prune(self) -> None:
        """Drop snapshot versions older than the newest day's base, but for
        every ``keep_snapshot_every``-th day and the last day of each schema."""
        n = self.keep_snapshot_every
        ls = self.listing()
        days = ls.changes
        if n is None or len(days) < 3:
            return
        lasts = {epoch[-1].day for epoch in ls.epochs()}
        for d in days[:-2]:
            v = ls.versions[d]
            if v.kept and d not in lasts and d.toordinal() % n != 0:
                self._fs.put(f"{self.commit_root}/{Version(d, v.attempt, 'log', v.schema).marker}")
                self._fs.delete(f"{self.commit_root}/{v.marker}")
                self._drop_snapshot(v)

    # -- many days at once -------------------------------------------------
    def backfill(
        self,
        dumps: Sequence[tuple[object, DataFrame]],
        chunk_days: int = 7,
        validate: bool = True,
        cast: bool = False,
        renames: Mapping[object, Mapping[str, str]] | str | None = None,
    ) -> list[dt.date]:
        """A05 into the store: integrate many dated dumps, ``chunk_days`` per pass.

        Each chunk (of one schema) is one window pass (:func:`build_change_log`)
        seeded with the table on the day before it, aligned to the chunk's
        columns as :meth:`integrate` does; only the chunk's last day is stored
        as a snapshot version (earlier days are reached by replay). Chunking
        bounds what one job shuffles -- 30 years of full dumps never go through
        one exchange. Days must all be later than the store's latest day.
        ``renames`` gives, by day, the columns that go on under new names that
        day, or is ``"detect"`` (see :meth:`integrate`).
        """
        if chunk_days < 1:
            raise ValueError("chunk_days must be at least 1")
        items = sorted(((to_day(d), df) for d, df in dumps), key=lambda x: x[0])
        if len(self.keys) == 1:
            items = [(d, normalize_key(df, self.keys[0])) for d, df in items]
        days = [d for d, _ in items]
        if len(set(days)) != len(days):
            raise ValueError("two dumps for the same day")
        named = {} if renames is None or renames == "detect" else {to_day(d): r for d, r in renames.items()}
        done = self.listing().changes
        if done and days and days[0] <= done[-1]:
            raise ValueError(f"backfill must start after the latest complete day {done[-1]}")
        chunks: list[list[tuple[dt.date, DataFrame]]] = []
        for d, df in items:
            if not chunks or len(chunks[-1]) == chunk_days or schema_id(chunks[-1][0][1].schema) != schema_id(df.schema):
                chunks.append([])
            chunks[-1].append((d, df))
        stray = {d: r for d, r in named.items() if r and d not in {c[0][0] for c in chunks}}
        if stray:
            raise ValueError(f"renames on days whose dumps have the columns of the day before, or on none: {stray}")
        for chunk in chunks:
            self._backfill_chunk(chunk, validate, cast, "detect" if renames == "detect" else named.get(chunk[0][0]))
        return days

    def _backfill_chunk(self, chunk: list[tuple[dt.date, DataFrame]], validate: bool, cast: bool, renames=None) -> None:
        chunk_days = [d for d, _ in chunk]
        stacked = stack_dumps(chunk, "_dump_day")
        ls = self.listing()
        before = ls.before(chunk_days[0])
        base = self._table(ls, before.day) if before else None
        renames = self._resolve_renames(renames, base, chunk[0][1], [])
        if base is not None:
            base = align_columns(base, chunk[0][1].schema, cast=cast, renames=renames)
        if validate:  # unique per day; the stored base was checked on its own day
            require_valid_keys({f"dumps {chunk_days[0]}..{chunk_days[-1]}": stacked}, self.keys, within=["_dump_day"])
        log = build_change_log(
            stacked, self.keys, days=chunk_days, base=base, day_col="_dump_day", validate=False,
            strategy=self.strategy if base is not None else "struct",  # a first load changes every row
            broadcast_limit=self.broadcast_limit,
        )
        attempt = self._attempt(ls, chunk_days)
        folders = [self._folder(root, d, attempt) for d in chunk_days for root in (self.snapshot_root, self.change_root)]
        try:
            # rebalanced by day: few right-sized files for each
            log.withColumn("v", F.lit(attempt)).hint("rebalance", "day").write.mode("append").partitionBy("day", "v").parquet(self.change_root)
            self._write_snapshot(chunk[-1][1], self._folder(self.snapshot_root, chunk_days[-1], attempt))
            sid = self._record(chunk[0][1].schema)
            self._record_renames(chunk_days[0], attempt, renames)
        except BaseException:
            for path in [*folders, self._renames_file(chunk_days[0], attempt)]:
                self._fs.delete(path)
            raise
        for d in chunk_days:
            self._fs.mkdirs(self._folder(self.change_root, d, attempt))  # a day without changes has no files
            self._commit(Version(d, attempt, f"s{self.buckets or 0}" if d == chunk_days[-1] else "log", sid), None)

    # -- time travel -------------------------------------------------------
    def _table(self, ls: Listing, day: dt.date) -> DataFrame:
        """The table at the end of the committed ``day``, in that day's columns.

        From the nearest kept version before it of the same schema, rolled
        forward; else from the nearest later one of the same schema, rolled
        back; else from the last kept version of an earlier schema, aligned and
        rolled forward schema by schema, as the days were integrated.
        """
        epochs = ls.epochs()
        at = next(i for i, e in enumerate(epochs) if e[0].day <= day <= e[-1].day)
        same = epochs[at]
        kept = [v for v in same if v.kept]
        earlier, later = [v for v in kept if v.day <= day], [v for v in kept if v.day > day]
        if earlier:
            return self._forward(self._version_frame(earlier[-1]), [v for v in same if earlier[-1].day < v.day <= day], ls)
        if later:
            days = [v for v in same if day < v.day <= later[0].day]
            return undo_to(self._version_frame(later[0]), self._window(self._parts(ls, days)), day, self.keys)
        start = max((i for i in range(at) if any(v.kept for v in epochs[i])), default=None)
        if start is None:  # from the first load on
            table, since, start = empty_frame(self.spark, self._schema(epochs[0][0].schema)), None, 0
        else:
            base = [v for v in epochs[start] if v.kept][-1]
            table, since = self._version_frame(base), base.day
        for i, epoch in enumerate(epochs[start : at + 1]):
            renames = self._renames(epoch[0]) if i else None
            table = align_columns(table, self._schema(epoch[0].schema), cast=True, renames=renames)
            table = self._forward(table, [v for v in epoch if (since is None or v.day > since) and v.day <= day], ls)
        return table

    def _forward(self, table: DataFrame, days: Sequence[Version], ls: Listing) -> DataFrame:
        if not days:
            return table
        parts = self._parts(ls, days)
        # one folder holds one change per key: no reduction, so no shuffle of it
        return apply_changes(table, self._window(parts), self.keys, many_days=len(parts) > 1)

    # -- comparison by checksums -------------------------------------------
    def checksums(self, day, buckets: int | None = None) -> DataFrame:
        """Checksums of the kept version of ``day`` by key bucket, stored beside it at first use."""
        v = self.listing().versions.get(to_day(day))
        if v is None or not v.kept:
            raise FileNotFoundError(f"no snapshot version for {day} under {self.snapshot_root}")
        return self._sums(v, buckets or v.buckets or SUM_BUCKETS)

    def _sums(self, v: Version, buckets: int) -> DataFrame:
        path = f"{self._folder(self.sums_root, v.day, v.snapshot)}/n={buckets}"
        if not self._fs.exists(f"{path}/_SUCCESS"):  # never written whole
            self._fs.delete(path)
            bucket_sums(self._version_frame(v), self.keys, buckets).coalesce(1).write.parquet(path)
        return self.spark.read.schema(SUMS).parquet(path)

    def compare(self, day_a, day_b, fanout: int = 64) -> DataFrame:
        """The summary of ``compare_summary`` for the tables of two days.

        Two kept versions of one schema are compared by their checksums first:
        only buckets of keys whose sums differ are read and joined (of versions
        bucketed alike, only these buckets' files); the rows of the others count
        as unchanged. Other days go through the whole comparison.
        """
        ls = self.listing()
        a, b = (ls.versions.get(to_day(d)) for d in (day_a, day_b))
        if not (a and b and a.kept and b.kept and a.schema == b.schema):
            return compare_summary(self.as_of(day_a), self.as_of(day_b), self.keys, validate=False)
        alike = a.buckets == b.buckets and a.buckets > 0
        n = a.buckets if alike else SUM_BUCKETS
        sums = [self._sums(v, n) for v in (a, b)]
        differ = unequal_buckets(*sums, fanout)
        sides = [self._bucket_rows(v, n, differ, files=alike) for v in (a, b)]
        equal = sums[0].where(~F.col("bucket").isin(differ)) if differ else sums[0]
        rest = equal.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_equal"))  # one row
        found = compare(*sides, self.keys, strategy="hash" if len(self._schema(a.schema)) > len(self.keys) else "struct", validate=False)
        change = F.col("change")
        counts = found.agg(*[F.count_if(change == c).cast("bigint").alias(c.lower()) for c in CLASSES])
        whole = counts.crossJoin(rest).withColumn("unchanged", F.col("unchanged") + F.col("_equal")).drop("_equal")  # one row by one row
        return rates(whole)

    def _bucket_rows(self, v: Version, n: int, buckets: Sequence[int], files: bool) -> DataFrame:
        """The rows of some key buckets of a kept version."""
        schema = nullable(self._schema(v.schema))
        if not buckets:
            return empty_frame(self.spark, schema)
        if not files:
            return self._version_frame(v).where(bucket_of(self.keys, n).isin(list(buckets)))
        folder, wanted = self._folder(self.snapshot_root, v.day, v.snapshot), set(buckets)
        named = ((BUCKET_FILE.search(x), x) for x in self._fs.names(folder))
        paths = [f"{folder}/{x}" for m, x in named if m and int(m[1]) in wanted]
        return self.spark.read.schema(schema).parquet(*paths) if paths else empty_frame(self.spark, schema)

    # -- reports from count deltas -----------------------------------------
    def _deltas(self, versions: Sequence[Version], column: str) -> DataFrame:
        """``value, delta`` of days of one schema; days that lack them are counted from their changes, in one job."""
        name = column.encode().hex()
        kind = next(f.dataType for f in self._schema(versions[0].schema) if f.name == column)
        schema = T.StructType([T.StructField("value", nullable(kind)), T.StructField("delta", T.LongType())])
        paths = {v: f"{self._folder(self.counts_root, v.day, v.attempt)}/c={name}" for v in versions}
        missing = [v for v, path in paths.items() if not self._fs.exists(f"{path}/_SUCCESS")]
        if missing:
            deltas = count_deltas(self._changes(missing), self.keys, column)
            attempt = F.create_map(*[F.lit(x) for v in missing for x in (v.day, v.attempt)])[F.col("day")]
            for v in missing:
                self._fs.delete(paths[v])  # never written whole
            named = deltas.withColumn("v", attempt).withColumn("c", F.lit(name)).hint("rebalance", "day")
            named.write.mode("append").partitionBy("day", "v", "c").parquet(self.counts_root)
            for v in missing:  # a day that moves nothing has no files
                self._fs.put(f"{paths[v]}/_SUCCESS")
        return self.spark.read.schema(schema).parquet(*paths.values())

    def _count_state(self, column: str, day) -> DataFrame:
        """``value, delta`` whose sums are the group counts of ``column`` at the end of ``day``.

        Where the schema changes the table's rows are aligned to the new columns,
        and so are their counts: of a column that left, all rows are one null group.
        """
        ls, d = self.listing(), to_day(day)
        if not any(x <= d for x in ls.versions):
            raise FileNotFoundError(f"no committed day up to {d} under {self.root}")
        state: DataFrame | None = None
        has = False
        epochs = [days for epoch in ls.epochs() if (days := [v for v in epoch if v.day <= d])]
        names = [column]  # of the column in each run of days
        for epoch in reversed(epochs[1:]):
            names.insert(0, {new: old for old, new in self._renames(epoch[0]).items()}.get(names[0], names[0]))
        for days, column in zip(epochs, names):
            fields = {f.name: f.dataType for f in self._schema(days[0].schema)}
            has = column in fields
            # without the column only the number of rows goes on, counted by the first key's deltas
            deltas = self._deltas(days, column if has else self.keys[0])
            value = F.col("value") if has else F.lit(None).cast("string")
            parts = [deltas.select(value.alias("value"), "delta")]
            if state is not None:
                kind = fields[column] if has else T.StringType()
                parts.append(state.select((F.col("value").cast(kind) if has else F.lit(None).cast("string")).alias("value"), "delta"))
            state = functools.reduce(lambda a, b: a.unionAll(b), parts)
        if not has:
            raise ValueError(f"the table has no column {column!r} on {d}")
        return state

    def group_count(self, column: str, day) -> DataFrame:
        """G02 on any committed day: ``<column>, count``, from the days' count deltas alone.

        The deltas of a day are written beside it when a report first asks for
        them (all days that lack them in one pass over their changes) and belong
        to its attempt: a rerun or late day has its own. A column's first
        deltas must find the first day's changes, which every store keeps.
        """
        return counts_from(self._count_state(column, day), column)

    def top_n(self, column: str, n: int, day) -> DataFrame:
        """T02/R02-R04 on any committed day, from count deltas alone."""
        return top_n_from(self._count_state(column, day), column, n)

    # -- merged days -------------------------------------------------------
    def _blocks(self, ls: Listing) -> tuple[dict[tuple[int, int], Block], list[Block]]:
        return ladder.valid(self._fs.names(self.ladder_root), ls.versions)

    def _parts(self, ls: Listing, days: Sequence[Version]) -> list[Version | Block]:
        """The folders to open for a run of days: merged blocks where there are any."""
        return ladder.cover(days, self._blocks(ls)[0]) if len(days) > 1 else list(days)

    def _window(self, parts: Sequence[Version | Block]) -> DataFrame:
        """The changes of single days and merged blocks of one schema; a merged
        change is dated with the key's last change in its block."""
        days = [p for p in parts if isinstance(p, Version)]
        blocks = [p for p in parts if isinstance(p, Block)]
        frames = [self._changes(days)] if days else []
        if blocks:
            log = change_log_schema(empty_frame(self.spark, self._schema(blocks[0].schema)), self.keys)
            frames.append(self.spark.read.schema(nullable(log)).parquet(*[f"{self.merged_root}/{b.folder}" for b in blocks]))
        return functools.reduce(lambda a, b: a.unionByName(b), frames)

    def compact_log(self) -> list[tuple[dt.date, dt.date, int]]:
        """Merge the log's days into blocks of 2, 4, 8, ... days that are over.

        A block composes its two halves (two reads, one shuffle by key) and
        counts once its marker is there; the days' own folders stay, as each is
        a time to travel to. Blocks of days that were rerun or added to since
        are built anew, and the old ones' folders go only after that. Returns
        (first day, last day, level) of the blocks built. A run that fails
        leaves what it finished, and the log as it was.
        """
        ls = self.listing()
        if not ls.versions:
            return []
        blocks, stale = self._blocks(ls)
        built = []
        span = (max(ls.versions) - min(ls.versions)).days + 1
        for level in range(1, min(ladder.LEVELS, span.bit_length() + 1) + 1):
            for index, mine in list(ladder.missing(ls.versions, blocks, level)):
                block = Block(index, level, uuid.uuid4().hex[:12], ladder.days_mark(mine), mine[0].schema, tuple(v.day for v in mine))
                path = f"{self.merged_root}/{block.folder}"
                try:
                    net = compose(self._window(ladder.cover(mine, blocks)), self.keys)
                    write_parquet(net.hint("rebalance"), path)
                except BaseException:
                    self._fs.delete(path)
                    raise
                self._fs.put(f"{self.ladder_root}/{block.marker}")
                blocks[level, index] = block
                built.append((block.days[0], block.days[-1], level))
        for b in stale:
            self._fs.delete(f"{self.ladder_root}/{b.marker}")
            self._fs.delete(f"{self.merged_root}/{b.folder}")
        return built

    def as_of(self, day) -> DataFrame:
        """The table at the end of ``day``, with the columns it had then; empty
        (with the first day's columns) before the first day."""
        t, ls = to_day(day), self.listing()
        if not ls.versions:
            raise FileNotFoundError(f"nothing stored under {self.root}")
        days = [d for d in ls.changes if d <= t]
        if not days:
            return empty_frame(self.spark, self._schema(ls.versions[ls.changes[0]].schema))
        return self._table(ls, days[-1])

    def undo_to(self, day) -> DataFrame:
        """Reverse replay from the newest snapshot (reads only the change
        days between ``day`` and that snapshot's day); over a change of columns,
        which can't be undone, the same table as :meth:`as_of`."""
        t, ls = to_day(day), self.listing()
        if not ls.versions:
            raise FileNotFoundError(f"nothing stored under {self.root}")
        last = ls.epochs()[-1]
        kept = [v for v in last if v.kept and v.day >= t]
        if not kept or t < last[0].day:
            return self.as_of(t)
        days = [v for v in last if t < v.day <= kept[-1].day]
        latest = self._version_frame(kept[-1])
        return undo_to(latest, self._window(self._parts(ls, days)), t, self.keys) if days else latest
