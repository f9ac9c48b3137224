"""Versioned tables made of plain parquet folders and a commit log.

Layout under ``root``::

    data/v=<n>/run=<id>/op=<insert|update>[/b=<k>]/*.parquet
    commits/<n>.json                     one row per published version

A table may be *keyed*: its files are Spark buckets of a key, so merges on that
key and reads that drop superseded rows move none of its rows.  Or it may be
*split* by an entity column: rows lie in folders by the column's hash, so a
read of one entity opens one folder, and a version may replace some folders.

A version either replaces the table or adds a part to it, so appending or
merging a batch writes the batch, not the table.  Rows written as ``update``
supersede older rows with the same key; readers drop those with an anti-join,
which is planned only if some version in range has updates.  A merge that
supersedes every row there was replaces the table by what it wrote.  A part counts
once its commit file is there; folders of a failed write are never read.  The
commit file of a version is created exclusively, so of two writers the later
one is refused and leaves nothing that can be read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.frames import one_row
from tidemark.functions.hashing import exact_sum, row_hash
from tidemark.model import ROW_HASH
from tidemark.operators.merge import (
    INSERT,
    NOOP,
    UPDATE,
    classify,
    classify_in_place,
    require_unambiguous,
    require_unique,
    unmatched,
)
from tidemark.session import unsorted_writes

COMMIT_SCHEMA = (
    "version bigint, operation string, replaces boolean, run string, keys string, "
    "num_source bigint, num_inserted bigint, num_updated bigint, rows bigint, "
    "label string, schema_json string, ts timestamp_ntz, layout string, folders array<int>"
)
_LAYOUT = {"v": T.IntegerType(), "run": T.StringType(), "op": T.StringType()}
#: The folder number of a row in a split table.
FOLDER = "b"
_NTH, _NEWEST = "_nth_of_key", "_newest"
#: Of every file a table writes: half the size of the default for hashes kept as hex text.
COMPRESSION = "zstd"
#: No value of a row hash comes often enough for a dictionary.
FILE_OPTIONS = {"compression": COMPRESSION, f"parquet.enable.dictionary#{ROW_HASH}": "false"}
#: Key values of a batch up to which a merge looks only at table rows that have one of them.
PRUNE_VALUES = 100_000
#: Rows of a first batch per bucket or folder at most: a task that sorts one need not spill.
BUCKET_ROWS = 150_000


class MissingTable(LookupError):
    """No committed version to read."""


class VersionedTable:
    """One table; ``keyed`` or ``split_by`` (not both) say how its files lie.

    The number of buckets or folders is fixed by the first version and kept in
    the log; by default it is the session's number of shuffle partitions, or
    more for a table told the size of its first batch (``size_for``).
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keyed: Sequence[str] = (),
        split_by: str | None = None,
        buckets: int | None = None,
    ):
        if keyed and split_by:
            raise ValueError("a table is keyed or split, not both")
        self.spark = spark
        self.root = root.rstrip("/")
        self.keyed, self.split_by, self._buckets = tuple(keyed), split_by, buckets
        self._seen: list | None = None

    def buckets(self) -> int:
        """Buckets or folders of the table."""
        self._log()  # an existing table says how it lies
        return self._buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions", "200"))

    def size_for(self, rows: int) -> None:
        """Before the first version: buckets or folders enough for so many rows."""
        if not self._log() and not self._buckets:
            self._buckets = max(self.buckets(), -(-rows // BUCKET_ROWS))

    def folder_of(self, value: Column) -> Column:
        """The folder in which rows with this value of the split column lie."""
        return F.pmod(F.hash(value), F.lit(self.buckets()))

    def deal(self, df: DataFrame) -> DataFrame:
        """Rows with their folder, one task per folder: Spark deals by the same hash.

        Written as such, they need not move again.
        """
        return df.repartition(self.buckets(), self.split_by).withColumn(
            FOLDER, self.folder_of(F.col(self.split_by))
        )

    # -- log ---------------------------------------------------------------

    def commits(self) -> DataFrame:
        """Commit rows: version, operation, row metrics, label and time."""
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.root}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # unreadable is not the same as absent
            return self.spark.createDataFrame([], COMMIT_SCHEMA)

    def refresh(self) -> "VersionedTable":
        """Look at the log again.

        An object keeps the log it read first or wrote last; versions published
        elsewhere show up after a refresh.
        """
        self._seen = None
        return self

    def _log(self) -> list:
        if self._seen is None:
            # One small row per version ever published.
            self._seen = sorted(self.commits().collect(), key=lambda r: r["version"])
            if self._seen:
                layout = json.loads(self._seen[0]["layout"] or "{}")
                self.keyed = tuple(layout.get("keyed", ()))
                self.split_by, self._buckets = layout.get("split_by"), layout.get("buckets")
        return self._seen

    def exists(self) -> bool:
        return bool(self._log())

    def latest_version(self) -> int | None:
        log = self._log()
        return log[-1]["version"] if log else None

    def row_count(self) -> int:
        """Rows of the latest version, from the log alone."""
        log = self._log()
        return log[-1]["rows"] if log else 0

    def label(self) -> str | None:
        """The label that the latest version was published with."""
        log = self._log()
        return log[-1]["label"] if log else None

    # -- reads -------------------------------------------------------------

    def read(
        self,
        version: int | None = None,
        folders: Sequence[int] | None = None,
        near: Mapping[str, object] | None = None,
    ) -> DataFrame:
        """The table as of ``version`` (latest when omitted).

        ``folders`` narrows a split table to some folders; ``near`` names
        columns with their wanted values, and if the split column is one of
        them, only its folder is listed and read.
        """
        log = self._log()
        only = F.lit(True)
        if folders is not None:
            only = F.col(FOLDER).isin(list(folders))
        elif log and near and self.split_by in near:
            kind = T.StructType.fromJson(json.loads(log[-1]["schema_json"]))[self.split_by].dataType
            only = F.col(FOLDER) == self.folder_of(F.lit(near[self.split_by]).cast(kind))
        return self._frame(log, version, only)

    def changed_since(self, version: int) -> DataFrame | None:
        """Current rows that were written after ``version``; None if it cannot be told.

        Needs the log to hold that version with no replacing version after it but
        merges, whose rows all are new.
        """
        log = self._log()
        later = [r for r in log if r["version"] > version]
        if len(later) == len(log) or any(r["replaces"] and r["operation"] != "MERGE" for r in later):
            return None
        if not later:
            return self._frame(log, None).limit(0)
        if any(r["replaces"] for r in later):
            return self._frame(log, None)
        return self._current(later, [r for r in later if r["num_updated"]])

    def rows_since(self, version: int) -> int:
        """Rows written after ``version``, from the log alone."""
        later = [r for r in self._log() if r["version"] > version]
        return sum(r["num_inserted"] + r["num_updated"] for r in later)

    def _frame(self, log: list, version: int | None, only: Column | None = None) -> DataFrame:
        log = [r for r in log if version is None or r["version"] <= version]
        if not log or (version is not None and log[-1]["version"] != version):
            raise MissingTable(f"no committed version {version or ''} under {self.root}")
        start = max(i for i, r in enumerate(log) if r["replaces"])
        live = log[start:]
        updating = [r for r in live if r["num_updated"] and not r["replaces"]]
        return self._current(live, updating, only)

    def _current(self, live: list, updating: list, only: Column | None = None) -> DataFrame:
        """Rows of some versions without those that an update among them superseded."""
        rows = self._scan(live, only)
        keys = updating[-1]["keys"].split(",") if updating else []
        if updating and self._deals_by_part_of(keys):
            # a window stays in the buckets, where a join wants rows dealt by the whole key
            updated = F.when((F.col("op") == UPDATE) & _whole(keys), F.col("v"))
            newest = F.max(updated).over(Window.partitionBy(*keys))
            rows = rows.withColumn(_NEWEST, newest)
            rows = rows.filter(F.col(_NEWEST).isNull() | (F.col(_NEWEST) <= F.col("v"))).drop(_NEWEST)
        elif updating:
            newest = (
                self._scan(updating)
                .filter(F.col("op") == UPDATE)
                .groupBy(*keys)
                .agg(F.max("v").alias("_superseded_by"))
            )
            same = F.col("r._superseded_by") > F.col("l.v")
            for k in keys:
                same = same & (F.col(f"l.{k}") == F.col(f"r.{k}"))
            rows = rows.alias("l").join(newest.alias("r"), same, "left_anti")
        return rows.drop(*_LAYOUT)

    def _scan(self, log: list, only: Column | None = None) -> DataFrame:
        plain = T.StructType.fromJson(json.loads(log[-1]["schema_json"]))
        schema = T.StructType(list(plain.fields))
        for name, kind in _LAYOUT.items():
            schema = schema.add(name, kind)
        parts = [r for r in log if r["num_inserted"] or r["num_updated"]]
        if not parts:
            return self.spark.createDataFrame([], schema)
        if self.keyed:
            return self.spark.table(self._bucketed(plain)).filter(
                F.col("run").isin([r["run"] for r in parts])
            )
        if self.split_by:
            schema = schema.add(FOLDER, T.IntegerType())
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
        rows = reader.parquet(*[self._part(r["version"], r["run"]) for r in parts])
        if not self.split_by:
            return rows
        taken: set[int] = set()  # folders that a later version replaced
        live = F.lit(False)
        for r in reversed(log):
            own = F.col("run") == r["run"]
            live = live | (own & ~F.col(FOLDER).isin(sorted(taken)) if taken else own)
            taken.update(r["folders"] or ())
        rows = rows.filter(live)
        return (rows if only is None else rows.filter(only)).drop(FOLDER)

    def _bucketed(self, schema: T.StructType) -> str:
        """The session's bucketed table over this folder; made when it is not there yet."""
        name = f"tidemark_{hashlib.md5(self.root.encode()).hexdigest()[:20]}_{self.buckets()}"
        if not self.spark.catalog.tableExists(name):
            columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
            columns += ["v int", "run string", "op string"]
            key = ", ".join(f"`{k}`" for k in self.keyed)
            place = f"{self.root}/data".replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet PARTITIONED BY (v, run, op) "
                f"CLUSTERED BY ({key}) INTO {self.buckets()} BUCKETS LOCATION '{place}' "
                f"TBLPROPERTIES ('parquet.compression' = '{COMPRESSION}')"
            )
        return name

    def _part(self, version: int, run: str) -> str:
        return f"{self.root}/data/v={version}/run={run}"

    # -- writes ------------------------------------------------------------

    def overwrite(self, df: DataFrame, label: str = "") -> int:
        """Publish ``df`` as the whole table in a new version; older ones stay readable."""
        log = self._log()
        version, run, counts = self._write_part(log, df)
        n = counts[INSERT]
        schema = df.drop(FOLDER).schema if self.split_by else df.schema
        return self._publish(log, version, run, schema, "WRITE", True, "", n, n, 0, n, label)

    def replace_folders(self, df: DataFrame, folders: Sequence[int], label: str = "") -> int:
        """Publish ``df`` as all rows of some folders of a split table; the others stay."""
        log = self._log()
        aligned = self._aligned(log, df.drop(FOLDER))
        gone = self._frame(log, None, F.col(FOLDER).isin(list(folders))).count()
        version, run, counts = self._write_part(
            log, df.select(*aligned.columns, FOLDER) if FOLDER in df.columns else aligned
        )
        n = counts[INSERT]
        return self._publish(
            log, version, run, aligned.schema, "REPLACE", False, "", n, n, 0,
            log[-1]["rows"] - gone + n, label, list(folders),
        )

    def relabel(self, label: str) -> int:
        """Publish the same rows under another label."""
        last = self._log()[-1]
        schema = T.StructType.fromJson(json.loads(last["schema_json"]))
        run = "r" + uuid.uuid4().hex[:12]
        return self._publish(
            self._log(), last["version"] + 1, run, schema, "LABEL", False, "", 0, 0, 0, last["rows"], label
        )

    def append(self, df: DataFrame, label: str = "", skip_empty: bool = True) -> int | None:
        """Add ``df`` as a part; a rerun adds it again.  None when there was nothing to add."""
        log = self._log()
        aligned = self._aligned(log, df)
        version, run, counts = self._write_part(log, aligned)
        n = counts[INSERT]
        if n == 0 and skip_empty:
            return None
        total = (log[-1]["rows"] if log else 0) + n
        return self._publish(
            log, version, run, aligned.schema, "APPEND", not log, "", n, n, 0, total, label
        )

    def insert_new(
        self,
        source: DataFrame,
        keys: Sequence[str],
        within: Column | None = None,
        label: str = "",
    ) -> int:
        """Insert-only merge: source rows whose key is not there yet.

        ``within`` narrows the target rows that can match, for example to the
        batch being loaded; parquet statistics then skip every other batch.
        A source with the very keys that are there already is told by its
        counts and sums of key hashes, so sending it again moves no rows.
        """
        log = self._log()
        if not log:
            return self.overwrite(source, label)
        source = self._aligned(log, source)
        target = self._frame(log, None)
        if within is not None:
            target = target.filter(within)
        if target.isEmpty():
            fresh, num_source = source, None
        else:
            sent = _key_print(source, keys)
            num_source, n_partial = sent[:2]
            # rows without a whole key match nothing and insert again
            known = not n_partial and sent == _key_print(target, keys)
            fresh = source.limit(0) if known else unmatched(source, target, keys)
        version, run, counts = self._write_part(log, fresh)
        n = counts[INSERT]
        return self._publish(
            log, version, run, source.schema, "MERGE", False, ",".join(keys),
            n if num_source is None else num_source, n, 0, log[-1]["rows"] + n, label,
        )

    def merge(
        self,
        source: DataFrame,
        keys: Sequence[str],
        update_when: Column | None = None,
        compare: Sequence[str] = (),
        num_source: int | None = None,
        source_unique: bool = False,
        prune_by: str | None = None,
        prune_values: int | None = None,
        label: str = "",
        watch: Callable[[Column], Sequence[Column]] | None = None,
        accept: Callable[[dict], None] | None = None,
    ) -> int:
        """Upsert ``source`` by key; unmatched rows insert, matches update on the condition.

        The table keeps one row per non-NULL key: the first write checks that,
        later ones refuse a source in which several rows match one row.
        ``prune_by`` is a key column with few values per batch: table rows with
        other values cannot match and are left out before any shuffle; their number
        is counted unless ``prune_values`` tells it, about.

        ``watch`` gives aggregates over the source rows, told the number of a
        row among those with its key; they are observed while the rows are
        written.  ``accept`` gets their values and may raise: the version is
        then not published, and what was written is never read.
        """
        log = self._log()
        seen = Observation() if watch else None
        if not log:
            if watch:
                watched = self._numbered(source, keys)
                watched = watched.observe(seen, *watch(F.col(_NTH))).drop(_NTH)
                part = self._write_part(log, watched)
                accept(seen.get)
                version, run, counts = part
                n = counts[INSERT]
                return self._publish(log, version, run, source.schema, "WRITE", True, "", n, n, 0, n, label)
            if not source_unique:
                require_unique(source.dropna(subset=list(keys)), keys)
            return self.overwrite(source, label)
        source = self._aligned(log, source)
        others = {r["keys"] for r in log if r["num_updated"]} - {",".join(keys)}
        if others:
            raise ValueError(f"{self.root} was merged on {others}, not on {tuple(keys)}")
        target = self._frame(log, None)
        if prune_by is not None:
            target = _only_values_of(source, target, prune_by, not self.keyed, prune_values)
        if not source_unique:
            require_unambiguous(source, target, keys)
        schema = source.schema
        if watch and self._deals_by_part_of(keys):
            changes = classify_in_place(self._dealt(source), target, keys, update_when, compare, _NTH)
        else:
            source = self._numbered(source, keys) if watch else source
            changes = classify(source, target, keys, update_when, compare)
        if watch:
            changes = changes.observe(seen, *watch(F.col(_NTH))).drop(_NTH)
        version, run, counts = self._write_part(log, changes.filter(F.col("op") != NOOP))
        if watch:
            accept(seen.get)
            num_source = seen.get["rows"] if num_source is None else num_source
        inserted, updated = counts[INSERT], counts[UPDATE]
        every = 0 < updated == log[-1]["rows"]  # as keys are unique, no older row is left
        return self._publish(
            log, version, run, schema, "MERGE", every, ",".join(keys),
            source.count() if num_source is None else num_source,
            inserted, updated, log[-1]["rows"] + inserted, label,
        )

    def _deals_by_part_of(self, keys: Sequence[str]) -> bool:
        return bool(self.keyed) and set(self.keyed) < set(keys)

    def _numbered(self, source: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Source rows numbered within their key, dealt as the table's buckets are."""
        each = Window.partitionBy(*keys).orderBy(*keys)
        return self._dealt(source).withColumn(_NTH, F.row_number().over(each))

    def _dealt(self, source: DataFrame) -> DataFrame:
        return source.repartition(self.buckets(), *self.keyed) if self.keyed else source

    def has_updates(self) -> bool:
        """Whether reads of the latest version have superseded rows to drop."""
        return self.superseded_rows() > 0

    def superseded_rows(self) -> int:
        """Rows that reads of the latest version drop, from the log alone."""
        log = self._log()
        start = max((i for i, r in enumerate(log) if r["replaces"]), default=0)
        return sum(r["num_updated"] for r in log[start:] if not r["replaces"])

    def compact(self) -> int:
        """Write the current rows as one replacing version, so reads need no anti-join."""
        return self.overwrite(self.read(), label="compact")

    def _aligned(self, log: list, df: DataFrame) -> DataFrame:
        if not log:
            return df
        schema = T.StructType.fromJson(json.loads(log[-1]["schema_json"]))
        have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        want = {f.name: f.dataType.simpleString() for f in schema.fields}
        if have != want:
            raise ValueError(f"schema of {self.root} is {want}, batch has {have}")
        return df.select(*schema.names)

    def _write_part(self, log: list, rows: DataFrame) -> tuple[int, str, dict[str, int]]:
        version = log[-1]["version"] + 1 if log else 0
        run = "r" + uuid.uuid4().hex[:12]
        path = self._part(version, run)
        if self.keyed:
            self._write_buckets(rows, version, run)
        elif self.split_by:
            by = self._sorted_by(rows.drop(FOLDER))
            into = f"{path}/op={INSERT}"
            if FOLDER in rows.columns:  # a task has few folders; rows that a window sorted stay so
                placed = rows.sortWithinPartitions(*by)
                with unsorted_writes(self.spark):
                    placed.write.partitionBy(FOLDER).options(**FILE_OPTIONS).parquet(into)
            else:
                # Spark splits a folder that is too large for one task and joins small ones
                placed = rows.withColumn(FOLDER, self.folder_of(F.col(self.split_by)))
                placed = placed.hint("rebalance", FOLDER).sortWithinPartitions(FOLDER, *by)
                placed.write.partitionBy(FOLDER).options(**FILE_OPTIONS).parquet(into)
        elif "op" in rows.columns:
            rows.write.partitionBy("op").options(**FILE_OPTIONS).parquet(path)
        else:  # one folder: keeps the row order the plan produced
            rows.write.options(**FILE_OPTIONS).parquet(f"{path}/op={INSERT}")
        # Counted from file footers, so task retries cannot distort the metrics.
        try:
            op_only = self.spark.read.schema("op string").option("basePath", path).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return version, run, {INSERT: 0, UPDATE: 0}  # no bucket had a row
        n = op_only.agg(
            F.count_if(F.col("op") == INSERT).alias(INSERT),
            F.count_if(F.col("op") == UPDATE).alias(UPDATE),
        ).first()
        return version, run, n.asDict()

    def _sorted_by(self, rows: DataFrame) -> list[str]:
        """The split column first: point reads then skip row groups too."""
        return [self.split_by, *[c for c in rows.columns if c != self.split_by][:3]]

    def _write_buckets(self, rows: DataFrame, version: int, run: str) -> None:
        op = F.col("op") if "op" in rows.columns else F.lit(INSERT)
        plain = rows.drop("op")
        place = {"v": F.lit(version), "run": F.lit(run), "op": op}
        # one file per bucket
        dealt = rows.withColumns(place).repartition(self.buckets(), *self.keyed)
        name = self._bucketed(plain.schema)
        with unsorted_writes(self.spark):  # a task has one bucket, so at most a file per op
            dealt.select(*plain.columns, *place).write.insertInto(name)
        self.spark.catalog.refreshTable(name)

    def _publish(
        self, log, version, run, schema, operation, replaces, keys,
        num_source, num_inserted, num_updated, rows, label, folders=None,
    ) -> int:
        layout = {"keyed": self.keyed, "split_by": self.split_by}
        layout = {k: v for k, v in layout.items() if v}
        layout = json.dumps(layout | {"buckets": self.buckets()}) if layout else None
        row = (
            version, operation, replaces, run, keys, num_source, num_inserted, num_updated,
            rows, label, schema.json(), datetime.now(timezone.utc).replace(tzinfo=None),
            layout, folders,
        )
        line = one_row(self.spark, row, COMMIT_SCHEMA).select(F.to_json(F.struct("*"))).first()[0]
        path = f"{self.root}/commits/{version:012d}.json"
        if not create_file(self.spark, path, line):
            raise RuntimeError(f"another writer published version {version} of {self.root}")
        self.refresh()
        return version


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it exists; False if it does.

    Exclusive on stores that create files atomically, such as HDFS and local
    disks; plain object stores need a committer that is.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = store.create(target, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def move_folder(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a folder of one store; False if it is not there."""
    hadoop = spark._jvm.org.apache.hadoop
    source, target = hadoop.fs.Path(path), hadoop.fs.Path(to)
    store = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(source):
        return False
    store.mkdirs(target.getParent())
    if not store.rename(source, target):
        raise OSError(f"cannot rename {path} to {to}")
    return True


def _key_print(rows: DataFrame, keys: Sequence[str]) -> tuple[int, int, str, str]:
    """Rows, rows without a whole key, and two order-free sums over the keys' SHA-256.

    A key with the hash of its row in it is not hashed so again.
    """
    hashed = [F.col(k) for k in keys] if ROW_HASH in keys else [row_hash(keys)]
    sums = [exact_sum(F.xxhash64(F.lit(seed), *hashed)).cast("string") for seed in (1, 2)]
    return tuple(rows.agg(F.count(F.lit(1)), F.count_if(~_whole(keys)), *sums).first())


def _whole(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _only_values_of(
    source: DataFrame, target: DataFrame, column: str, moves: bool, n_values: int | None = None
) -> DataFrame:
    """Target rows whose ``column`` value the source has.

    Few values are broadcast; of many, a target that would have to move is
    narrowed by a join, and one whose join moves nothing is left as it is.
    """
    values = source.select(column).distinct()
    if n_values is None:
        n_values = values.limit(PRUNE_VALUES + 1).count()
    if n_values <= PRUNE_VALUES:
        values = F.broadcast(values)
    elif not moves:
        return target
    return target.join(values, column, "left_semi").select(*target.columns)
