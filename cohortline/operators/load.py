"""Loads: rolling-window replace (U23) and full refresh (U24).

``replace_window`` is the DataFrame form: the target without the window's
days, plus the recomputed rows. ``publish_window`` applies it to a stored
table that is partitioned by day, publishing new folders for the window's days only.
Both keep rows whose day is null (a range delete never matches them).

A load of a stored table never writes into files that a reader may have open. It writes folders of its
own and then changes the catalog: the partition locations of the window's days in one
call, the location of a table without partitions, or the name of a table. Until that call
readers see the old rows, after it the new ones.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.operators.dedup import first_hit
from cohortline.operators.keyfilter import keep_keys


class LoadConflict(RuntimeError):
    """Another load of an overlapping window was published after this one began; nothing was changed."""


def in_window(day_col: str, lo: dt.date, hi: dt.date):
    """``date(day_col) between lo and hi``; null when the day is null."""
    return F.to_date(F.col(day_col)).between(F.lit(lo), F.lit(hi))


def replace_window(target: DataFrame, new: DataFrame, day_col: str,
                   lo: dt.date, hi: dt.date) -> DataFrame:
    """Target rows outside ``[lo, hi]`` (null days kept) plus ``new``.

    Idempotent: replacing the same window with the same rows again gives the
    same result. Columns are matched by name.
    """
    keep = ~F.coalesce(in_window(day_col, lo, hi), F.lit(False))
    return target.where(keep).unionByName(new)


def dedup_target(target: DataFrame, keys: list[str], day_col: str, tiebreak: list[str]) -> DataFrame:
    """One row per key of a table that windows were loaded into: the earliest
    by ``day_col``, ties by ``tiebreak``.

    A window load inserts a key again when it is seen in a later window; this
    is the view of the table in which each key counts once.
    """
    return first_hit(target, keys, [day_col], tiebreak)


# --- files ------------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, path = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _finish(spark: SparkSession, path: str) -> None:
    """Give a written folder its final name."""
    fs, temporary = _fs(spark, f"{path}.tmp")
    fs.rename(temporary, _fs(spark, path)[1])


def _create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not exist yet; false if it does.

    Exactly one of several writers succeeds, on HDFS and local file systems, and on
    object stores whose connector refuses to overwrite.
    """
    fs, p = _fs(spark, path)
    data = (text + "\n").encode()
    if fs.getScheme() == "file":
        try:
            handle = os.open(p.toUri().getPath(), os.O_WRONLY | os.O_CREAT | os.O_EXCL)
        except FileExistsError:
            return False
        with os.fdopen(handle, "wb") as out:
            out.write(data)
        return True
    try:
        out = fs.create(p, False)
    except Exception as error:
        if fs.exists(p):
            return False
        raise error
    out.write(bytearray(data))
    out.close()
    return True


def _read_file(spark: SparkSession, path: str) -> str:
    """The line of a file made by :func:`_create_new`, once it is there in full."""
    for _ in range(100):
        lines = [r[0] for r in spark.read.text(path).collect()]
        if lines:
            return lines[0]
        time.sleep(0.1)
    raise RuntimeError(f"{path} stays empty")


# --- stored tables -------------------------------------------------------------------

def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """The detail rows of ``DESCRIBE TABLE EXTENDED`` by name."""
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _location(spark: SparkSession, table: str) -> str:
    return _described(spark, table)["Location"]


def _buckets(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """Number of buckets and bucket columns; (0, []) for a table without."""
    said = _described(spark, table)
    names = re.findall(r"`([^`]+)`", said.get("Bucket Columns", ""))
    return (int(said["Num Buckets"]), names) if names else (0, [])


def _is_partitioned(spark: SparkSession, table: str, partition_col: str) -> bool:
    return any(c.name == partition_col and c.isPartition for c in spark.catalog.listColumns(table))


def bucket_rows(rows: DataFrame, buckets: int, bucket_cols: list[str], partition_col: str | None = None) -> DataFrame:
    """``rows`` dealt out as a bucketed write files them: a task per bucket (and day), so a file per bucket (and day)."""
    bucket = F.pmod(F.hash(*bucket_cols), F.lit(buckets))
    return rows.repartition(partition_col, bucket) if partition_col else rows.repartition(buckets, *bucket_cols)


def _write_days(rows: DataFrame, path: str, partition_col: str, buckets: int, bucket_cols: list[str]) -> None:
    """Day folders under ``path``, bucketed as the table is."""
    spark = rows.sparkSession
    if not buckets:
        rows.hint("rebalance", partition_col).write.partitionBy(partition_col).parquet(path)
        return
    # Only a catalog table can be written in buckets; its entry goes, its files stay.
    entry = f"load_{uuid.uuid4().hex}"
    (bucket_rows(rows, buckets, bucket_cols, partition_col).write.partitionBy(partition_col).bucketBy(buckets, *bucket_cols)
     .format("parquet").option("path", path).saveAsTable(entry))
    spark.sql(f"DROP TABLE {entry}")


def _partitions(spark: SparkSession, table: str) -> list:
    """The catalog's partition objects of a table."""
    state = spark._jsparkSession.sessionState()
    found = state.catalog().listPartitions(state.sqlParser().parseTableIdentifier(table), spark._jvm.scala.Option.empty())
    return [found.apply(i) for i in range(found.size())]


def _replaced(case_class, position: int, value):
    """A copy of a Scala case class with one field (from 1) replaced."""
    fields = [getattr(case_class, f"copy$default${k}")() for k in range(1, case_class.productArity() + 1)]
    fields[position - 1] = value
    return case_class.copy(*fields)


def _overwrite_days(spark: SparkSession, table: str, partition_col: str, places: dict[str, str]) -> None:
    """Point the partitions of all days of ``places`` (day -> folder) to their new folders.

    All in one call to the catalog, which SQL has no statement for: a reader
    sees the old folders of every day or the new ones of every day.
    """
    jvm, state = spark._jvm, spark._jsparkSession.sessionState()
    changed = jvm.java.util.ArrayList()
    for part in _partitions(spark, table):
        day = part.spec().apply(partition_col)
        if day in places:
            place = jvm.scala.Option.apply(_fs(spark, places[day])[1].toUri())
            changed.add(_replaced(part, 2, _replaced(part.storage(), 1, place)))
    parts = jvm.org.apache.spark.api.python.PythonUtils.toSeq(changed)
    state.catalog().alterPartitions(state.sqlParser().parseTableIdentifier(table), parts)
    spark.catalog.refreshTable(table)


class _Loads:
    """The loads of one table: their folders, and the versions that were published.

    ``<table>/_loads/<run>`` holds a load's rows and, once they are complete, its
    window. Version n is claimed by creating the file ``v<n>``, which only one load can; the
    claim names the run. ``v<n>.done`` follows when the catalog points to the run's folders.
    """

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.spark, self.table = spark, table
        self.root = _location(spark, table).split("/_loads/")[0]
        self.folder = f"{self.root}/_loads"
        fs, path = _fs(spark, self.folder)
        fs.mkdirs(path)

    def version(self) -> int:
        return max([0, *(int(n[1:]) for n in _listed(self.spark, self.folder) if re.fullmatch(r"v\d+", n))])

    def claim_of(self, version: int) -> dict:
        return json.loads(_read_file(self.spark, f"{self.folder}/v{version}"))

    def claims(self) -> dict[int, dict]:
        """All claims by version, read by one job however many there are."""
        names = [n for n in _listed(self.spark, self.folder) if re.fullmatch(r"v\d+", n)]
        if not names:
            return {}
        lines = self.spark.read.text([f"{self.folder}/{n}" for n in names]).select("_metadata.file_name", "value").collect()
        found = {int(r[0][1:]): json.loads(r[1]) for r in lines}
        return {v: found.get(v) or self.claim_of(v) for v in sorted(int(n[1:]) for n in names)}

    def is_done(self, version: int) -> bool:
        return version == 0 or _exists(self.spark, f"{self.folder}/v{version}.done")

    def done(self, version: int) -> None:
        _create_new(self.spark, f"{self.folder}/v{version}.done", "{}")

    def claim(self, run: str, lo: dt.date, hi: dt.date, since: int) -> int | None:
        """The version that ``run`` is published as; None if another load has published it already.

        Versions after ``since`` that replaced days of the window are a conflict; the
        load of other days goes on top of them.
        """
        name = run.rsplit("/", 1)[1]
        while True:
            for version in range(since + 1, self.version() + 1):
                if not _exists(self.spark, f"{self.folder}/v{version}"):
                    raise LoadConflict(f"so many loads of {self.table} came between that version {version} is forgotten")
                other = self.claim_of(version)
                if other["run"] == name:
                    return None
                if other["lo"] <= hi.isoformat() and other["hi"] >= lo.isoformat():
                    raise LoadConflict(f"days {other['lo']} to {other['hi']} of {self.table} were loaded meanwhile")
                since = version
            if _create_new(self.spark, f"{self.folder}/v{since + 1}",
                           json.dumps({"run": name, "lo": lo.isoformat(), "hi": hi.isoformat()})):
                return since + 1

    def staged(self) -> list[str]:
        """Finished stages that no version names, oldest first: loads that failed, or are about to be published."""
        claimed = {c["run"] for c in self.claims().values()}
        runs = [n for n in _listed(self.spark, self.folder) if not re.fullmatch(r"v\d+(\.done)?", n)]
        return [f"{self.folder}/{n}" for n in runs if n not in claimed and _exists(self.spark, f"{self.folder}/{n}/window")]

    def prune(self) -> None:
        """Delete day folders that the loads before the last one replaced, and what is left of loads that have no
        day in the table any more; a reader has had a load's time to finish."""
        plain = lambda path: re.sub("^file:/+", "/", path)
        used = {plain(p.location().toString()) for p in _partitions(self.spark, self.table)}
        done = {n for n in _listed(self.spark, self.folder) if n.endswith(".done")}
        runs = {v: f"{self.folder}/{c['run']}" for v, c in self.claims().items() if f"v{v}.done" in done}
        last = max(runs, default=0)
        for folder in [self.root, *(f"{r}/rows" for v, r in runs.items() if v < last)] if runs else []:
            for name in _listed(self.spark, folder):
                place = f"{folder}/{name}"
                if "=" in name and plain(place) not in used and not name.endswith("__HIVE_DEFAULT_PARTITION__"):
                    _delete(self.spark, place)
        for version, run in runs.items():
            if version < last and not any(u.startswith(plain(run) + "/") for u in used):
                for path in (run, f"{self.folder}/v{version}", f"{self.folder}/v{version}.done"):
                    _delete(self.spark, path)


def _only_first(rows: DataFrame, loads: _Loads, run: str, key: str, lo: dt.date, hi: dt.date, partition_col: str,
                horizon: int | None) -> tuple[DataFrame, list[dt.date]]:
    """The window's rows whose key no earlier day has, with the later days that lose a row to the window.

    Of the stored table only the key and the day are read, of the days within ``horizon`` of the window, and rows
    with another key than the window's are dropped by a bitmap before the join.
    """
    spark = rows.sparkSession
    rows.write.parquet(f"{run}/found")
    rows = spark.read.schema(rows.schema).parquet(f"{run}/found")
    stored, day = spark.table(loads.table), F.col(partition_col)
    if horizon is not None:
        stored = stored.where(day.between(F.lit(lo - dt.timedelta(days=horizon)), F.lit(hi + dt.timedelta(days=horizon))))
    keys = rows.select(F.col(key).alias("__key"))
    others = keep_keys(stored.where((day < F.lit(lo)) | (day > F.lit(hi))).select(key, partition_col), key, keys, "__key")
    matched = others.join(keys, F.col(key) == F.col("__key"), "left_semi")
    matched.write.parquet(f"{run}/matched")  # a part of the window's keys
    matched = spark.read.schema(matched.schema).parquet(f"{run}/matched")
    first = rows.join(matched.where(day < F.lit(lo)), key, "left_anti")
    late = matched.where(day > F.lit(hi))
    days = sorted(r[0] for r in late.select(partition_col).distinct().collect())
    if days:
        left = spark.table(loads.table).where(day.isin(days)).join(late, [key, partition_col], "left_anti")
        first = first.unionByName(left)
    return first.select(*rows.columns), days


def _stage_run(new: DataFrame, loads: _Loads, day_col: str, lo: dt.date, hi: dt.date, partition_col: str,
               once_by: str | None = None, horizon: int | None = None) -> str:
    """Write the new rows in the table's form and then, as the mark of a complete stage, the window."""
    spark = new.sparkSession
    run = f"{loads.folder}/{time.time_ns():020d}-{uuid.uuid4().hex}"
    rows = new.where(in_window(day_col, lo, hi)).withColumn(partition_col, F.to_date(F.col(day_col)))
    schema, more = spark.table(loads.table).schema, []
    rows = rows.select(*(F.col(f.name).cast(f.dataType) for f in schema),
                       *([] if partition_col in schema.names else [partition_col]))
    if once_by:
        rows, more = _only_first(rows, loads, run, once_by, lo, hi, partition_col, horizon)
    _write_days(rows, f"{run}/rows", partition_col, *_buckets(spark, loads.table))
    window = spark.createDataFrame([(lo, hi, more)], "lo date, hi date, more array<date>")
    window.coalesce(1).write.parquet(f"{run}/window.tmp")
    _finish(spark, f"{run}/window")
    return run


def _window_of(spark: SparkSession, run: str) -> tuple[dt.date, dt.date, list[dt.date]]:
    """First and last day of a stage's window, and the later days it replaces."""
    return tuple(spark.read.parquet(f"{run}/window").first())


def _rewrite(spark: SparkSession, run: str, table: str, day_col: str, lo: dt.date, hi: dt.date) -> None:
    """A table without day partitions is written anew, from a complete copy in the
    stage; the table's location is then changed to the new files. A rewrite that
    failed halfway is repeated from that copy."""
    if not _exists(spark, f"{run}/table"):
        now = spark.table(table)
        rows = spark.read.parquet(f"{run}/rows").select(*now.columns)
        replace_window(now, rows, day_col, lo, hi).write.parquet(f"{run}/table.tmp")
        _finish(spark, f"{run}/table")
    place = f"{run}/whole-{uuid.uuid4().hex}"
    spark.read.parquet(f"{run}/table").write.parquet(place)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
    spark.catalog.refreshTable(table)


def _apply_run(spark: SparkSession, run: str, loads: _Loads, day_col: str, partition_col: str, version: int) -> None:
    """Bring a claimed stage into the table; doing it again changes nothing.

    Days that the table does not have yet are first added with an empty folder, which no
    reader notices; then one call gives all days of the window their new folders, and days
    without rows, by now empty, are dropped. A failure at any point leaves the claim
    without its end mark, and the next load repeats the stage before its own window.
    """
    table = loads.table
    lo, hi, more = _window_of(spark, run)
    if not _is_partitioned(spark, table, partition_col):
        _rewrite(spark, run, table, day_col, lo, hi)
        loads.done(version)
        return
    filled = set(_listed(spark, f"{run}/rows"))
    days = [str(lo + dt.timedelta(days=i)) for i in range((hi - lo).days + 1)] + [str(day) for day in more]
    empty = {day: f"{run}/empty/{partition_col}={day}" for day in days}
    for place in empty.values():
        fs, path = _fs(spark, place)
        fs.mkdirs(path)
    known = {part.spec().apply(partition_col) for part in _partitions(spark, table)}
    added = " ".join(f"PARTITION ({partition_col} = DATE'{day}') LOCATION '{empty[day]}'" for day in days if day not in known)
    if added:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    name = f"{partition_col}={{}}".format
    places = {day: f"{run}/rows/{name(day)}" if name(day) in filled else empty[day] for day in days}
    if loads.version() != version:
        raise LoadConflict(f"{table}: version {version} was taken over by a later load")
    _overwrite_days(spark, table, partition_col, places)
    gone = ", ".join(f"PARTITION ({partition_col} = DATE'{day}')" for day in days if name(day) not in filled)
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {gone}")
    loads.done(version)


def _recover(loads: _Loads, day_col: str, partition_col: str) -> None:
    """Finish what earlier loads left behind: a version without its end mark, then complete stages."""
    spark, last = loads.spark, loads.version()
    if not loads.is_done(last):
        _apply_run(spark, f"{loads.folder}/{loads.claim_of(last)['run']}", loads, day_col, partition_col, last)
    for run in loads.staged():
        lo, hi, more = _window_of(spark, run)
        version = loads.claim(run, lo, max([hi, *more]), loads.version())
        if version is not None:
            _apply_run(spark, run, loads, day_col, partition_col, version)


def publish_window(new: DataFrame, table: str, day_col: str, lo: dt.date, hi: dt.date,
                   partition_col: str = "hit_day", once_by: str | None = None, horizon: int | None = None) -> str:
    """Replace days ``[lo, hi]`` of ``table`` with ``new``; returns ``table``.

    The new rows are written once, as day folders of this load (in the table's buckets, if it
    has any, one file per day and bucket), while readers go on with the old ones. Then
    the load claims the table's next version and points the window's partitions to its folders in one
    call to the catalog: a reader sees the window before or after it, never half. Of two loads of
    overlapping windows that ran at the same time the second to claim raises
    :class:`LoadConflict` and changes nothing; loads of different days follow one another.

    A load that fails on the way leaves its folders, and the next load of the
    table, whatever its window, publishes them first: no day is lost. Rows with
    a null day live in the default partition and are never touched; rows of
    ``new`` outside the window are not loaded. Replaced folders are deleted by the load after the next.

    With ``once_by`` (a column that ``new`` has once per value) the table keeps a key only on
    its earliest day: rows of the window whose key an earlier day has are not loaded, and a later day loses its row to the
    window. Of the stored table just the keys and days within ``horizon`` days of the window
    are read (default: of all days), and only the window and those later days are written, in the same one change. Rows with a
    null key are kept as they are.

    A table without day partitions is rewritten whole, from a complete copy that
    is staged first. A missing table is created with day partitions. The catalog has no
    conditional change: a load that stands still between its last look at the version
    and its call to the catalog, for as long as another load takes, can undo that load.
    """
    spark: SparkSession = new.sparkSession
    if not spark.catalog.tableExists(table):
        (new.limit(0).withColumn(partition_col, F.to_date(F.col(day_col)))
         .write.partitionBy(partition_col).format("parquet").saveAsTable(table))
    loads = _Loads(spark, table)
    _recover(loads, day_col, partition_col)
    since = loads.version()
    partitioned = _is_partitioned(spark, table, partition_col)
    if once_by and not partitioned:
        raise ValueError(f"{table} has no day partitions: once_by needs them")
    if partitioned:
        loads.prune()
    run = _stage_run(new, loads, day_col, lo, hi, partition_col, once_by, horizon)
    try:
        version = loads.claim(run, lo, max([hi, *_window_of(spark, run)[2]]), since)
    except LoadConflict:
        _delete(spark, run)
        raise
    if version is not None:
        _apply_run(spark, run, loads, day_col, partition_col, version)
    return table


# --- create or replace ----------------------------------------------------------------

def _base(spark: SparkSession, table: str) -> str:
    """Where files of a table are put: beside those it has, or in its database's folder."""
    if spark.catalog.tableExists(table):
        place = re.sub(r"/_loads/.*", "", _location(spark, table))
        return re.sub(r"\.v-[0-9a-f]{32}$", "", place)
    name = table.rsplit(".", 1)
    said = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE {name[0] if len(name) > 1 else spark.catalog.currentDatabase()}").collect()}
    return f"{said['Location']}/{name[-1]}"


def replace_table(df: DataFrame, table: str, partition_by: str | None = None, buckets: int | None = None,
                  bucket_cols: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Create ``table`` with ``df``, or replace it, without a time in which it is missing its rows.

    The rows are written aside first (``path`` or the table's place, with a suffix of their own); a failed write
    leaves the table as it was, and ``df`` may read the table itself. A table of the same columns
    without partitions and buckets then has its location changed, one call to the catalog. Any
    other takes the name of the old one, which keeps its rows under ``<table>__old`` for the moment
    between two renames; if the driver dies there, the next call gives it its name back.
    The files replaced stay for readers that have them open until the table is replaced again.
    """
    spark = df.sparkSession
    old = f"{table}__old"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
    known = spark.catalog.tableExists(table)
    base = path or _base(spark, table)
    before = _location(spark, table) if known else ""
    place = f"{base}.v-{uuid.uuid4().hex}"
    entry = f"{table}__new_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", place)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_cols)
    writer.saveAsTable(entry)
    plain = not partition_by and not buckets
    if known and plain and _same_form(spark, entry, table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
        spark.sql(f"DROP TABLE {entry}")
        spark.catalog.refreshTable(table)
    else:
        if known:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {entry} RENAME TO {table}")
        if known:
            spark.sql(f"DROP TABLE {old}")
    parent, name = base.rsplit("/", 1)
    for other in _listed(spark, parent):
        if re.fullmatch(re.escape(name) + r"\.v-[0-9a-f]{32}", other) and other not in (place.rsplit("/", 1)[1], before.rsplit("/", 1)[-1]):
            _delete(spark, f"{parent}/{other}")
    return spark.table(table)


def _same_form(spark: SparkSession, new: str, table: str) -> bool:
    """Whether two tables have the same columns and neither has partitions or buckets."""
    kinds = [[(f.name, f.dataType) for f in spark.table(t).schema] for t in (new, table)]
    said = _described(spark, table)
    return (kinds[0] == kinds[1] and "Num Buckets" not in said and said.get("Provider", "").lower() == "parquet"
            and not any(c.isPartition for c in spark.catalog.listColumns(table)))


def full_refresh(df: DataFrame, *, table: str | None = None, path: str | None = None) -> DataFrame:
    """Create or replace ``table`` (see :func:`replace_table`), or the parquet folder ``path``,
    with ``df`` and return the stored rows. The write cuts the lineage: later
    reads start from the stored files, not from the inputs."""
    spark = df.sparkSession
    if (table is None) == (path is None):
        raise ValueError("give exactly one of table or path")
    if table is not None:
        return replace_table(df, table)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
