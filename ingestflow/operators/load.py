"""Loading staged files through a named pipe definition, with per-file statistics.

A pipe names a file format (CSV or JSON lines parsed from text, or a typed
columnar format), the schema of the target table and an error policy:

* ``CONTINUE``  — good records load, a file with some bad ones is
  ``PARTIALLY_LOADED``;
* ``SKIP_FILE`` / ``ABORT_STATEMENT`` — a file with any bad record loads
  nothing and is ``LOAD_FAILED``.

A file with errors only is ``LOAD_FAILED`` under every policy; a file without
errors (including an empty one) is ``LOADED``.  A file that is not there, or
of which nothing can be read, is ``LOAD_FAILED`` on its own row.

Text formats are read as lines and parsed with ``from_csv`` / ``from_json``
in PERMISSIVE mode with a corrupt-record column: counting bad records on the
parsed line, rather than through the CSV reader, keeps the count independent
of which columns a query happens to read.  Records that are not single lines
(``multiLine``) and files with a ``header`` go through the format's own reader
with column pruning off, for the same reason.

Files are chosen before anything is read: the listing is joined with the
wanted paths and the load history, and only the files that remain are opened.
"""

from __future__ import annotations

import dataclasses
import re
import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.functions.timing import ts_literal
from ingestflow.sources.files import CHECKED_SUFFIXES, file_damage, file_sizes, visible_copies

CORRUPT = "_corrupt_record"
BLANK = "_blank_line"
MISSING_FILE_TEXT = "File not found"
UNREADABLE_FILE_TEXT = "File cannot be read"
DAMAGED_FILE_TEXT = "File is damaged: "
KIND, BAD_TEXT = "_record_kind", "_bad_text"
READ_ERROR = re.compile(r"FAILED_READ_FILE[^\]]*\] Encountered error while reading file (\S+?)\.\s")
# Prefix of the first-error text.
FIRST_ERROR_PREFIX = "Invalid record: "
TEXT_FORMATS = ("csv", "json")
ON_ERROR_VALUES = ("CONTINUE", "SKIP_FILE", "ABORT_STATEMENT")


@dataclasses.dataclass(frozen=True)
class PipeSpec:
    """A named load definition: format, target schema, options and error policy."""

    name: str
    format: str = "csv"
    schema_ddl: str = "value string"
    options: dict = dataclasses.field(default_factory=dict)
    target: str | None = None
    on_error: str = "CONTINUE"

    def __post_init__(self):
        if self.on_error not in ON_ERROR_VALUES:
            raise ValueError(f"on_error must be one of {ON_ERROR_VALUES}")

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema_ddl)

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def _uses_reader(spec: PipeSpec) -> bool:
    """Whether records are not simply the lines of the files."""
    on = {k.lower(): str(v).lower() for k, v in spec.options.items()}
    return "true" in (on.get("header"), on.get("multiline"))


def parse_lines(lines: DataFrame, spec: PipeSpec, value_col: str = "value",
                keep_blank: bool = False) -> DataFrame:
    """Parse each text line into the pipe's schema; adds the fields and ``_corrupt_record``.

    Blank lines carry no record (they would otherwise parse as all-null rows
    that are not flagged as bad): they are dropped, or, with ``keep_blank``,
    flagged in ``_blank_line`` so that a file of blank lines is still seen.
    """
    fmt = spec.format.lower()
    if fmt not in TEXT_FORMATS:
        raise ValueError(f"parse_lines handles {TEXT_FORMATS}, not {spec.format}")
    if _uses_reader(spec):
        raise ValueError("header and multiLine cannot be honoured on single lines; use load_files")
    schema = T.StructType(spec.schema.fields + [T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **spec.options}
    v = F.col(value_col)
    record = v.isNotNull() & (F.length(F.trim(v)) > 0)
    parsed = (F.from_csv(v, f"{spec.schema_ddl}, {CORRUPT} STRING", opts)
              if fmt == "csv" else F.from_json(v, schema, opts))
    if keep_blank:
        out = lines.withColumn("__rec", F.when(record, parsed))
        extra = [(~record).alias(BLANK)]
    else:
        out, extra = lines.where(record).withColumn("__rec", parsed), []
    return out.select(*[c for c in lines.columns], *extra,
                      *[F.col("__rec").getField(n).alias(n) for n in spec.field_names],
                      F.col("__rec").getField(CORRUPT).alias(CORRUPT))


def _parse_barrier(parsed: DataFrame) -> DataFrame:
    """Stop filters on parsed fields from being pushed under the parse.

    A filter on ``_corrupt_record`` would otherwise be rewritten onto the
    parser expression itself, and every line would be parsed twice.
    ``inline`` of a one-element array is a Generate node, which predicates
    on its output cannot cross.
    """
    return parsed.select(F.inline(F.array(F.struct(*[F.col(c) for c in parsed.columns]))))


def file_stats(parsed: DataFrame, spec: PipeSpec, path_col: str = "path",
               order_col: str = "pos", raw_col: str = "value") -> DataFrame:
    """Per-file load statistics: status, rows parsed/loaded, errors, first error.

    One partially-aggregated pass: the first error is ``min_by`` over an
    ordering key that is null on clean lines (``min_by`` skips null keys),
    so no window or sort over a file's lines is needed; the value is nulled
    on clean lines too, which keeps the aggregation rows narrow.

    Trade-off kept on purpose: a string-valued ``min_by`` makes this a
    sort-based aggregate (interpreted).  Computing counts with a hash
    aggregate and the first error over bad lines separately measured faster
    on one machine, but reads and parses every input file twice — at
    cluster scale the second scan costs more than it saves.
    """
    bad = F.col(CORRUPT).isNotNull()
    records = F.count_if(~F.col(BLANK)) if BLANK in parsed.columns else F.count(F.lit(1))
    agg = parsed.groupBy(path_col).agg(
        records.alias("rows_parsed"),
        F.count_if(bad).alias("errors_seen"),
        F.min_by(F.when(bad, F.col(raw_col)), F.when(bad, F.col(order_col)))
        .alias("__first_bad"))
    return _outcome(agg.withColumn("path", F.col(path_col)), spec)


def _outcome(agg: DataFrame, spec: PipeSpec) -> DataFrame:
    """Status and counts of the files whose records and errors were counted."""
    errors = F.col("errors_seen")
    good = F.col("rows_parsed") - errors
    all_or_nothing = spec.on_error != "CONTINUE"
    status = (F.when(errors == 0, "LOADED")
              .when(good == 0, "LOAD_FAILED")
              .otherwise("LOAD_FAILED" if all_or_nothing else "PARTIALLY_LOADED"))
    loaded = F.when(errors == 0, F.col("rows_parsed")).otherwise(
        F.lit(0).cast("long") if all_or_nothing else good)
    return agg.select(
        F.lit(spec.name).alias("pipe"),
        "path",
        status.alias("status"),
        F.col("rows_parsed").cast("long").alias("rows_parsed"),
        loaded.cast("long").alias("rows_loaded"),
        errors.cast("long").alias("errors_seen"),
        F.when(errors > 0, F.concat(F.lit(FIRST_ERROR_PREFIX), F.col("__first_bad")))
         .alias("first_error"))


def loaded_rows(parsed: DataFrame, spec: PipeSpec, path_col: str = "path",
                stats: DataFrame | None = None) -> DataFrame:
    """The records that reach the target table under the pipe's error policy.

    ``CONTINUE`` keeps every clean record.  Under the all-or-nothing
    policies a clean record is kept only when its file had no error: an
    anti-join with the files that had one, which is the smaller list; Spark
    broadcasts it when it measures it as small, and splits the partition of a
    file with most of the lines otherwise.
    """
    extra = [BLANK] if BLANK in parsed.columns else []
    kept = _parse_barrier(parsed.select(path_col, *extra, *spec.field_names, CORRUPT))
    good = kept.where(F.col(CORRUPT).isNull())
    if extra:
        good = good.where(~F.col(BLANK))
    if spec.on_error != "CONTINUE":
        st = stats if stats is not None else file_stats(parsed, spec, path_col)
        failed = st.where(F.col("errors_seen") > 0).select(F.col("path").alias(path_col))
        good = good.join(failed, path_col, "left_anti")
    return good.select(F.col(path_col).alias("path"), *spec.field_names)


def next_run(history: DataFrame | None) -> int:
    """The number of the next load run: one more than any entry has."""
    last = history.agg(F.max("seq")).first()[0] if history is not None else None
    return 1 if last is None else last + 1


def as_history(stats: DataFrame, loaded_at, run: int = 1) -> DataFrame:
    """Stamp per-file statistics as history entries of one load run.

    ``seq`` is the run's number: it grows from run to run (``next_run``)
    whatever the clock says, and a run has one entry per (pipe, path), so the
    latest entry of a file is well defined.
    """
    return stats.withColumns({"event_ts": ts_literal(loaded_at), "seq": F.lit(run).cast("long")})


def claim_run(spark: SparkSession, folder: str, history: DataFrame | None = None) -> int:
    """The number of a new run that no other run has, however many begin at once.

    A run creates the file of its number in ``folder`` (shared by all runs);
    only one can, and the others try the next number.
    """
    jvm = spark._jvm
    number = next_run(history)
    while True:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/run-{number}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path.getParent())
        try:
            # Hadoop's local file system looks first and creates then; Java's own call is one step.
            own = jvm.java.io.File(path.toUri().getPath()) if fs.getUri().getScheme() == "file" else None
            if own.createNewFile() if own is not None else fs.createNewFile(path):
                return number
        except Py4JJavaError as e:
            if "AlreadyExists" not in str(e.java_exception.getClass().getName()):
                raise
        number += 1


def normalise_path(c, encoded: bool = False):
    """One spelling of a file's path, whichever way it was written.

    ``file:/x``, ``file:///x`` and ``/x`` are ``/x``; other schemes keep scheme
    and authority; repeated slashes are one.  ``encoded`` is for the file paths
    of Spark's metadata column, which are percent-encoded.  The path of every
    line goes through here, so the regular expressions are left for the paths
    that need them; most need none.
    """
    if encoded:
        c = F.when(F.contains(c, F.lit("%")), F.url_decode(F.regexp_replace(c, r"\+", "%2B"))).otherwise(c)
    local = F.when(F.startswith(c, F.lit("file:///")), F.substring(c, len("file:///"), 2 ** 31 - 1)) \
        .when(F.startswith(c, F.lit("file:")), F.regexp_replace(c, r"^file:(//(localhost)?(?=/))?", "")).otherwise(c)
    repeated = F.contains(F.replace(local, F.lit("://"), F.lit(":")), F.lit("//"))
    return F.when(repeated, F.regexp_replace(local, r"(?<![:/])/{2,}|(?<=^)/{2,}", "/")).otherwise(local)


def _plain(path: str) -> str:
    return re.sub(r"(?<![:/])/{2,}|^/{2,}", "/", re.sub(r"^file:(//(localhost)?(?=/))?", "", path))


def rows_of_runs(spark: SparkSession, rows_dir: str, history: DataFrame) -> DataFrame:
    """The rows below ``rows_dir`` (one folder ``run=<n>`` a run) of the runs that ``history`` has.

    A run that was cut short has rows but no entries; its files are loaded
    again by a later run.
    """
    ended = history.select(F.col("seq").cast("int").alias("run")).distinct()
    return spark.read.parquet(rows_dir).join(ended, "run", "left_semi")


def normalise_root(spark: SparkSession, location: str) -> str:
    """The spelling of a folder that the paths of its files begin with."""
    root = spark._jvm.org.apache.hadoop.fs.Path(location)
    return _plain(root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString()).rstrip("/")


def absolute_path(spark: SparkSession, c, location: str):
    """The path of a file that is named by a relative path.

    It is taken from the working directory if that lies below ``location``,
    else from ``location``, as a stage's own names are.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(location)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    base = normalise_root(spark, location)
    here = F.concat(F.lit(_plain(fs.getWorkingDirectory().toString()).rstrip("/") + "/"), c)
    return F.when(c.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|/)"), c) \
        .when(F.startswith(here, F.lit(base + "/")), here).otherwise(F.concat(F.lit(base + "/"), c))


def list_staged(spark: SparkSession, location: str, path_glob: str | None = None) -> DataFrame:
    """``path, raw, length`` of the files under ``location`` that are not empty.

    Spark's own listing: the content column is not asked for, so nothing is read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.load(location).select(normalise_path(F.col("path")).alias("path"),
                                        F.col("path").alias("raw"), "length")


def _literal_path(path: str) -> str:
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def read_staged(spark: SparkSession, spec: PipeSpec, paths: list[str], strict: bool = False) -> DataFrame:
    """Read the given files: (path, value, pos) lines of text formats, else (path, fields).

    ``pos`` orders lines within a file: the split's start offset, then the
    row's position inside the split (which is read sequentially).
    Compressed text files (gzip, bzip2, …) are decoded by the reader.
    ``strict`` makes a file that breaks off an error; otherwise what can be
    read of it is read.
    """
    path = normalise_path(F.col("_metadata.file_path"), encoded=True).alias("path")
    pos = F.struct(F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("row")).alias("pos")
    fmt = spec.format.lower()
    literal = [_literal_path(p) for p in paths]
    reader = spark.read.option("ignoreCorruptFiles", str(not strict).lower()).option("ignoreMissingFiles", "true")
    if fmt in TEXT_FORMATS and not _uses_reader(spec):
        if not literal:
            return spark.createDataFrame([], "path string, value string, pos struct<block: long, row: long>")
        return reader.text(literal).select(path, F.col("value"), pos)
    corrupt = [T.StructField(CORRUPT, T.StringType())] if fmt in TEXT_FORMATS else []
    schema = T.StructType(spec.schema.fields + corrupt)
    if not literal:
        extra = "pos struct<block: long, row: long>, " if corrupt else ""
        return spark.createDataFrame([], f"path string, {extra}{schema.simpleString()[7:-1]}")
    if corrupt:
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                                columnPruning="false", **spec.options)
    df = reader.schema(schema).format(fmt).load(literal)
    return df.select(path, *([pos] if corrupt else []), *schema.names)


def already_loaded(history: DataFrame, spec: PipeSpec) -> DataFrame:
    """Paths this pipe has loaded (latest entry ``LOADED`` or ``PARTIALLY_LOADED``).

    A pipe does not load the same file twice; a failed load may be retried.
    """
    from ingestflow.operators.history import latest_per_file
    mine = history.where(F.col("pipe") == F.lit(spec.name)) \
        .withColumn("path", normalise_path(F.col("path")))
    latest = latest_per_file(mine)
    return latest.where(F.col("status").isin("LOADED", "PARTIALLY_LOADED")).select("path")


def file_outcomes(files: DataFrame, stats: DataFrame, spec: PipeSpec) -> DataFrame:
    """Statistics of every wanted file: ``stats`` where something was read, else by ``size``.

    ``files`` has ``path`` and ``size`` (null: not there).  An empty file is
    ``LOADED`` with no rows; one that is not there, or gave nothing although it
    is not empty, is ``LOAD_FAILED`` with an error.
    """
    silent = files.select("path", "size").dropDuplicates(["path"]).join(
        stats.select("path"), "path", "left_anti")
    empty = F.col("size") == 0
    zero = [F.lit(0).cast("long").alias(c) for c in ("rows_parsed", "rows_loaded")]
    return stats.unionByName(silent.select(
        F.lit(spec.name).alias("pipe"), "path",
        F.when(empty, "LOADED").otherwise("LOAD_FAILED").alias("status"), *zero,
        F.when(empty, 0).otherwise(1).cast("long").alias("errors_seen"),
        F.when(empty, F.lit(None)).when(F.col("size").isNull(), MISSING_FILE_TEXT)
         .otherwise(UNREADABLE_FILE_TEXT).alias("first_error")))


@dataclasses.dataclass
class _Chosen:
    """The files of a load: ``raw`` paths that Spark reads, and every wanted ``path`` with its size."""

    raw: list[str]
    files: DataFrame
    copies: DataFrame | None = None

    def read(self, spark: SparkSession, spec: PipeSpec, raw: list[str] | None = None,
             strict: bool = False) -> DataFrame:
        """As :func:`read_staged`; lines of a copy carry the path of the file it stands for."""
        records = read_staged(spark, spec, self.raw if raw is None else raw, strict)
        if self.copies is None:
            return records
        names = self.copies.select(normalise_path(F.col("raw")).alias("path"), F.col("path").alias("__of"))
        return records.join(names, "path", "left").withColumn("path", F.coalesce("__of", "path")).drop("__of")


def _choose(spark: SparkSession, spec: PipeSpec, location: str, files: DataFrame | None,
            path_glob: str | None, history: DataFrame | None) -> _Chosen:
    """Decide by lists alone which files a load reads.

    The paths come to the driver, which holds the same list as the file index
    of the scan.  A wanted file that Spark's listing lacks is looked at by
    itself: it is empty, not there, or one that the readers pass over for its
    name (``_x``, ``.x``) and read through a copy.
    """
    staged = list_staged(spark, location, path_glob)
    if files is None:
        wanted = staged.select("path")
    else:
        wanted = files.select(normalise_path(absolute_path(spark, F.col("path"), location)).alias("path")).distinct()
    if history is not None:
        wanted = wanted.join(already_loaded(history, spec), "path", "left_anti")
    raw = [r.raw for r in staged.join(wanted, "path", "left_semi").select("raw").toLocalIterator()]
    listed = wanted.join(staged.select("path", F.col("length").alias("size")), "path")
    if files is None:
        return _Chosen(raw, listed)
    from ingestflow.session import materialize, shared_dir
    others = materialize(file_sizes(wanted.join(staged.select("path"), "path", "left_anti")), "load-others")
    there = others.where(F.col("size") > 0)
    passed_over = F.regexp_extract("path", "[^/]*$", 0).rlike(r"^[_.]|\._COPYING_$")
    raw += [r.path for r in there.where(~passed_over).select("path").toLocalIterator()]
    hidden, copies = there.where(passed_over), None
    if not hidden.isEmpty():
        folder = f"{shared_dir(spark).rstrip('/')}/ingestflow/copies-{uuid.uuid4().hex}"
        copies = materialize(visible_copies(hidden, folder), "load-copies")
        raw += [r.raw for r in copies.select("raw").toLocalIterator()]
    return _Chosen(raw, listed.unionByName(others), copies)


def _parsed(chosen: _Chosen, spark: SparkSession, spec: PipeSpec, raw: list[str] | None = None,
            strict: bool = False) -> tuple[DataFrame, str]:
    """Parsed records of a text format, and the column with the text of bad ones."""
    records = chosen.read(spark, spec, raw, strict)
    if _uses_reader(spec):
        # The readers refuse to be asked for the corrupt-record column alone.
        return _parse_barrier(records), CORRUPT
    return parse_lines(records, spec, keep_blank=True), "value"


def _columnar_stats(records: DataFrame, spec: PipeSpec) -> DataFrame:
    n = F.count(F.lit(1)).alias("rows_parsed")
    return records.groupBy("path").agg(n).select(
        F.lit(spec.name).alias("pipe"), "path", F.lit("LOADED").alias("status"), "rows_parsed",
        F.col("rows_parsed").alias("rows_loaded"), F.lit(0).cast("long").alias("errors_seen"),
        F.lit(None).cast("string").alias("first_error"))


def _with_damage(stats: DataFrame, damage: DataFrame, spec: PipeSpec) -> DataFrame:
    """Statistics in which a file that breaks off has one more error and is not ``LOADED``.

    ``CONTINUE`` keeps what could be read of it; the other policies load nothing.
    """
    d = damage.select("path", F.col("damage").alias("__why"), F.col("promised").alias("__promised"))
    short = F.col("__promised") > F.col("rows_parsed")
    broken = F.coalesce(F.col("__why").isNotNull() | short, F.lit(False))
    kept = F.lit(0).cast("long") if spec.on_error != "CONTINUE" else F.col("rows_loaded")
    why = F.coalesce("first_error", F.concat(F.lit(DAMAGED_FILE_TEXT), F.coalesce(
        F.col("__why"), F.concat(F.col("rows_parsed").cast("string"), F.lit(" of "),
                                 F.col("__promised").cast("string"), F.lit(" rows")))))
    return stats.join(d, "path", "left").select(
        "pipe", "path",
        F.when(broken, F.when(kept > 0, "PARTIALLY_LOADED").otherwise("LOAD_FAILED"))
         .otherwise(F.col("status")).alias("status"), "rows_parsed",
        F.when(broken, kept).otherwise(F.col("rows_loaded")).alias("rows_loaded"),
        F.when(broken, F.col("errors_seen") + 1).otherwise(F.col("errors_seen")).alias("errors_seen"),
        F.when(broken, why).otherwise(F.col("first_error")).alias("first_error"))


def _damage_of(spark: SparkSession, spec: PipeSpec, chosen: _Chosen) -> DataFrame | None:
    """What :func:`file_damage` says of the chosen files that can be checked, if any can."""
    fmt = spec.format.lower()
    if fmt not in ("parquet", "orc") and not any(p.endswith(CHECKED_SUFFIXES) for p in chosen.raw):
        return None
    check = F.lit(True) if fmt in ("parquet", "orc") else \
        F.lower("path").rlike("(" + "|".join(re.escape(s) for s in CHECKED_SUFFIXES) + ")$")
    return file_damage(chosen.files.where((F.col("size") > 0) & check), fmt)


def load_files(spark: SparkSession, spec: PipeSpec, location: str, files: DataFrame | None = None,
               path_glob: str | None = None,
               history: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Load staged files: returns (target rows, per-file statistics), both still to be computed.

    ``files`` (column ``path``) lists the files to load; relative paths are
    those of the stage at ``location``.  ``history`` makes the load skip files
    that this pipe already loaded.  Lists are joined with the listing, never
    lines: only the chosen files are opened.  Rows and statistics read the
    files each for itself; :func:`load_once` reads them once.  Streams and
    footers that can be checked are, so a file that breaks off is reported as
    damaged and not as ``LOADED``.
    """
    chosen = _choose(spark, spec, location, files, path_glob, history)
    fmt = spec.format.lower()
    if fmt in TEXT_FORMATS:
        parsed, raw_col = _parsed(chosen, spark, spec)
        stats = file_stats(parsed, spec, raw_col=raw_col)
        if _uses_reader(spec):
            # A file of a header alone gives no record; its lines show that it can be read.
            lines = chosen.read(spark, PipeSpec(spec.name)).select("path").distinct()
            stats = _seen_without_records(lines, stats, spec)
    else:
        parsed = chosen.read(spark, spec)
        stats = _columnar_stats(parsed, spec)
    damage = _damage_of(spark, spec, chosen)
    if damage is not None:
        stats = _with_damage(stats, damage, spec)
    rows = loaded_rows(parsed, spec, stats=stats) if fmt in TEXT_FORMATS else parsed
    if fmt not in TEXT_FORMATS and spec.on_error != "CONTINUE":
        rows = rows.join(stats.where(F.col("errors_seen") > 0).select("path"), "path", "left_anti")
    return rows, file_outcomes(chosen.files, stats, spec)


def _seen_without_records(lines: DataFrame, stats: DataFrame, spec: PipeSpec) -> DataFrame:
    return file_outcomes(lines.withColumn("size", F.lit(0).cast("long")), stats, spec)


def load_once(spark: SparkSession, spec: PipeSpec, location: str, files: DataFrame | None = None,
              path_glob: str | None = None,
              history: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """As :func:`load_files`, computed now: every file is opened and parsed once.

    The records are written as one table in the shared folder, marked by
    whether they are good, as they are read (a folder for each kind would sort
    every task's records first); rows and statistics are read from it, so neither
    opens a source file again.  The first errors are found among the bad records
    alone: with them, counting would sort all records by file.  Files are read strictly; if one cannot be read
    to its end, the damaged ones are found, the others are read strictly again,
    and what can be read of the damaged ones is read.
    """
    from ingestflow.session import materialize

    chosen = _choose(spark, spec, location, files, path_glob, history)
    chosen.files = materialize(chosen.files, "load-chosen")
    text = spec.format.lower() in TEXT_FORMATS

    def table(raw: list[str], strict: bool, name: str) -> DataFrame:
        if not text:
            return materialize(chosen.read(spark, spec, raw, strict).withColumn(KIND, F.lit("good")), name)
        parsed, raw_col = _parsed(chosen, spark, spec, raw, strict)
        bad = F.col(CORRUPT).isNotNull()
        blank = F.col(BLANK) if BLANK in parsed.columns else F.lit(False)
        parts = _parse_barrier(parsed).select(
            "path", *spec.field_names, F.when(bad, F.col(raw_col)).alias(BAD_TEXT), F.when(bad, F.col("pos")).alias("pos"),
            F.when(bad, "bad").when(blank, "blank").otherwise("good").alias(KIND))
        return materialize(parts, name)

    broken: dict[str, str] = {}  # the path of a damaged file, and why
    while True:
        good = [p for p in chosen.raw if _plain(p) not in broken]
        try:
            held = table(good, True, "load")
            break
        except Exception as e:  # noqa: BLE001 - only errors that name a file are taken up
            named = {_plain(unquote(p)) for p in READ_ERROR.findall(str(e))}
            found = {} if broken else {_plain(r.raw): r.damage for r in _broken_streams(spark, spec, chosen)}
            found |= {p: UNREADABLE_FILE_TEXT for p in named - found.keys()}
            new = {p: w for p, w in found.items() if p in {_plain(g) for g in good}}
            if not new:
                raise
            broken |= new
    damaged = [p for p in chosen.raw if _plain(p) in broken]
    if damaged:
        held = held.unionByName(table(damaged, False, "load-damaged"))
    records = F.count_if(F.col(KIND) != "blank").alias("rows_parsed")
    if text:
        counted = held.groupBy("path").agg(records, F.count_if(F.col(KIND) == "bad").alias("errors_seen"))
        firsts = held.where(F.col(KIND) == "bad").groupBy("path").agg(F.min_by(BAD_TEXT, "pos").alias("__first_bad"))
        stats = _outcome(counted.join(firsts, "path", "left"), spec)
    else:
        stats = _columnar_stats(held, spec)
    failed = spark.createDataFrame(list(broken.items()), "raw string, damage string") if broken else None
    if failed is not None:
        of = chosen.copies.select(normalise_path(F.col("raw")).alias("raw"), "path") if chosen.copies is not None \
            else spark.createDataFrame([], "raw string, path string")
        failed = failed.join(of, "raw", "left").select(F.coalesce("path", "raw").alias("path"), "damage",
                                                       F.lit(None).cast("long").alias("promised"))
        stats = _with_damage(stats, failed, spec)
    rows = held.where(F.col(KIND) == "good").select("path", *spec.field_names)
    if spec.on_error != "CONTINUE":
        rows = rows.join(stats.where(F.col("errors_seen") > 0).select("path"), "path", "left_anti")
    # What was read strictly and gave no record can be read: it holds none.
    sizes = chosen.files
    if failed is not None:
        sizes = sizes.join(failed.select("path", F.lit(True).alias("__failed")), "path", "left")
        read = F.col("__failed").isNull() & F.col("size").isNotNull()
    else:
        read = F.col("size").isNotNull()
    return rows, file_outcomes(sizes.select("path", F.when(read, 0).otherwise(F.col("size")).alias("size")), stats, spec)


def _broken_streams(spark: SparkSession, spec: PipeSpec, chosen: _Chosen) -> list[Row]:
    """(raw, damage) of the compressed files that break off: the few a load fails for."""
    if not any(p.endswith(CHECKED_SUFFIXES) for p in chosen.raw) or spec.format.lower() not in TEXT_FORMATS:
        return []
    paths = spark.createDataFrame([(p,) for p in chosen.raw if p.endswith(CHECKED_SUFFIXES)], "path string")
    return file_damage(paths, spec.format.lower()).where("damage is not null") \
        .select(F.col("path").alias("raw"), "damage").collect()


def load_through_pipes(spark: SparkSession, specs: list[PipeSpec], requests: DataFrame, location: str,
                       history: DataFrame | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Load (pipe, path) requests, each through its own pipe: (rows by pipe, statistics of all).

    ``specs`` are the pipe definitions; one pass for each pipe reads its files
    alone, each once.  Requests for a pipe that is not defined load nothing and have no
    statistics (their submission failed).
    """
    rows, stats = {}, None
    for spec in specs:
        wanted = requests.where(F.col("pipe") == F.lit(spec.name)).select("path")
        rows[spec.name], part = load_once(spark, spec, location, wanted, history=history)
        stats = part if stats is None else stats.unionByName(part)
    return rows, stats
