"""Reader for quarterly ``$``-delimited drops."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.functions.text import quarter_label
from casewright.operators.projections import rename_columns
from casewright.operators.standardize import clean_cells, drop_na_tokens
from casewright.sources.lines import MERGED_RECORDS, split_merged_records

LATIN1 = "ISO-8859-1"
PROBES_AT_ONCE = 16
#: Files of one header that are read by a scan each, so that their name and quarter are constants; more of them share a scan, as each costs some 75 ms to plan.
MOST_SCANS = 32


def logical_name(path: Column) -> Column:
    """Name of the ``.txt`` a path belongs to: the file itself, or the folder of its part files."""
    name = F.substring_index(path, "/", -1)
    parent = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(F.lower(name).startswith("part-") & F.lower(parent).endswith(".txt"), parent).otherwise(name)


def logical_path(path: Column) -> Column:
    name = F.substring_index(path, "/", -1)
    return F.when(logical_name(path) == name, path).otherwise(F.substring(path, F.lit(1), F.length(path) - F.length(name) - 1))


def file_quarter(path: Column) -> Column:
    """Quarter named by the file, else by the nearest folder above it."""
    return F.coalesce(quarter_label(logical_name(path)), quarter_label(F.regexp_extract(path, r"(?i).*(\d{4}q[1-4])", 1)))


def discover(spark: SparkSession, path: str, kind: str | None = None, folder: str | None = "ascii") -> DataFrame:
    """Input files as (path, file_name, kind, quarter, length).

    Takes ``.txt`` of any case below a folder ``ascii`` of any case whose name
    starts with a file kind; statistics and size files are left out. Only the
    listing is read, never the contents.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    # A scan has no rows for files without a byte; the listing names them.
    names = [(re.sub("^file:/+", "file:/", unquote(p)), 0) for p in listed.inputFiles()]
    listed = listed.unionByName(spark.createDataFrame(names, listed.schema).join(listed, "path", "left_anti"))
    name = logical_name(F.col("path"))
    kinds = "|".join([kind] if kind else S.FILE_KINDS)
    out = listed.filter(name.rlike(rf"(?i)^({kinds}).*\.txt$") & ~name.rlike("(?i)stat|size"))
    if folder:
        out = out.filter(F.col("path").rlike(f"(?i)/{folder}/"))
    return out.select(
        "path", name.alias("file_name"), F.lower(F.regexp_extract(name, f"(?i)^({kinds})", 1)).alias("kind"),
        file_quarter(F.col("path")).alias("quarter"), "length",
    )


@dataclass(frozen=True)
class HeaderGroup:
    """Files of one kind that share one header line and may share one scan, with the quarter of each."""

    kind: str
    header: list[str]
    paths: list[str]
    quarters: list[str | None]


@dataclass(frozen=True)
class Probe:
    """What the start of a file tells: its header, or why it cannot be read; required columns it lacks."""

    kind: str
    path: str
    quarter: str | None
    header: list[str] | None
    error: str | None = None
    detail: str | None = None
    usable: bool = True


def first_line(spark: SparkSession, path: str) -> str | None:
    """The line at the start of a file, through Hadoop's file system, so only its first bytes are read."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, LATIN1)).readLine()
    finally:
        stream.close()


def _probed(spark: SparkSession, kind: str, path: str, quarter: str | None, first: str | None) -> Probe:
    if first is None:
        return Probe(kind, path, quarter, None, "empty_file", "no line", usable=False)
    try:
        line = first_line(spark, first)
    except Py4JJavaError as e:
        return Probe(kind, path, quarter, None, "unknown_error", str(e.java_exception)[:500], usable=False)
    if line is None:
        return Probe(kind, path, quarter, None, "empty_file", "no line", usable=False)
    if "\0" in line:
        return Probe(kind, path, quarter, None, "invalid_format", "the header is no single-byte text", usable=False)
    header = [h.strip().strip("$").strip() for h in line.rstrip("\r\n").split("$")]
    names = {k.lower(): v for k, v in S.ERA_NAMES[kind].items()}
    have = {names.get(h.lower(), h.lower()) for h in header}
    lacking = [c for c in S.REQUIRED.get(kind, ["primaryid"]) if c not in have]
    if "primaryid" in lacking:
        return Probe(kind, path, quarter, header, "missing_columns", "; ".join(lacking), usable=False)
    return Probe(kind, path, quarter, header, "missing_columns" if lacking else None, "; ".join(lacking) or None)


def probe_files(spark: SparkSession, files: DataFrame) -> list[Probe]:
    """One probe per logical file, some at a time; their number is kinds times quarters.

    A file that cannot be opened, holds no text in a single-byte code, or names no
    report id is not usable. One that lacks other required columns is read as it is.
    """
    logical = files.groupBy("kind", "quarter", logical_path(F.col("path")).alias("path")).agg(F.min(F.when(F.col("length") > 0, F.col("path"))).alias("first"))
    with ThreadPoolExecutor(PROBES_AT_ONCE) as pool:
        probes = pool.map(lambda r: _probed(spark, r["kind"], r["path"], r["quarter"], r["first"]), logical.collect())
        return sorted(probes, key=lambda p: (p.kind, p.path))


def groups_of(probes: list[Probe]) -> list[HeaderGroup]:
    """Usable files by kind and header.

    One scan takes the header of its first file for all, so files of different
    layout must not share one.
    """
    grouped: dict[tuple[str, tuple[str, ...]], dict[str, str | None]] = {}
    for p in probes:
        if p.usable:
            grouped.setdefault((p.kind, tuple(p.header)), {})[p.path] = p.quarter
    return [HeaderGroup(kind, list(header), sorted(held), [held[p] for p in sorted(held)]) for (kind, header), held in sorted(grouped.items())]


def only(groups: list[HeaderGroup], keep: Callable[[str, str | None], bool]) -> list[HeaderGroup]:
    """The groups with those files whose path and quarter pass; groups that keep none go."""
    kept = []
    for g in groups:
        held = [(p, q) for p, q in zip(g.paths, g.quarters) if keep(p, q)]
        if held:
            kept.append(HeaderGroup(g.kind, g.header, [p for p, _ in held], [q for _, q in held]))
    return kept


def header_groups(spark: SparkSession, files: DataFrame) -> list[HeaderGroup]:
    """Group the usable files by kind and header line."""
    return groups_of(probe_files(spark, files))


def unreadable_path(error: Exception, groups: list[HeaderGroup]) -> str | None:
    """The file of some groups whose content a failed job could not read; None if it failed for another reason."""
    text = str(error)
    if "FAILED_READ_FILE" not in text:
        return None
    found = re.search(r"FAILED_READ_FILE[.A-Z_]*\] Encountered error while reading file (\S+?)\.?\s", text + " ")
    named = unquote(found[1]) if found else ""
    same = lambda p: re.sub("^[a-z]+:/+", "/", unquote(p))
    return next((p for g in groups for p in g.paths if named and same(named).startswith(same(p))), None)


def _trim_header(header: list[str]) -> list[str]:
    """A header that ends in the delimiter names one empty column too many."""
    return header[:-1] if len(header) > 1 and header[-1] == "" else header


def _scan(spark: SparkSession, header: list[str], paths: list[str], whole_lines: bool) -> DataFrame:
    """``whole_lines`` parses every field of a line, else a line of the wrong width goes unseen."""
    columns = [f"_{i}" for i in range(len(_trim_header(header)))]
    return (
        spark.read.schema(S.text_schema([*columns, "_line"]))
        .option("sep", "$").option("header", True).option("quote", "").option("escape", "")
        .option("comment", "").option("encoding", LATIN1).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_line").option("columnPruning", not whole_lines)
        .csv(paths)
        .select(*columns, "_line", F.col("_metadata.file_path").alias("_path"))
    )


def _repaired_scan(spark: SparkSession, header: list[str], paths: list[str], rules) -> DataFrame:
    """Scan as text lines, cut run-together records, then split the fields."""
    columns = [f"_{i}" for i in range(len(_trim_header(header)))]
    lines = spark.read.text(paths).select(
        F.decode(F.col("value").cast("binary"), LATIN1).alias("value"), F.col("_metadata.file_path").alias("_path")
    )
    first = "$".join(header)
    cut = split_merged_records(lines.withColumn("file_name", logical_name(F.col("_path"))), rules)
    fields = F.split(F.regexp_replace("value", r"\r$", ""), r"\$")
    return (
        cut.filter(F.lower(F.regexp_replace("value", r"\s", "")) != first.lower().replace(" ", ""))
        .filter("value <> ''")
        .withColumn("_fields", fields)
        .select(*[F.nullif(F.get("_fields", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)],
                F.when(F.size("_fields") != len(columns), F.col("value")).alias("_line"), "_path")
    )


def _placed(scan: Callable[[list[str]], DataFrame], files: dict[str, str | None]) -> list[DataFrame]:
    """Scans over some files with ``quarter`` and ``_file``.

    A row's path tells both, but working them out costs more than parsing the
    row, so each file has a scan in which they are constants. Only where files
    are very many do they share one, which works them out row by row.
    """
    if len(files) > MOST_SCANS:
        places = [(list(files), file_quarter(F.col("_path")), logical_name(F.col("_path")))]
    else:
        places = [([path], F.lit(quarter).cast("string"), F.lit(path.rsplit("/", 1)[-1])) for path, quarter in files.items()]
    return [scan(paths).select("*", quarter.alias("quarter"), name.alias("_file")) for paths, quarter, name in places]


def _united(frames: list[DataFrame]) -> DataFrame:
    """Frames of the same columns as one, by halves, so that a frame is part of few unions."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return _united(frames[:half]).union(_united(frames[half:]))


def _malformed(width: int) -> Column:
    """A line with too few fields, or with more than the header that are not empty."""
    fields = F.split("_line", r"\$")
    surplus = F.slice(fields, width + 1, F.greatest(F.size(fields) - width, F.lit(0)))
    # A scan may not be asked for its raw lines alone, so one parsed column takes part.
    parsed = F.length("_line") >= F.length(F.coalesce("_0", F.lit("")))
    return F.col("_line").isNotNull() & parsed & ((F.size(fields) < width) | (F.array_join(surplus, "") != ""))


def read_groups(
    spark: SparkSession,
    groups: list[HeaderGroup],
    kind: str,
    *,
    clean: bool = True,
    na_values: list[str] | None = None,
    rules: list[tuple[str, str, str]] = MERGED_RECORDS,
    flag_malformed: bool = False,
    source_file: bool = False,
) -> DataFrame:
    """The groups of one kind as one text frame with unified names and a ``quarter``.

    One scan per file, or per header layout where files are very many, united by
    name. Legacy lines that end in the delimiter have an empty field too many,
    which the scan drops. Files with known run-together records are read as lines
    and repaired first.
    """
    frames = []
    repair = "|".join(name for name, _, _ in rules)
    for group in groups:
        if group.kind != ("drug" if kind == "drug_info" else kind):
            continue
        files = dict(zip(group.paths, group.quarters))
        broken = {p: q for p, q in files.items() if repair and re.search(repair, p.rsplit("/", 1)[-1], re.IGNORECASE)}
        sound = {p: q for p, q in files.items() if p not in broken}
        scans = _placed(lambda paths: _scan(spark, group.header, paths, flag_malformed), sound) if sound else []  # noqa: B023
        scans += _placed(lambda paths: _repaired_scan(spark, group.header, paths, rules), broken) if broken else []  # noqa: B023
        raw = _united(scans)
        header = _trim_header(group.header)
        extra = {"quarter": F.col("quarter")}
        if flag_malformed:
            extra["_malformed"] = _malformed(len(header))
        if source_file:
            extra["_file"] = F.col("_file")
        positions = [f"_{i}" for i in range(len(header))]
        shaped = raw.select(*positions, *[v.alias(k) for k, v in extra.items()])
        # Columns of one header may repeat; the reader blanks to null before they merge.
        shaped = clean_cells(shaped) if clean else shaped
        frames.append(rename_columns(shaped, S.ERA_NAMES[kind], [*header, *extra]))
    if not frames:
        columns = S.TABLES[kind]
        return spark.createDataFrame([], S.text_schema(columns if "quarter" in columns else [*columns, "quarter"]))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return drop_na_tokens(out, na_values) if na_values else out


def read_quarter_files(spark: SparkSession, path: str, kind: str, *, folder: str | None = "ascii", **options) -> DataFrame:
    """All files of one kind below a path; see :func:`read_groups` for the options."""
    found = discover(spark, path, "drug" if kind == "drug_info" else kind, folder)
    return read_groups(spark, header_groups(spark, found), kind, **options)


def manifest(spark: SparkSession, path: str, folder: str | None = "ascii") -> DataFrame:
    """The list of input files as a table."""
    return discover(spark, path, None, folder)


def _error_class(rows: Column, malformed: Column, probed: Column) -> Column:
    """A probe that made the file unusable decides, then what its lines say, then columns it lacks."""
    return (
        F.when(probed.isin("unknown_error", "invalid_format"), probed).when(rows == 0, F.coalesce(probed, F.lit("empty_file")))
        .when(malformed > 0, "invalid_format").otherwise(probed)
    )


def file_errors(rows: DataFrame, files: DataFrame, probes: list[Probe] | None = None) -> DataFrame:
    """Error class per input file: no data, lines of the wrong width, columns missing, not readable, or none.

    ``rows`` comes from the reader with its malformed flag and file name.
    """
    spark = rows.sparkSession
    counted = rows.groupBy(F.col("_file").alias("file_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("_malformed").alias("n_malformed")
    )
    listed = files.select("file_name", "kind", "quarter").distinct()
    probed = spark.createDataFrame([(p.path.rsplit("/", 1)[-1], p.error) for p in probes or []], "file_name string, probed string")
    n, bad = F.coalesce("n_rows", F.lit(0)), F.coalesce("n_malformed", F.lit(0))
    joined = listed.join(counted, "file_name", "left").join(F.broadcast(probed), "file_name", "left")  # a row per file
    return joined.select("file_name", "kind", "quarter", n.alias("n_rows"), bad.alias("n_malformed"), _error_class(n, bad, F.col("probed")).alias("error_class"))
