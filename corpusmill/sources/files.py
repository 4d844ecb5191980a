"""Files of a path, listed by Spark's own readers.

``binaryFile`` gives a row for each file (path, URI, length) without reading its
content, so a listing is a small table made by tasks: it works wherever the session
reads (local folders, HDFS, object stores), over Spark Connect as well, and comes to
the driver in one transfer. Names are matched by patterns, many at a time: those that
do not exist are simply not there.

Spark's scans pass over files without a byte; named files of that kind are found by
``inputFiles``, in a listed folder they have no rows to miss.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters Spark treats as glob syntax in a read path.
GLOB_CHARS = "\\[]{}*?"
_GLOB = re.compile(f"[{re.escape(GLOB_CHARS)}]")
NAMES = 1024  # in one pattern
LISTED = 50_000  # names asked for at once
PATTERNS = 32  # in one job
LISTING_TASKS = 256  # at most, of a job that lists paths; Spark starts one for each of the first 10,000
HEAD_BYTES = 4 << 20  # a file up to this is read whole to see how it starts: as much as opening one costs
SMALL_BYTES = 256 << 10  # a file up to this is one of many in a task where there are many
SMALL_FILES = 256  # in a task; Spark counts each as 4 MB of work and gives a task 32 at most
BLANK = "\ufeff \t\r\n"  # before the first character that says something
_ROOT = re.compile(r"^[A-Za-z][\w+.-]*:(//[^/]*)?")


@dataclass(frozen=True)
class FileInfo:
    path: str  # qualified path as written (what a read gets, escaped)
    uri: str  # the form Spark reports in ``_metadata.file_path``
    name: str
    is_dir: bool
    length: int
    children: tuple[FileInfo, ...] = ()  # of a folder: its files with a wanted suffix


def escape_glob(path: str) -> str:
    """A literal path for ``spark.read``: glob characters lose their meaning."""
    return _GLOB.sub(r"\\\g<0>", path)


def _name_pattern(names: Iterable[str]) -> str:
    return "{" + ",".join(escape_glob(n).replace(",", "\\,") for n in names) + "}"


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """Readers made in here list many paths by ``LISTING_TASKS`` tasks: of one for each path,
    nearly all the time goes into starting it."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    was = spark.conf.get(name)
    if int(was) <= LISTING_TASKS:
        yield
        return
    spark.conf.set(name, LISTING_TASKS)
    try:
        yield
    finally:
        spark.conf.set(name, was)


def packed(df: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """A scan of many files, each up to ``SMALL_BYTES``, by tasks of up to ``SMALL_FILES`` or
    a few MB, not fewer than the session asks for: a task takes longer to start than such a
    file to be read."""
    asked = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(-(-len(lengths) // SMALL_FILES), -(-sum(lengths) // HEAD_BYTES), asked))


def _step_pattern(parent: str, names: Sequence[str]) -> str:
    """Things of these names in a folder. With a slash in it, each alternative is looked up
    by itself, where one without would be matched against a listing of the whole folder."""
    if len(names) == 1:
        return f"{parent}/{escape_glob(names[0])}"
    return parent + "/{" + ",".join(escape_glob(n).replace(",", "\\,") + "/" for n in names) + "}"


def _files(spark: SparkSession, pattern: str | list[str], suffixes: str | None = None) -> DataFrame:
    """The files that a pattern matches, or that folders it matches hold at any depth;
    of all, those whose names match ``suffixes``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    with listing(spark):
        df = (reader.option("pathGlobFilter", suffixes) if suffixes else reader).load(pattern)
        df.schema  # noqa: B018  (where a Connect session looks at the path)
    return df


def _found(spark: SparkSession, pattern: str | list[str], suffixes: str | None = None) -> DataFrame | None:
    """As ``_files``, ``None`` if the pattern matches nothing."""
    try:
        return _files(spark, pattern, suffixes)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _collect(frames: Sequence[DataFrame]) -> list[list[FileInfo]]:
    """Non-empty files of each frame: one job for ``PATTERNS`` of them."""
    out: list[list[FileInfo]] = [[] for _ in frames]
    for a in range(0, len(frames), PATTERNS):
        part = [
            df.select(F.lit(a + k).alias("k"), "path", F.col("_metadata.file_path").alias("uri"), "length")
            for k, df in enumerate(frames[a : a + PATTERNS])
        ]
        # nothing of a file is read, so a task goes through as many as come to it
        table = reduce(DataFrame.union, part).coalesce(LISTING_TASKS).toArrow()
        for k, path, uri, length in zip(*(c.to_pylist() for c in table.columns)):
            out[k].append(FileInfo(path, uri, path.rsplit("/", 1)[-1], False, length))
    return out


def _tail(path: str) -> str:
    """A path without scheme and authority, single slashes throughout."""
    return re.sub("/+", "/", _ROOT.sub("", path)).rstrip("/")


def _below(info: FileInfo, parent: str) -> list[str]:
    """The steps from ``parent`` to a listed file."""
    return _tail(info.path)[len(_tail(parent)) + 1 :].split("/")


def _empty_file(uri: str) -> FileInfo:
    """A file that ``inputFiles`` names and no scan shows."""
    if uri.startswith("file:///"):  # as a scan's rows have it
        uri = "file:/" + uri[len("file:///") :]
    path = unquote(uri)
    return FileInfo(path, uri, path.rsplit("/", 1)[-1], False, 0)


def _folder(path: str, children: Iterable[FileInfo] = ()) -> FileInfo:
    return FileInfo(path, path, path.rstrip("/").rsplit("/", 1)[-1], True, 0, tuple(sorted(children, key=lambda f: f.path)))


def look_up(spark: SparkSession, parts: Sequence[str], extensions: Sequence[str]) -> list[FileInfo | None]:
    """What each path is: a file, a folder with its files of the given suffixes
    (without descending), or nothing. Parts of one parent folder are asked for together.

    A name that starts with ``_`` or ``.`` is invisible to Spark's readers; such a file is
    reported with its name and nothing else."""
    groups: dict[str, dict[str, None]] = {}
    alone: list[str] = []
    for part in dict.fromkeys(parts):
        parent, _, name = part.rstrip("/").rpartition("/")
        steps = _tail(part).split("/")
        absolute = part.startswith("/") or _ROOT.match(part)
        if absolute and name and ":" not in name and not {".", ".."} & set(steps) and _tail(part):
            groups.setdefault(parent, {})[name] = None
        else:
            alone.append(part)
    found: dict[str, FileInfo | None] = {}
    chunks = []
    for parent, names in groups.items():
        listed = list(names)
        chunks += [(parent, listed[a : a + LISTED]) for a in range(0, len(listed), LISTED)]
    suffixes = "*" + _name_pattern(extensions)
    # files of a wanted suffix, named or one level down in a named folder
    wanted = [_among(spark, parent, names, suffixes) for parent, names in chunks]
    held = [k for k, df in enumerate(wanted) if df is not None]
    for k, files in zip(held, _collect([wanted[k] for k in held])):
        parent = chunks[k][0]
        children: dict[str, list[FileInfo]] = {}
        for f in files:
            steps = _below(f, parent)
            if len(steps) == 1:
                found[f"{parent}/{f.name}"] = f
            else:
                children.setdefault(steps[0], []).extend([f] if len(steps) == 2 else [])
        for name, own in children.items():
            found[f"{parent}/{name}"] = _folder(f"{parent}/{name}", own)
    chunks = [chunks[k] for k in held]
    # then other files, and folders without such files
    rest = [(parent, [n for n in names if f"{parent}/{n}" not in found]) for parent, names in chunks]
    rest = [(parent, names, _among(spark, parent, names)) for parent, names in rest if names]
    rest = [r for r in rest if r[2] is not None]
    for (parent, names, _), files in zip(rest, _collect([r[2] for r in rest])):
        for f in files:
            steps = _below(f, parent)
            key = f"{parent}/{steps[0]}"
            found[key] = f if len(steps) == 1 else found.get(key) or _folder(key)
    for parent, names, df in rest:
        left = {n for n in names if f"{parent}/{n}" not in found}
        if not left:
            continue
        for uri in df.inputFiles():
            f = _empty_file(uri)
            steps = _below(f, parent)
            if steps[0] in left:
                found[f"{parent}/{steps[0]}"] = f if len(steps) == 1 else _folder(f"{parent}/{steps[0]}")
        alone += [f"{parent}/{n}" for n in sorted(left) if f"{parent}/{n}" not in found]
    for part in alone:
        found[part] = _look_up_one(spark, part, extensions)
    return [found[p] if p in found else found.get(p.rstrip("/")) for p in parts]


def _among(spark: SparkSession, parent: str, names: Sequence[str], suffixes: str | None = None) -> DataFrame | None:
    """Files of these names in a folder, and in folders of these names. Where some name
    of the folder holds a colon, no pattern works, and the names are asked for one by one."""
    at = escape_glob(parent)
    patterns = [_step_pattern(at, names[a : a + NAMES]) for a in range(0, len(names), NAMES)]
    try:
        df = _found(spark, patterns, suffixes)
        if df is None and len(patterns) > 1:  # some pattern matches nothing
            patterns = [p for p in patterns if exists(spark, p, pattern=True)]
            df = _found(spark, patterns, suffixes) if patterns else None
        return df
    except PySparkException as e:
        if "URISyntaxException" not in str(e):
            raise
    frames = [df for n in names if (df := _found(spark, f"{at}/{n}", suffixes)) is not None]
    return reduce(DataFrame.union, frames) if frames else None


def _look_up_one(spark: SparkSession, part: str, extensions: Sequence[str]) -> FileInfo | None:
    """One path that is relative, has odd steps, or was not found among others."""
    path = escape_glob(part.rstrip("/") or "/")
    df = _found(spark, path)
    if df is None:
        return None
    name = part.rstrip("/").rsplit("/", 1)[-1]
    (inside,) = _collect([_files(spark, path, "*" + _name_pattern(extensions))])
    depth = min((f.path.count("/") for f in inside), default=0)
    inside = [f for f in inside if f.path.count("/") == depth]
    if len(inside) == 1 and inside[0].name == name:
        return inside[0]
    if inside:
        return _folder(part, inside)
    (files,) = _collect([df])
    files = files or [_empty_file(u) for u in df.inputFiles()]
    if len(files) == 1 and files[0].name == name:
        return files[0]
    if not files and name.startswith(("_", ".")) and name not in (".", ".."):
        return FileInfo(part, part, name, False, 0)
    return _folder(part)


def exists(spark: SparkSession, path: str, pattern: bool = False) -> bool:
    return _found(spark, path if pattern else escape_glob(path)) is not None


def list_files_recursive(spark: SparkSession, path: str) -> list[FileInfo]:
    """The non-empty files under a folder, at any depth, sorted by path."""
    (files,) = _collect([_files(spark, escape_glob(path))])
    return sorted(files, key=lambda f: f.path)


def starts_array(spark: SparkSession, path: str) -> bool:
    """Whether the first character of a JSON file that is not blank is ``[``: what comes
    before its first ``{`` is one short record of a scan that ends there."""
    head = spark.read.option("lineSep", "{").text(escape_glob(path)).limit(1).collect()
    return bool(head) and head[0][0].lstrip(BLANK).startswith("[")


def small_arrays(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """URIs of those of many small files that ``starts_array`` is true of, by one job."""
    with listing(spark):
        files = spark.read.format("binaryFile").load([escape_glob(p) for p in paths])
    first = F.ltrim(F.col("content").cast("string"), F.lit(BLANK))
    return set(files.where(first.startswith("[")).select(F.col("_metadata.file_path").alias("uri")).toArrow()["uri"].to_pylist())
