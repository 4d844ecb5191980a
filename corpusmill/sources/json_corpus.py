"""JSON / JSONL corpora as one DataFrame with the files' row order carried.

A DataFrame has no row order, so every row gets ``_file_ord`` (position of its
file in the expanded spec), ``_block_ord`` (byte offset of the split that read
it) and ``_row_ord`` (``monotonically_increasing_id`` taken right after the
scan, increasing within a split). Sorting by ``ORDER_COLS`` restores the order
of the files. ``_spec_ord`` says which part of the spec named the file.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources.files import HEAD_BYTES, SMALL_BYTES, SMALL_FILES, escape_glob, listing, packed, small_arrays, starts_array
from corpusmill.sources.json_types import Seen, Shape, fold, shape
from corpusmill.sources.paths import SpecFile, expand_spec, require_files

ORDER_COLS = ("_file_ord", "_block_ord", "_row_ord")
META_COLS = ("_file_ord", "_spec_ord", "_block_ord", "_row_ord", "_path")

# Files per read: the (path -> file_ord) table of one read is broadcast, so its
# size is bounded by this; larger lists are read in several broadcast chunks.
BROADCAST_FILES = 50_000
SNIFF_THREADS = 32
ARRAY_BYTES = 128 << 20  # of an array file that a task's inference holds whole
_LISTED = pa.schema([("_uri", pa.string()), ("_found", pa.int64()), ("_spec_ord", pa.int64())])


def order_cols(df: DataFrame) -> list[str]:
    return [c for c in ORDER_COLS if c in df.columns]


def sniff_layout(spark: SparkSession, f: SpecFile) -> str:
    """``array`` when the first non-blank character of a ``.json`` file is
    ``[``, else ``lines``. ``.jsonl`` files are always line-delimited."""
    if not f.name.lower().endswith(".json"):
        return "lines"
    return "array" if starts_array(spark, f.path) else "lines"


def _reader(spark: SparkSession, layout: str, mode: str):
    return _files_only(spark).option("mode", mode).option("multiLine", "true" if layout == "array" else "false")


def _files_only(spark: SparkSession):
    """A reader of named files, whose folders' names are not looked through for partition values."""
    return spark.read.option("recursiveFileLookup", "true")


def path_positions(spark: SparkSession, scanned: DataFrame, items: Sequence[tuple[int, SpecFile]]) -> DataFrame:
    """``scanned`` (with ``_path``) plus ``_file_ord`` and ``_spec_ord``, a row for
    each time its file is listed. A scanned file that the list does not name (its
    URI written in another way) raises instead of vanishing.

    The list is bounded by the caller: a proven size, so the scan never shuffles."""
    columns = {"_uri": [f.uri for _, f in items], "_found": [int(o) for o, _ in items], "_spec_ord": [int(f.spec_ord) for _, f in items]}
    lookup = spark.createDataFrame(pa.table(columns, _LISTED))
    unknown = F.raise_error(F.concat(F.lit("file is not in the expanded spec: "), F.col("_path"))).cast("bigint")
    joined = scanned.join(F.broadcast(lookup), scanned["_path"] == lookup["_uri"], "left")
    return joined.withColumn("_file_ord", F.coalesce("_found", unknown)).drop("_uri", "_found")


def listed_in_chunks(items: Sequence[tuple[int, SpecFile]]) -> list[list[tuple[int, SpecFile]]]:
    """Items in chunks of about ``BROADCAST_FILES``, all listings of a path together."""
    by_uri: dict[str, list[tuple[int, SpecFile]]] = {}
    for o, f in items:
        by_uri.setdefault(f.uri, []).append((o, f))
    chunks: list[list[tuple[int, SpecFile]]] = [[]]
    for listings in by_uri.values():
        if chunks[-1] and len(chunks[-1]) + len(listings) > BROADCAST_FILES:
            chunks.append([])
        chunks[-1] += listings
    return chunks


def _read_group(
    spark: SparkSession,
    items: list[tuple[int, SpecFile]],
    layout: str,
    schema: T.StructType | str | Shape,
    mode: str,
) -> DataFrame:
    paths = list(dict.fromkeys(escape_glob(f.path) for _, f in items))
    columns: list = ["*"]
    if isinstance(schema, Shape):
        schema, columns = schema.wire, schema.columns
    with listing(spark):
        raw = _reader(spark, layout, mode).schema(schema).json(paths)
    scanned = raw.select(
        *columns,
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block_ord"),
        F.monotonically_increasing_id().alias("_row_ord"),
    )
    if len(paths) > SMALL_FILES and all(_small(f) for _, f in items):
        scanned = packed(scanned, list({f.path: f.length for _, f in items}.values()))
    return path_positions(spark, scanned, items)


def _small(f: SpecFile) -> bool:
    return 0 <= f.length <= SMALL_BYTES


def _layouts(spark: SparkSession, files: Sequence[SpecFile], layout: str, inferring: bool = False) -> list[str]:
    """The layout of each file; ``unsure`` of many small ones whose rows ``infer_shapes``
    is going to see anyhow."""
    if layout != "auto":
        return [layout] * len(files)
    # Small .json files in one job; the head only of each large one, in a small job of its own.
    unsure = {f.uri: f for f in files if f.name.lower().endswith(".json")}
    tiny = {u for u, f in unsure.items() if _small(f)} if inferring else set()
    if len(tiny) > SMALL_FILES:
        rest = iter(_layouts(spark, [f for f in files if f.uri not in tiny], layout))
        return ["unsure" if f.uri in tiny else next(rest) for f in files]
    small = [f.path for f in unsure.values() if 0 <= f.length <= HEAD_BYTES]
    arrays = small_arrays(spark, small) if len(small) > 1 else set()
    large = [f for f in unsure.values() if len(small) == 1 or not 0 <= f.length <= HEAD_BYTES]
    with ThreadPoolExecutor(max_workers=SNIFF_THREADS) as pool:
        arrays |= {f.uri for f, lay in zip(large, pool.map(lambda f: sniff_layout(spark, f), large)) if lay == "array"}
    return ["array" if f.uri in arrays else "lines" for f in files]


def infer_shapes(spark: SparkSession, sides: Sequence[tuple[Sequence[SpecFile], list[str]]], counts: dict | None = None) -> list[Shape]:
    """One shape for each side ((files, layouts)): the columns that its own files
    have, each with the type it has over all sides. One pass over all files; an
    array file too long to hold in a task is looked at by the parser's own inference
    instead (twice: with and without its empty places), and joins in with what that says.
    ``counts`` gets the rows of each file (by side and URI), unless such a long file is there.
    Layouts that are ``unsure`` are replaced by what the files start with."""
    sources, long = [], []
    for k, (files, layouts) in enumerate(sides):
        paths: dict[str, dict[str, int]] = {"lines": {}, "few": {}, "array": {}, "unsure": {}, "long": {}}
        for f, lay in zip(files, layouts):
            kind = "long" if lay == "array" and not 0 <= f.length <= ARRAY_BYTES else "few" if lay == "lines" and _small(f) else lay
            paths[kind][escape_glob(f.path)] = f.length
        if len(paths["few"]) <= SMALL_FILES:
            paths["lines"] |= paths.pop("few")
        for kind in [kind for kind, there in paths.items() if there and kind != "long"]:
            with listing(spark):
                reader = _files_only(spark).format("binaryFile" if kind in ("array", "unsure") else "text")
                df = reader.load(sorted(paths[kind]))
            content = F.col("content" if "content" in df.columns else "value").cast("binary").alias("content")
            found = df.select(F.lit(k).cast("int").alias("side"), F.col("_metadata.file_path").alias("path"), content, F.lit(kind == "unsure").alias("unsure"))
            sources.append(packed(found, list(paths[kind].values())) if kind in ("few", "unsure") else found)
        if paths["long"]:
            looked = [_reader(spark, "array", "FAILFAST").option("dropFieldIfAllNull", drop).json(sorted(paths["long"])).schema for drop in (False, True)]
            long.append((k, Seen.of_type(*looked, min(paths["long"]))))
    seen, rows, found_arrays = fold(spark, sources) if sources else ({}, {}, set())
    for k, (files, layouts) in enumerate(sides):
        layouts[:] = [("array" if (k, f.uri) in found_arrays else "lines") if lay == "unsure" else lay for f, lay in zip(files, layouts)]
    if counts is not None and not long:
        counts.update(rows)
    for k, found in long:
        seen.setdefault(k, Seen()).merge(found)
    merged = Seen()
    for found in seen.values():
        merged.merge(found)
    by_case = spark.conf.get("spark.sql.caseSensitive") == "true"
    own = [list(seen[k].fields or ()) if k in seen else [] for k in range(len(sides))]
    return [shape(merged, names, by_case) for names in own]


def read_json_files(
    spark: SparkSession,
    files: Sequence[SpecFile],
    *,
    schema: T.StructType | str | None = None,
    layout: str = "auto",
    mode: str = "FAILFAST",
    ord_offset: int = 0,
    ords: Sequence[int] | None = None,
) -> DataFrame:
    """Read JSON / JSONL files (strict by default: a malformed line raises).

    Blank lines yield no row. Each file is scanned once; a path listed twice gives
    its rows twice with two ``_file_ord`` values, as a concatenation of the files
    would."""
    if not files:
        raise FileNotFoundError("no JSON files to read")
    layouts = _layouts(spark, files, layout, schema is None)
    if schema is None:
        schema = infer_shapes(spark, [(files, layouts)])[0]
    return _read(spark, files, layouts, schema, mode, ord_offset, ords)


def _read(spark, files, layouts, schema, mode, ord_offset=0, ords=None) -> DataFrame:
    if ords is None:
        ords = [ord_offset + i for i in range(len(files))]
    parts = []
    for layout in ("lines", "array"):
        items = [(o, f) for o, f, lay in zip(ords, files, layouts) if lay == layout]
        small = [(o, f) for o, f in items if _small(f)]
        alike = [small, [(o, f) for o, f in items if not _small(f)]] if len(small) > SMALL_FILES else [items]
        for some in alike:
            if some:
                parts += [_read_group(spark, chunk, layout, schema, mode) for chunk in listed_in_chunks(some)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _json_files(spark: SparkSession, spec, what: str, literal: bool = False) -> list[SpecFile]:
    exp = require_files(expand_spec(spark, spec, literal=literal), what)
    for f in exp.files:
        if f.name.lower().endswith(".txt"):
            raise ValueError(f"{f.path}: a .txt file is not JSON; use the pre-training reader")
    return exp.files


def read_json_corpus(
    spark: SparkSession,
    spec: str | Sequence[str],
    *,
    what: str = "training",
    literal: bool = False,
    **kw,
) -> DataFrame:
    """Path spec to a JSON DataFrame; no file raises ``FileNotFoundError``."""
    return read_json_files(spark, _json_files(spark, spec, what, literal), **kw)


def read_sides(
    spark: SparkSession,
    sides: Sequence[Sequence[SpecFile]],
    *,
    schema: T.StructType | str | None = None,
    layout: str = "auto",
    mode: str = "FAILFAST",
    counts: dict | None = None,
) -> list[DataFrame | None]:
    """A DataFrame for each file list (``None`` for an empty one), columns of one
    name having one type on all sides. Where types are inferred, ``counts`` gets the
    number of rows of each file, by (side, URI)."""
    layouts = [_layouts(spark, files, layout, schema is None) for files in sides]
    schemas = infer_shapes(spark, list(zip(sides, layouts)), counts) if schema is None else [schema] * len(sides)
    return [_read(spark, f, lay, s, mode) if f else None for f, lay, s in zip(sides, layouts, schemas)]


def read_train_eval(
    spark: SparkSession,
    train_spec: str | Sequence[str],
    eval_spec: str | Sequence[str] | None,
    *,
    what: str = "training",
    **kw,
) -> tuple[DataFrame, DataFrame | None]:
    """Training rows, and eval rows if a spec names any; read with common types."""
    train = _json_files(spark, train_spec, what)
    held_out = expand_spec(spark, eval_spec).files if eval_spec else []
    return tuple(read_sides(spark, [train, held_out], **kw))


def read_prompt_file(
    spark: SparkSession,
    path: str,
    *,
    lossless: bool = False,
    schema: T.StructType | str | None = None,
    layout: str = "lines",
) -> DataFrame:
    """One JSONL prompt file (or the folder of part files one Spark write
    made), blank lines dropped, strict parse, no spec syntax.

    ``lossless=True`` also keeps each trimmed source line in ``_raw`` so a sink
    can re-emit the row with its original keys, key order and explicit nulls."""
    exp = require_files(expand_spec(spark, [path], literal=True, missing="error"), "prompt")
    if not lossless:
        return read_json_files(spark, exp.files, schema=schema, layout=layout)
    if layout != "lines":
        raise ValueError("lossless prompts are JSON lines")
    columns: list = []
    if schema is None:
        found = infer_shapes(spark, [(exp.files, ["lines"] * len(exp.files))])[0]
        schema, columns = found.wire, found.columns
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    parts = []
    for chunk in listed_in_chunks(list(enumerate(exp.files))):
        with listing(spark):
            texts = spark.read.text([escape_glob(f.path) for _, f in chunk])
        lines = texts.select(
            F.btrim(F.col("value"), F.lit(" \t\r\n")).alias("_raw"),
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_block_ord"),
            F.monotonically_increasing_id().alias("_row_ord"),
        )
        parsed = F.from_json(F.col("_raw"), schema, {"mode": "FAILFAST"}).alias("_row")
        rows = path_positions(spark, lines.where(F.col("_raw") != ""), chunk)
        parts.append(rows.select(parsed, "_raw", *META_COLS))
    out = reduce(lambda x, y: x.unionByName(y), parts)
    out = out.select("_row.*", "_raw", *META_COLS)
    return out.select(*columns, "_raw", *META_COLS) if columns else out
