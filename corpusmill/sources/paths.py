"""Path specifications: ``"a.jsonl; dir/ , b.json"`` to an ordered file list.

Rules (train/dev specs): ``,`` and ``;`` both separate parts, parts are trimmed
and empty parts dropped; a file is kept whatever its suffix; a directory
expands, without descending, to its sorted ``*.jsonl`` files and then its
sorted ``*.json`` files; a missing part is skipped (and reported); duplicates
and spec order are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from corpusmill.sources.files import FileInfo, look_up

JSON_SUFFIXES = (".json", ".jsonl")
TEXT_SUFFIXES = (".txt",)


@dataclass(frozen=True)
class SpecFile:
    path: str
    uri: str
    name: str
    spec_ord: int  # which part of the spec produced the file
    length: int = -1  # bytes; -1 when unknown


@dataclass
class Expansion:
    spec: str
    files: list[SpecFile] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)

    def __bool__(self) -> bool:
        return bool(self.files)

    def paths(self) -> list[str]:
        return [f.path for f in self.files]


def join_spec(spec: str | Sequence[str] | None) -> str | None:
    """A list-valued spec is joined with ``;`` (its items are split again)."""
    if spec is None:
        return None
    if isinstance(spec, str):
        return spec
    return ";".join(spec)


def split_spec(spec: str | Sequence[str], separators: str = ",;") -> list[str]:
    text = join_spec(spec) or ""
    first = separators[0]
    for sep in separators[1:]:
        text = text.replace(sep, first)
    return [p.strip() for p in text.split(first) if p.strip()]


def _is_hidden(name: str) -> bool:
    return name.startswith("_") or name.startswith(".")


def _from_info(info: FileInfo, spec_ord: int) -> SpecFile:
    return SpecFile(info.path, info.uri, info.name, spec_ord, info.length)


def expand_spec(
    spark: SparkSession,
    spec: str | Sequence[str],
    *,
    directories: bool = True,
    missing: str = "skip",
    extensions: Iterable[str] = (".jsonl", ".json"),
    literal: bool = False,
    separators: str = ",;",
) -> Expansion:
    """Resolve a spec to files, in spec order.

    ``literal=True`` with a list takes every item as one path (commas inside
    names survive). ``missing='error'`` raises on a part that does not exist.
    Files whose name starts with ``_`` or ``.`` are invisible to Spark's readers,
    so naming one raises and a listed directory skips them."""
    if literal and not isinstance(spec, str):
        parts = [p.strip() for p in spec if p and p.strip()]
    else:
        parts = split_spec(spec, separators)
    out = Expansion(spec=join_spec(spec) or "")
    extensions = tuple(extensions)
    infos = look_up(spark, parts, extensions)
    for i, (part, info) in enumerate(zip(parts, infos)):
        if info is None:
            if missing == "error":
                raise FileNotFoundError(f"no such file: {part}")
            out.missing.append(part)
            continue
        if not info.is_dir:
            if _is_hidden(info.name):
                raise ValueError(
                    f"{part}: file names starting with '_' or '.' are skipped by Spark readers; rename it"
                )
            out.files.append(_from_info(info, i))
            continue
        if not directories:
            raise ValueError(f"{part} is a directory; list its files")
        for ext in extensions:
            out.files.extend(_from_info(c, i) for c in info.children if c.name.endswith(ext))
    return out


def offline_file_list(spark: SparkSession, spec: str) -> Expansion:
    """Literal file list of the offline tool: ``;`` and ``,`` separate, parts
    are trimmed, no directory expansion, a missing file is an error."""
    return expand_spec(spark, spec, directories=False, missing="error", separators=",;")


def require_files(expansion: Expansion, what: str = "training") -> Expansion:
    if not expansion.files:
        raise FileNotFoundError(f"{what}: the path spec {expansion.spec!r} names no existing file")
    return expansion


def route_by_suffix(files: Sequence[SpecFile]) -> tuple[list[SpecFile], list[SpecFile], list[SpecFile]]:
    """Case-insensitive routing: (json/jsonl files, text files, dropped)."""
    js, tx, other = [], [], []
    for f in files:
        low = f.name.lower()
        if low.endswith(JSON_SUFFIXES):
            js.append(f)
        elif low.endswith(TEXT_SUFFIXES):
            tx.append(f)
        else:
            other.append(f)
    return js, tx, other
