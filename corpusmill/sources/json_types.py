"""Types of JSON columns, inferred as a lattice that merges in any order.

What a place in the rows (a column, a field, the items of a list) has held is a
``Seen``: empty strings, empty lists, booleans, whole numbers and their width,
fractions, text, items, fields. Merging two is a join of these, at every depth, so the
fold runs over the rows of each task, then over the tasks' results, in one pass over
all files, lines and arrays alike. Only when all is merged is a type read off:

- nothing but nulls, ``""`` and ``[]`` says nothing: the place has the type that other
  rows give it, and text if none does (a list of text if ``[]`` was met);
- whole numbers are ``bigint``, beyond 64 bits ``decimal(n, 0)`` of as many digits as
  were met, beyond 38 digits or with a fraction anywhere ``double``;
- different scalars are text;
- a list or an object against anything else raises, naming the place: neither is
  ever read as text. So do names that differ in case alone, unless the session tells
  them apart.

The parser takes ``""`` and ``[]`` for text and lists only. Where they were met at a
place of another type, that place alone is read as its JSON text and converted, the
empty value to null; every other place is parsed as what it is.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1
MERGERS = 16  # tasks that merge the scanning tasks' results
BLANK = " \t\r\n"
MARK = b"\xef\xbb\xbf"  # of the byte order
ARRAY = re.compile(rb"(?:\xef\xbb\xbf|[ \t\r\n])*\[")  # how an array file starts
HELD = 256  # rows of a batch held as Python objects at once

#: flags of a Seen
EMPTY, HOLLOW, BOOL, LONG, FRACTION, TEXT = 1, 2, 4, 8, 16, 32
SCALAR = BOOL | LONG | FRACTION | TEXT


class Seen:
    """What one place has held."""

    __slots__ = ("flags", "digits", "items", "fields", "at")

    def __init__(self, at: str = ""):
        self.flags = 0
        self.digits = 0  # of the widest whole number beyond 64 bits
        self.items: Seen | None = None
        self.fields: dict[str, Seen] | None = None
        self.at = at  # a file that has this place

    def add(self, value, at: str) -> None:
        kind = type(value)
        if kind is str:
            self.flags |= TEXT if value else EMPTY
        elif kind is dict:
            fields = self.fields
            if fields is None:
                fields = self.fields = {}
            for name, inner in value.items():
                seen = fields.get(name)
                if seen is None:
                    seen = fields[name] = Seen(at)
                seen.add(inner, at)
        elif kind is list:
            if not value:
                self.flags |= HOLLOW
                return
            if self.items is None:
                self.items = Seen(at)
            for inner in value:
                self.items.add(inner, at)
        elif kind is bool:
            self.flags |= BOOL
        elif kind is int:
            self.flags |= LONG
            if not LONG_MIN <= value <= LONG_MAX:
                self.digits = max(self.digits, len(str(abs(value))))
        elif kind is float:
            self.flags |= FRACTION

    def merge(self, other: Seen) -> None:
        self.flags |= other.flags
        self.digits = max(self.digits, other.digits)
        self.at = min(filter(None, (self.at, other.at)), default="")
        if other.items is not None:
            if self.items is None:
                self.items = Seen()
            self.items.merge(other.items)
        if other.fields is not None:
            if self.fields is None:
                self.fields = {}
            for name, seen in other.fields.items():
                self.fields.setdefault(name, Seen()).merge(seen)

    def dump(self) -> list:
        fields = None if self.fields is None else {n: s.dump() for n, s in self.fields.items()}
        return [self.flags, self.digits, None if self.items is None else self.items.dump(), fields, self.at]

    @classmethod
    def load(cls, dumped: list) -> Seen:
        out = cls(dumped[4])
        out.flags, out.digits = dumped[:2]
        out.items = None if dumped[2] is None else cls.load(dumped[2])
        out.fields = None if dumped[3] is None else {n: cls.load(s) for n, s in dumped[3].items()}
        return out

    @classmethod
    def of_type(cls, kind: T.DataType, held: T.DataType | None, at: str = "") -> Seen:
        """What rows may have held whose inferred type is ``kind``, and ``held`` without
        the places of nothing but nulls, ``""`` and ``[]``: such a place (no ``held``) says
        nothing, and any other than text may have been empty, too."""
        out = cls(at)
        out.flags = EMPTY | HOLLOW
        if isinstance(held, T.StructType):
            inner = {f.name: f.dataType for f in held.fields}
            out.fields = {f.name: cls.of_type(f.dataType, inner.get(f.name), at) for f in kind.fields}
        elif isinstance(held, T.ArrayType):
            out.items = cls.of_type(kind.elementType, held.elementType, at)
        elif isinstance(held, T.BooleanType):
            out.flags |= BOOL
        elif isinstance(held, (T.LongType, T.IntegerType, T.DecimalType)):
            out.flags |= LONG
            out.digits = held.precision if isinstance(held, T.DecimalType) else 0
        elif isinstance(held, T.DoubleType):
            out.flags |= FRACTION
        elif isinstance(held, T.StringType):
            out.flags |= TEXT
        elif held is None and isinstance(kind, T.StringType):
            out.flags = EMPTY
        return out


@dataclass
class Place:
    """How a place is read: its type, the type the parser is given, and the way from
    the one to the other (none where they are the same)."""

    kind: T.DataType
    wire: T.DataType
    convert: Callable[[Column], Column] | None = None

    def apply(self, value: Column) -> Column:
        return value if self.convert is None else self.convert(value)


def _scalar(seen: Seen) -> T.DataType:
    kinds = seen.flags & SCALAR
    if kinds == BOOL:
        return T.BooleanType()
    if kinds == LONG and seen.digits <= 38:
        return T.DecimalType(max(20, seen.digits), 0) if seen.digits else T.LongType()
    if kinds and not kinds & (BOOL | TEXT):
        return T.DoubleType()
    return T.StringType()


def _place(seen: Seen, name: str, by_case: bool) -> Place:
    shapes = [("an object", seen.fields is not None), ("a list", seen.items is not None), ("text or a number", seen.flags & SCALAR)]
    met = [s for s, there in shapes if there]
    if len(met) > 1:
        raise ValueError(
            f"column {name!r} is {met[0]} in some rows and {met[1]} in others (see {seen.at}); "
            "a list or object is never read as text: pass schema= or mend the files"
        )
    if seen.fields:
        inner = _places(seen.fields, f"{name}.", by_case)
        kind = T.StructType([T.StructField(n, p.kind, True) for n, p in inner.items()])
        wire = T.StructType([T.StructField(n, p.wire, True) for n, p in inner.items()])
        convert = None
        if any(p.convert for p in inner.values()):

            def convert(value: Column) -> Column:
                return F.when(value.isNotNull(), F.struct(*[p.apply(value.getField(n)).alias(n) for n, p in inner.items()]))

        found = Place(kind, wire, convert)
    elif seen.items is not None:
        item = _place(seen.items, f"{name}[]", by_case)
        convert = None if item.convert is None else (lambda value: F.transform(value, item.convert))
        found = Place(T.ArrayType(item.kind, True), T.ArrayType(item.wire, True), convert)
    elif seen.flags & HOLLOW and not seen.flags & SCALAR:
        found = Place(T.ArrayType(T.StringType(), True), T.ArrayType(T.StringType(), True))
    else:
        kind = _scalar(seen)
        found = Place(kind, kind)
    empty = seen.flags & EMPTY or (seen.flags & HOLLOW and not isinstance(found.kind, T.ArrayType))
    if not empty or isinstance(found.kind, T.StringType):
        return found

    def from_text(value: Column) -> Column:
        text = F.nullif(F.nullif(value, F.lit("")), F.lit("[]"))
        if isinstance(found.kind, T.ArrayType):
            text = F.nullif(value, F.lit(""))
        if isinstance(found.kind, (T.ArrayType, T.StructType)):
            return found.apply(F.from_json(text, found.wire, {"mode": "FAILFAST"}))
        return text.cast(found.kind)

    return Place(found.kind, T.StringType(), from_text)


def _places(fields: dict[str, Seen], within: str, by_case: bool) -> dict[str, Place]:
    if not by_case:
        first: dict[str, str] = {}
        for name in sorted(fields):
            other = first.setdefault(name.lower(), name)
            if other != name:
                raise ValueError(
                    f"columns {within + other!r} (in {fields[other].at}) and {within + name!r} (in {fields[name].at}) differ in case alone: "
                    "rename one, or set spark.sql.caseSensitive to true"
                )
    return {name: _place(fields[name], within + name, by_case) for name in sorted(fields)}


@dataclass
class Shape:
    """An inferred schema, what the parser is given for it, and the columns to select."""

    schema: T.StructType
    wire: T.StructType
    columns: list[Column]


def shape(merged: Seen, own: Sequence[str], by_case: bool) -> Shape:
    """Of the columns ``own``, with the types that ``merged`` gives them."""
    places = _places(merged.fields or {}, "", by_case)
    held = sorted(own)
    columns = [places[n].apply(F.col(f"`{n.replace('`', '``')}`")).alias(n) for n in held]
    return Shape(
        T.StructType([T.StructField(n, places[n].kind, True) for n in held]),
        T.StructType([T.StructField(n, places[n].wire, True) for n in held]),
        columns,
    )


def _elements(text: str, decoder: json.JSONDecoder) -> Iterator:
    """The values of a document: an array's items one by one, or the one value."""
    n = len(text)
    if text[0] == "{":  # nearly every line: an object and nothing after it
        value, i = decoder.raw_decode(text)
        yield value
        if text[i:].strip(BLANK):
            raise ValueError(f"something follows the value at character {i}")
        return

    def blank(i: int) -> int:
        while i < n and text[i] in BLANK:
            i += 1
        return i

    i = blank(0)
    if text[i : i + 1] != "[":
        value, i = decoder.raw_decode(text, i)
        yield value
    else:
        i = blank(i + 1)
        while text[i : i + 1] != "]":
            value, i = decoder.raw_decode(text, i)
            yield value
            i = blank(i)
            if text[i : i + 1] == ",":
                i = blank(i + 1)
            elif text[i : i + 1] != "]":
                raise ValueError(f"expected ',' or ']' at character {i}")
        i += 1
    if blank(i) < n:
        raise ValueError(f"something follows the value at character {blank(i)}")


def _dumped(sides: dict[int, Seen], rows: dict[tuple[int, str], int], arrays: set[tuple[int, str]]) -> pa.RecordBatch:
    """A row for each side with what was seen, and one for each file with its rows."""
    seen = [(k, json.dumps(s.dump()), None, None, None) for k, s in sides.items()]
    seen += [(k, None, path, rows.get((k, path), 0), (k, path) in arrays) for k, path in rows.keys() | arrays]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*seen), _FOLDED)], schema=_FOLDED)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (side, path, bytes, unsure) to what each side and each file held; ``unsure``
    bytes are a file's, which is an array or lines."""
    sides: dict[int, Seen] = {}
    rows: dict[tuple[int, str], int] = {}
    arrays: set[tuple[int, str]] = set()
    decoder = json.JSONDecoder()
    for batch in (b.slice(a, HELD) for b in batches for a in range(0, b.num_rows, HELD)):
        for side, path, content, unsure in zip(*(c.to_pylist() for c in batch.columns)):
            documents = [content]
            if unsure and ARRAY.match(content):
                arrays.add((side, path))
            elif unsure:
                documents = content.splitlines()
            held = 0
            try:
                for document in documents:
                    text = document.removeprefix(MARK).decode("utf-8", "replace")
                    if not text.strip(BLANK):
                        continue
                    for row in _elements(text, decoder):
                        if row is None:
                            continue
                        if type(row) is not dict:
                            raise ValueError("a row is not an object")
                        if side not in sides:
                            sides[side] = Seen(path)
                        sides[side].add(row, path)
                        held += 1
            except ValueError as e:
                raise ValueError(f"malformed JSON in {path}: {e}") from e
            if held:
                rows[side, path] = rows.get((side, path), 0) + held
    if sides or arrays:
        yield _dumped(sides, rows, arrays)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sides: dict[int, Seen] = {}
    rows: dict[tuple[int, str], int] = {}
    arrays: set[tuple[int, str]] = set()
    for batch in batches:
        _take_in(batch, sides, rows, arrays)
    if sides or rows or arrays:
        yield _dumped(sides, rows, arrays)


def _take_in(folded: pa.RecordBatch | pa.Table, sides: dict[int, Seen], rows: dict[tuple[int, str], int], arrays: set[tuple[int, str]]) -> None:
    for side, dumped, path, n, array in zip(*(c.to_pylist() for c in folded.columns)):
        if dumped is not None:
            sides.setdefault(side, Seen()).merge(Seen.load(json.loads(dumped)))
            continue
        if n:
            rows[side, path] = rows.get((side, path), 0) + n
        if array:
            arrays.add((side, path))


_FOLDED = pa.schema([pa.field("side", pa.int32()), pa.field("seen", pa.string()), pa.field("path", pa.string()), pa.field("n", pa.int64()), pa.field("array", pa.bool_())])


def fold(spark: SparkSession, sources: Sequence[DataFrame]) -> tuple[dict[int, Seen], dict[tuple[int, str], int], set[tuple[int, str]]]:
    """What the rows of each side hold, the number of each file's rows (by side and path),
    and which of the ``unsure`` files are arrays; ``sources`` have ``side``, ``path``,
    ``content``, the bytes of a line or of a whole file, and ``unsure``. One job; ``MERGERS``
    tasks hand the driver one row for a side and one for a file each."""
    table = sources[0]
    for more in sources[1:]:
        table = table.union(more)
    out = "side int, seen string, path string, n long, array boolean"
    sides: dict[int, Seen] = {}
    rows: dict[tuple[int, str], int] = {}
    arrays: set[tuple[int, str]] = set()
    _take_in(table.mapInArrow(_fold, out).repartition(MERGERS).mapInArrow(_merge, out).toArrow(), sides, rows, arrays)
    return sides, rows, arrays
