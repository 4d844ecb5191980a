"""User code on the slow path: Arrow-batched and built once per Python worker.

- ``batch_map``: a function over pandas batches (``mapInPandas``), for maps the
  built-in expressions cannot state. It is an optimizer barrier, so the input
  is projected to the needed columns first.
- ``encode_with``: a plug-in tokenizer as an iterator ``arrow_udf``; the
  factory runs once per worker process, then every batch reuses the object.
- ``custom_chat``: a user chat renderer as a scalar ``arrow_udf``, a few rows at a
  time as Python objects.
"""

from __future__ import annotations

import ctypes
import datetime as dt
import gc
import hashlib
import itertools
import resource
import sys
import types
from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHATS = 64  # held as Python objects at once; an Arrow batch has thousands

_CACHE_MODULE = "corpusmill_worker_cache"


#: bytes that resources other than the one in use may hold in a worker process
CACHE_BYTES = 64 << 20


def _cache() -> OrderedDict:
    """Per-process cache. This module is pickled by value into UDFs, so its
    own globals are fresh for every task; the cache lives in a module kept in
    ``sys.modules`` instead, which lasts as long as the worker process."""
    mod = sys.modules.get(_CACHE_MODULE)
    if mod is None:
        mod = types.ModuleType(_CACHE_MODULE)
        mod.objects = OrderedDict()
        sys.modules[_CACHE_MODULE] = mod
    return mod.objects


def resource_key(factory: Callable[[], object]) -> str:
    """Stable identity of a factory across pickling (computed on the driver)."""
    from pyspark import cloudpickle

    return hashlib.sha1(cloudpickle.dumps(factory)).hexdigest()


def _resident() -> int:
    """Bytes of memory this process holds (its peak, where that is all there is)."""
    try:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * resource.getpagesize()
    except OSError:
        return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss << 10


def give_back() -> None:
    """Returns freed memory to the system, as far as the platform can."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def worker_resource(factory: Callable[[], object], key: str, limit: int | None = None):
    """The object ``factory()`` builds, created once per Python worker process
    (workers are reused across tasks, so later tasks find it built).

    A worker outlives the job that built a resource. Those of earlier stages stay, the
    last used first, while they hold at most ``limit`` bytes together (``CACHE_BYTES``),
    measured by what the process grew when each was built or, if the object has it, by
    its ``cache_bytes()``; the others are dropped and their memory given back. What the
    running stage uses always stays."""
    cache = _cache()
    task = TaskContext.get()
    stage = task.stageId() if task else None
    held = cache.pop(key, None)
    if held is None:
        before = _resident()
        obj = factory()
        held = (obj, max(0, _resident() - before), stage)
    room = CACHE_BYTES if limit is None else limit
    for other in reversed(list(cache)):
        obj, size, used = cache[other]
        if stage is not None and used == stage:
            continue
        room -= obj.cache_bytes() if hasattr(obj, "cache_bytes") else size
        if room < 0:
            del cache[other]
    cache[key] = (held[0], held[1], stage)
    if room < 0:
        give_back()
    return held[0]


def release_resources() -> None:
    """Drops all that this worker process holds (for a caller's own tasks that need the
    memory; the next user builds its resource anew)."""
    if _cache():
        _cache().clear()
        give_back()


def batch_map(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Apply ``fn`` to each Arrow batch of ``df[columns]``."""
    src = df.select(*columns) if columns is not None else df

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)

    return src.mapInPandas(run, schema)


def _ids_of(result, n: int) -> list:
    """Accept ``{'input_ids': [...]}`` mappings (tokenizer-style) or lists."""
    if hasattr(result, "keys") and "input_ids" in result:
        result = result["input_ids"]
    result = list(result)
    if len(result) != n:
        raise ValueError(f"tokenizer returned {len(result)} rows for {n} texts")
    return result


def encode_with(factory: Callable[[], Callable[[list[str]], object]]) -> Callable[[Column], Column]:
    """Column encoder backed by a user tokenizer.

    ``factory()`` returns a callable taking a list of texts and returning either
    a list of id lists or a mapping with ``input_ids``. It is called once per
    worker; truncation is applied natively afterwards."""

    key = resource_key(factory)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = worker_resource(factory, key)
        for s in batches:
            texts = s.to_pylist()
            yield _lists(_ids_of(tok(texts), len(texts)))

    return lambda col: _encode(F.coalesce(col.cast("string"), F.lit("")))


def _lists(ids: list) -> pa.ListArray:
    """Id lists as one array of values and their offsets, with no object for each."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    total = int(lengths.sum())
    if any(isinstance(x, np.ndarray) for x in ids):
        values = np.concatenate([np.asarray(x, np.int32) for x in ids])
    else:
        values = np.fromiter(itertools.chain.from_iterable(ids), np.int32, total)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.array(values))


def _plain(value):
    """Rows, arrays and dicts of a column as plain dicts and lists, nulls left out."""
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items() if v is not None}
    if isinstance(value, (list, tuple, np.ndarray)):
        return [_plain(v) for v in value]
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)  # in the session's zone, as Spark's own conversions have it
    return value


def _as_messages(value) -> list[dict]:
    """Messages with every field that they have; role and content in any case."""
    if value is None:
        return []
    return [{"role": None, "content": None, **_plain(m)} for m in value if m is not None]


def _values(array: pa.Array) -> list:
    return array.to_pylist(maps_as_pydicts="strict")


def custom_chat(fn: Callable[[list[dict], bool], str], add_generation_prompt: bool, on_error: str = "plain"):
    """``(messages, fallback) -> text`` with ``fn(messages, add_generation_prompt)``.

    When ``fn`` raises, the row's ``fallback`` is used if it is not null and
    ``on_error == 'plain'``; otherwise the error propagates (messages rows
    pass a null fallback, so their failures always raise)."""

    @F.arrow_udf(T.StringType())
    def _render(msgs: pa.Array, fallback: pa.Array) -> pa.Array:
        done = []
        for a in range(0, len(msgs), CHATS):
            out = []
            for m, fb in zip(_values(msgs.slice(a, CHATS)), _values(fallback.slice(a, CHATS))):
                try:
                    out.append(fn(_as_messages(m), add_generation_prompt))
                except Exception:
                    if fb is None or on_error != "plain":
                        raise
                    out.append(fb)
            done.append(pa.array(out, pa.string()))
        return pa.concat_arrays(done) if done else pa.array([], pa.string())

    return lambda msgs, fallback: _render(msgs, fallback)
