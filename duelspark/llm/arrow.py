"""Arrow helpers for the operators of this package that read texts in Python."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Rows go to Python in slices of about so many bytes of text.
SLICE_BYTES = 4 << 20


_STATE: dict = {}


def kept_in_worker(key, make: Callable):
    """What ``make`` gives, kept by this Python worker for later tasks.

    A worker serves many tasks and operators; only the last state asked for stays,
    so that memos of several operators never add up.
    """
    if key not in _STATE:
        if _STATE:
            _STATE.clear()
            give_back()
        _STATE[key] = make()
    return _STATE[key]


def give_back() -> None:
    """Freed memory goes back to the system, as the JVM beside the worker needs it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only the GNU library has it
        pass


#: A memo keeps keys of up to so many bytes (or characters), and so many bytes of memory.
KEY_BYTES, MEMO_BYTES = 64, 32 << 20

#: What an entry of a dict takes beside its key and value, with the room that a dict leaves.
ENTRY_BYTES = 80

_ABSENT = object()


class Memo(dict):
    """A function of short strings that come again and again, computed once for each.

    Long keys are computed each time: in a text without blanks one key may be all
    of it. At half of ``most`` entries or ``memory`` bytes, objects and not only
    their contents, the entries become ``old``, those that were old are forgotten,
    and old ones that come again are taken over. That changes no result.
    """

    def __init__(self, make: Callable, most: int, memory: int = MEMO_BYTES):
        super().__init__()
        self.make, self.most, self.memory, self.bytes = make, most, memory, 0
        self.old: dict = {}

    def __missing__(self, key):
        made = self.old.get(key, _ABSENT)
        if made is _ABSENT:
            made = self.make(key)
        if len(key) <= KEY_BYTES:
            size = sys.getsizeof(key) + sys.getsizeof(made) + ENTRY_BYTES
            if 2 * len(self) >= self.most or 2 * (self.bytes + size) > self.memory:
                self.old = self.copy()
                self.clear()
                self.bytes = 0
            self.bytes += size
            self[key] = made
        return made


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, one row at least."""
    for batch in batches:
        rows = batch.num_rows
        each = max(1, int(most * rows / max(1, batch.nbytes)))
        for at in range(0, rows, each):
            yield batch.slice(at, each)
        # Arrow keeps what earlier batches took; one of long texts is tens of MB.
        pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x if x is not None else b"" for x in column.cast(kind).to_pylist()]


def arrow_schema(ddl: str | StructType) -> pa.Schema:
    """Only the driver can parse DDL; tasks get the schema."""
    return to_arrow_schema(_parse_datatype_string(ddl) if isinstance(ddl, str) else ddl)


def rows_of(columns: dict[str, list] | list[list], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of ``schema`` from its columns, by name or in order. Arrow columns pass as they are."""
    if isinstance(columns, dict):
        columns = [columns[name] for name in schema.names]
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def map_batches(df: DataFrame, ddl: str | StructType, each: Callable[[pa.RecordBatch], dict[str, list]], most: int = SLICE_BYTES) -> DataFrame:
    """Applies ``each`` to slices of ``df``; it returns the columns of ``ddl``."""
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in slices(batches, most):
            yield rows_of(each(batch), schema)

    return df.mapInArrow(run, ddl)
