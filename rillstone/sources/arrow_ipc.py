"""Arrow IPC files as a Spark data source: one partition per record batch on reading, one file per task on writing.

    spark.dataSource.register(ArrowIpc)
    spark.read.format("arrow_ipc").load(path)          # the columns, and _row with option("row", "true")
    df.write.format("arrow_ipc").mode("overwrite").save(folder)

option("skip_unreadable", "true") leaves out batches that can't be decoded (see reading.unreadable for which they are).
"""

from __future__ import annotations

import os
import struct
import uuid

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import LongType, StructType


def _filesystem(path: str):
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{os.path.abspath(path)}")


def _files(path: str) -> list[str]:
    import pyarrow.fs as pafs

    fs, p = _filesystem(path)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.Directory:
        return sorted(f.path for f in fs.get_file_info(pafs.FileSelector(p)) if f.is_file and not os.path.basename(f.path).startswith(("_", ".")))
    return [p]


class Batch(InputPartition):
    def __init__(self, path: str, index: int, first: int):
        self.path, self.index, self.first = path, index, first


def _at(b: bytes, table: int, field: int) -> int | None:
    """Where a field of a flatbuffer table lies, or None."""
    vtable = table - struct.unpack_from("<i", b, table)[0]
    if 4 + 2 * field >= struct.unpack_from("<H", b, vtable)[0]:
        return None
    off = struct.unpack_from("<H", b, vtable + 4 + 2 * field)[0]
    return table + off if off else None


def _ref(b: bytes, at: int) -> int:
    return at + struct.unpack_from("<I", b, at)[0]


def batch_rows(f, size: int) -> list[int]:
    """Rows of each record batch of an IPC file, from the footer and the batches' headers; no batch is decoded."""
    f.seek(size - 10)
    n = struct.unpack("<i", f.read(4))[0]
    f.seek(size - 10 - n)
    foot = f.read(n)
    blocks = _at(foot, _ref(foot, 0), 3)
    if blocks is None:
        return []
    v = _ref(foot, blocks)
    out = []
    for k in range(struct.unpack_from("<I", foot, v)[0]):
        offset, length = struct.unpack_from("<qi", foot, v + 4 + 24 * k)
        f.seek(offset)
        raw = f.read(length)
        head = raw[8:] if raw[:4] == b"\xff\xff\xff\xff" else raw[4:]
        batch = _ref(head, _at(head, _ref(head, 0), 2))
        rows = _at(head, batch, 0)
        out.append(struct.unpack_from("<q", head, rows)[0] if rows is not None else 0)
    return out


class ArrowIpcReader(DataSourceReader):
    def __init__(self, path: str, row: bool, skip: bool):
        self.path, self.row, self.skip = path, row, skip

    def partitions(self):
        fs, _ = _filesystem(self.path)
        out = []
        for p in _files(self.path):
            with fs.open_input_file(p) as f:
                first = 0
                for i, n in enumerate(batch_rows(f, f.size())):
                    out.append(Batch(p, i, first))
                    first += n
        return out

    def read(self, partition):
        fs, _ = _filesystem(self.path)
        with fs.open_input_file(partition.path) as f:
            try:
                b = pa.ipc.open_file(f).get_batch(partition.index)
            except (OSError, pa.ArrowException):
                if self.skip:
                    return
                raise
            b = pa.RecordBatch.from_arrays([_plain(c) for c in b.columns], b.schema.names)
            if self.row:
                b = b.append_column("_row", pa.array(range(partition.first, partition.first + b.num_rows), pa.int64()))
            yield b


def _plain(c: pa.Array) -> pa.Array:
    """Large lists and large binaries in their ordinary form."""
    t = c.type
    if pa.types.is_large_list(t):
        return c.cast(pa.list_(t.value_type))
    if pa.types.is_large_binary(t):
        return c.cast(pa.binary())
    return c


class _Done(WriterCommitMessage):
    def __init__(self, path: str):
        self.path = path


class ArrowIpcWriter(DataSourceArrowWriter):
    """Tasks write to a staging folder of the run; only the parts of tasks that the commit names are moved to the target, and
    only then, when overwriting, are the old parts removed. A failed or speculative attempt leaves nothing to be read."""

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.stage = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator):
        fs, p = _filesystem(self.path)
        fs.create_dir(f"{p}/{self.stage}", recursive=True)
        schema = _item_lists(to_arrow_schema(self.schema))
        target = f"{p}/{self.stage}/part-{uuid.uuid4().hex}.arrow"
        with fs.open_output_stream(target) as out, pa.ipc.new_file(out, schema) as w:
            for b in iterator:
                w.write_batch(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.columns, schema)], schema=schema))
        return _Done(target)

    def commit(self, messages):
        publish(self.path, self.stage, [m.path for m in messages if m is not None], self.overwrite)

    def abort(self, messages):
        publish(self.path, self.stage, [], False)


def publish(path: str, stage: str, parts: list[str], overwrite: bool) -> None:
    """Staged parts to the folder, then old parts away if overwriting, then the staging folder."""
    import pyarrow.fs as pafs

    fs, p = _filesystem(path)
    if fs.get_file_info(p).type != pafs.FileType.Directory:
        if not parts:
            return
        fs.create_dir(p, recursive=True)
    old = [f.path for f in fs.get_file_info(pafs.FileSelector(p)) if not os.path.basename(f.path).startswith("_staging-")]
    for part in parts:
        fs.move(part, f"{p}/{os.path.basename(part)}")
    if overwrite:
        for f in old:
            fs.delete_dir(f) if fs.get_file_info(f).type == pafs.FileType.Directory else fs.delete_file(f)
    if fs.get_file_info(f"{p}/{stage}").type == pafs.FileType.Directory:
        fs.delete_dir(f"{p}/{stage}")


def _item_lists(schema: pa.Schema) -> pa.Schema:
    """List items are called `item` and may be null, as the contract of the graph file has it."""
    return pa.schema([pa.field(f.name, pa.list_(pa.field("item", f.type.value_type, True)), f.nullable) if pa.types.is_list(f.type) else f for f in schema])


class ArrowIpc(DataSource):
    @classmethod
    def name(cls):
        return "arrow_ipc"

    def _row(self) -> bool:
        return self.options.get("row", "false") == "true"

    def schema(self):
        fs, _ = _filesystem(self.options["path"])
        with fs.open_input_file(_files(self.options["path"])[0]) as f:
            s = pa.ipc.open_file(f).schema
        plain = pa.schema([pa.field(x.name, _plain(pa.array([], x.type)).type, True) for x in s])
        out = from_arrow_schema(plain)
        return out.add("_row", LongType()) if self._row() else out

    def reader(self, schema):
        return ArrowIpcReader(self.options["path"], self._row(), self.options.get("skip_unreadable", "false") == "true")

    def writer(self, schema, overwrite):
        return ArrowIpcWriter(self.options["path"], schema, overwrite)
