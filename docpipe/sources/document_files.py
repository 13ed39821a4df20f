"""A sink of one file for each document, without a partition folder for each.

A Python data source: every task writes its files under a folder of its own and moves each to
its place when all are written; the last of several files of one name stays. A task that fails
or is lost leaves nothing in place but what an equal task writes again, so a rerun changes
nothing. The driver hears one count from each task; it lists no documents.
"""

from __future__ import annotations

import re
import uuid
import zlib
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "document_files"


@dataclass
class _Written(WriterCommitMessage):
    files: int


def file_name(doc_id: str) -> str:
    """The id with everything but letters, digits, ``._-`` as %XX, so that two ids never share a name."""
    name = re.sub(r"[^A-Za-z0-9._-]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), doc_id)
    return re.sub(r"^\.", "%2E", name)


class DocumentFiles(DataSource):
    """Rows (doc_id string, value string) as files ``<path>/<doc_id><suffix>``; option ``fanout`` puts them in so many subfolders."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "doc_id string, value string"

    def writer(self, schema, overwrite: bool):
        return _Writer(self.options["path"], self.options.get("suffix", ""), int(self.options.get("fanout", "1")))


class _Writer(DataSourceWriter):
    def __init__(self, path: str, suffix: str, fanout: int):
        self.uri = path if re.match(r"\w[\w+.-]*:/", path) else f"file://{path}"
        self.suffix, self.fanout, self.job = suffix, fanout, uuid.uuid4().hex

    def _store(self):
        return pafs.FileSystem.from_uri(self.uri)

    def _place(self, root: str, name: str) -> str:
        part = f"{zlib.crc32(name.encode()) % self.fanout:04d}/" if self.fanout > 1 else ""
        return f"{root}/{part}{name}{self.suffix}"

    def write(self, iterator):
        store, root = self._store()
        own = f"{root}/_writing/{self.job}/{uuid.uuid4().hex}"
        store.create_dir(own, recursive=True)
        written: dict[str, str] = {}
        for row in iterator:
            name = file_name(row.doc_id)
            held = written.setdefault(name, f"{own}/{len(written)}")
            with store.open_output_stream(held) as f:
                f.write((row.value or "").encode())
        if self.fanout > 1:
            for k in range(self.fanout):
                store.create_dir(f"{root}/{k:04d}", recursive=True)
        for name, held in written.items():
            store.move(held, self._place(root, name))
        return _Written(len(written))

    def commit(self, messages) -> None:
        store, root = self._store()
        with store.open_output_stream(f"{root}/_SUCCESS") as f:
            f.write(str(sum(m.files for m in messages if m)).encode())
        self._clear(store, root)

    def abort(self, messages) -> None:
        self._clear(*self._store())

    def _clear(self, store, root) -> None:
        folder = f"{root}/_writing/{self.job}"
        if store.get_file_info(folder).type == pafs.FileType.Directory:
            store.delete_dir(folder)


def write_document_files(df: DataFrame, doc_id: Column, value: Column, path: str, suffix: str, fanout: int = 1, order: Column | None = None) -> None:
    """One file for each id. Rows without an id are left out; of rows that share one the last in ``order`` stays (then the greatest value)."""
    spark = df.sparkSession
    spark.dataSource.register(DocumentFiles)
    rows = df.select(doc_id.cast("string").alias("doc_id"), value.cast("string").alias("value"), (order if order is not None else F.lit(0)).alias("_order")).where("doc_id is not null")
    rows = rows.repartition("doc_id").sortWithinPartitions("doc_id", "_order", "value").select("doc_id", "value")
    rows.write.format(FORMAT).mode("append").option("suffix", suffix).option("fanout", fanout).save(path)
