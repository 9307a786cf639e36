"""A content-addressed object sink (S20): each body once, under a key that ends in its SHA-256."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

INDEX = "object_key string, byte_size long, content_type string"


def reached(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    path = path.rstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    index: str | None
    objects: int


class ObjectWriter(DataSourceArrowWriter):
    """Bodies are written aside and moved to their key, and only if no object has it; a move replaces equal content, so a task that runs again, or
    twice at a time, leaves one object.  Each task lists what it has put in a file of its own; the driver moves the
    lists into the index when all tasks are done, so the index names whole jobs only, and nothing but file names passes the driver."""

    def __init__(self, path: str):
        self.path, self.job = path.rstrip("/"), uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = reached(self.path)
        aside = f"{root}/_staging/{self.job}/{uuid.uuid4().hex}"
        listed, folders = {}, set()
        for batch in iterator:
            for key, body, kind in zip(*(batch.column(c).to_pylist() for c in ("object_key", "body", "content_type")), strict=True):
                body = body or b""
                if key is None or key.rsplit("/", 1)[-1] != hashlib.sha256(body).hexdigest() or ".." in key.split("/"):
                    raise ValueError(f"not the key of this body: {key}")
                target = f"{root}/objects/{key}"
                if not listed:
                    store.create_dir(aside, recursive=True)
                if store.get_file_info(target).type == fs.FileType.NotFound:
                    if (folder := target.rsplit("/", 1)[0]) not in folders:
                        store.create_dir(folder, recursive=True)
                        folders.add(folder)
                    with store.open_output_stream(f"{aside}/body") as out:
                        out.write(body)
                    store.move(f"{aside}/body", target)
                listed[key] = {"object_key": key, "byte_size": len(body), "content_type": kind}
        if not listed:
            return Written(None, 0)
        with store.open_output_stream(f"{aside}/index") as out:
            out.write("".join(json.dumps(x) + "\n" for x in listed.values()).encode())
        return Written(f"{aside}/index", len(listed))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = reached(self.path)
        store.create_dir(f"{root}/index", recursive=True)
        for m in messages:
            if m is not None and m.index is not None:
                store.move(m.index, f"{root}/index/{self.job}-{uuid.uuid4().hex}.json")
        self._clear()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Objects that were put stay: their keys say what they hold, and a later job finds them."""
        self._clear()

    def _clear(self) -> None:
        """Lists of attempts that failed go with the job's folder; what a task still writes after an abort stays there, and nothing reads it."""
        store, root = reached(self.path)
        if store.get_file_info(f"{root}/_staging/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/_staging/{self.job}")


class ObjectSink(DataSource):
    """df.write.format("objects").mode("append").save(path) with columns object_key, body, content_type.

    The folder must be one that pyarrow can reach from the driver and all executors, under the same name.
    """

    @classmethod
    def name(cls) -> str:
        return "objects"

    def writer(self, schema: StructType, overwrite: bool) -> ObjectWriter:
        if overwrite:
            raise ValueError("objects are only added")
        if missing := {"object_key", "body", "content_type"} - set(schema.names):
            raise ValueError(f"missing columns: {sorted(missing)}")
        return ObjectWriter(self.options["path"])


def put(objects: DataFrame, path: str) -> None:
    """Puts rows (object_key, body, content_type): each key once, however often it comes.  Bodies aren't shuffled: whether an object
    is there is asked of the store."""
    spark = objects.sparkSession
    spark.dataSource.register(ObjectSink)
    objects.select("object_key", F.col("body").cast("binary").alias("body"), "content_type").write.format("objects").mode("append").save(path)


def index(spark: SparkSession, path: str) -> DataFrame:
    """Keys, sizes and types of all objects that whole jobs have put."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/index")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).json(f"{path.rstrip('/')}/index").groupBy("object_key").agg(F.any_value("byte_size").alias("byte_size"), F.any_value("content_type").alias("content_type"))


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The objects of the index with their bodies: object_key, body.  Tasks read them by their keys, so that no folder is listed and
    many small objects are one task's work."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = reached(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                keys = batch.column("object_key").slice(start, 64)
                bodies = []
                for key in keys.to_pylist():
                    with store.open_input_stream(f"{root}/objects/{key}") as f:
                        bodies.append(f.read())
                yield pa.RecordBatch.from_arrays([keys, pa.array(bodies, pa.binary())], names=["object_key", "body"])

    return index(spark, path).select("object_key").mapInArrow(read, "object_key string, body binary")
