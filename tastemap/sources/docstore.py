"""A connector for a folder of JSON documents, by Spark's Python data-source API.

A store is a folder that needs no server::

    parts/<name>.jsonl    documents of one task's write, a line each; never changed
    commits/00000001      the parts that this commit adds, with statistics, and the schema

A part counts once a commit lists it, so a task that fails or runs twice leaves no row. The
scan is split over parts and over ranges of large ones, parses with Arrow, and leaves out
parts whose least and greatest values rule out a pushed filter.
"""

import json
import operator
import os
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

NAME = "tastemap_documents"
# Bytes of a part that one task of a scan reads, and of its lines that are parsed at once.
RANGE, BLOCK = 64 << 20, 4 << 20
# A string statistic keeps so many characters.
STATISTIC = 64

# Workers get this module's classes themselves, installed or not.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def register(spark: SparkSession) -> str:
    """Make the format known to the session, filters included; gives its name."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DocumentStore)
    return NAME


def _place(path: str):
    """Arrow's file system and the path in it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def commits(path: str, version: int | None = None) -> list[dict]:
    """Commits up to ``version``, all by default, in order."""
    from pyarrow import fs

    store, root = _place(path)
    found = []
    for info in store.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True)):
        if info.base_name.isdigit() and (version is None or int(info.base_name) <= version):
            with store.open_input_stream(info.path) as file:
                found.append({"version": int(info.base_name), **json.loads(file.read())})
    return sorted(found, key=operator.itemgetter("version"))


def live_parts(path: str, version: int | None = None) -> list[dict]:
    """Parts of the store: those added since the last commit that replaced all."""
    parts: list[dict] = []
    for commit in commits(path, version):
        parts = commit["parts"] if commit["replaces"] else parts + commit["parts"]
    return parts


def clean(path: str, grace: float = 24 * 3600) -> list[str]:
    """Remove parts that no commit lists and that are older than ``grace`` seconds."""
    import time

    from pyarrow import fs

    store, root = _place(path)
    listed = {p["name"] for c in commits(path) for p in c["parts"]}
    gone = [i for i in store.get_file_info(fs.FileSelector(f"{root}/parts", allow_not_found=True))
            if i.base_name not in listed and i.mtime.timestamp() < time.time() - grace]
    for info in gone:
        store.delete_file(info.path)
    return [i.base_name for i in gone]


class DocumentStore(ds.DataSource):
    """``spark.read.format(NAME).load(path)``, and the same to write."""

    @classmethod
    def name(cls) -> str:
        return NAME

    @property
    def path(self) -> str:
        if "path" not in self.options:
            raise ValueError("a document store needs a path")
        return self.options["path"]

    @property
    def version(self) -> int | None:
        return int(self.options["version"]) if "version" in self.options else None

    def schema(self) -> StructType:
        found = commits(self.path, self.version)
        if not found:
            raise FileNotFoundError(f"no commit in {self.path}")
        return StructType.fromJson(found[-1]["schema"])

    def reader(self, schema: StructType) -> "Reader":
        return Reader(self.path, schema, self.version, int(self.options.get("range", RANGE)))

    def writer(self, schema: StructType, overwrite: bool) -> "Writer":
        return Writer(self.path, schema, overwrite)


# Reading

@dataclass
class Range(ds.InputPartition):
    """The lines of a part that begin at bytes ``start`` to ``until``."""

    name: str
    start: int
    until: int


# Filters by class: whether one is met by values from least to greatest, and by each value.
COMPARISONS = {
    ds.EqualTo: ("equal", lambda least, most, v: least <= v <= most),
    ds.LessThan: ("less", lambda least, most, v: least < v),
    ds.LessThanOrEqual: ("less_equal", lambda least, most, v: least <= v),
    ds.GreaterThan: ("greater", lambda least, most, v: most > v),
    ds.GreaterThanOrEqual: ("greater_equal", lambda least, most, v: most >= v),
}


class Reader(ds.DataSourceReader):
    def __init__(self, path: str, schema: StructType, version: int | None, size: int):
        self.path, self.fields, self.version, self.size = path, schema, version, size
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]):  # noqa: N802, the API's name
        """Take comparisons, ``IN`` and null tests of plain columns; hand back the others."""
        plain = {f.name for f in self.fields.fields
                 if f.dataType.typeName() in ("string", "long", "integer", "short", "byte", "double",
                                              "float", "boolean")}
        known = (*COMPARISONS, ds.In, ds.IsNull, ds.IsNotNull)
        for f in filters:
            if isinstance(f, known) and len(f.attribute) == 1 and f.attribute[0] in plain:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Range]:
        return [Range(part["name"], at, min(at + self.size, part["bytes"]))
                for part in live_parts(self.path, self.version) if self._may_hold(part)
                for at in range(0, part["bytes"], self.size)]

    def _may_hold(self, part: dict) -> bool:
        """Whether the statistics leave rows that meet all filters."""
        for f in self.filters:
            held = part["columns"].get(f.attribute[0])
            if held is None:
                continue
            if isinstance(f, ds.IsNull):
                meets = held["nulls"] > 0
            elif isinstance(f, ds.IsNotNull):
                meets = held["nulls"] < part["rows"]
            elif held["nulls"] == part["rows"]:
                meets = False
            elif "least" not in held:
                continue
            elif isinstance(f, ds.In):
                meets = any(v is not None and held["least"] <= v <= held["most"] for v in f.value)
            else:
                meets = f.value is not None and COMPARISONS[type(f)][1](
                    held["least"], held["most"], f.value)
            if not meets:
                return False
        return True

    def read(self, partition: Range | None) -> Iterator:
        """Rows of a range; a scan without any range is one task with none."""
        if partition is not None:
            yield from self._batches(partition)

    def _batches(self, partition: Range) -> Iterator:
        import io

        import pyarrow as pa
        import pyarrow.json as pj
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.fields)
        store, root = _place(self.path)
        with store.open_input_file(f"{root}/parts/{partition.name}") as file:
            at = partition.start
            if at:
                # The line that reaches in belongs to the range before.
                file.seek(at - 1)
                at += len(_line(file)) - 1
            while at < partition.until:
                file.seek(at)
                block = file.read(min(BLOCK, partition.until - at))
                block += b"" if block.endswith(b"\n") else _line(file)
                at += len(block)
                table = pj.read_json(
                    io.BytesIO(block), pj.ReadOptions(use_threads=False, block_size=len(block) + 1),
                    pj.ParseOptions(explicit_schema=schema, unexpected_field_behavior="ignore"))
                for batch in self._kept(table.select(schema.names)).to_batches():
                    # Spark wants fields in one form, nullable or not.
                    yield pa.record_batch(batch.columns, schema.names).cast(schema)

    def _kept(self, table):
        import pyarrow as pa
        import pyarrow.compute as pc

        for f in self.filters:
            column = table.column(f.attribute[0])
            if isinstance(f, ds.IsNull):
                mask = pc.is_null(column)
            elif isinstance(f, ds.IsNotNull):
                mask = pc.is_valid(column)
            elif isinstance(f, ds.In):
                values = pa.array([v for v in f.value if v is not None], column.type)
                mask = pc.and_(pc.is_in(column, values), pc.is_valid(column))
            elif f.value is None:
                mask = pa.chunked_array([pa.array([False] * len(column))])
            else:
                mask = getattr(pc, COMPARISONS[type(f)][0])(column, pa.scalar(f.value, column.type))
            table = table.filter(mask)
        return table


def _line(file) -> bytes:
    """The rest of the line, with its end."""
    found = b""
    while piece := file.read(1 << 16):
        end = piece.find(b"\n")
        if end >= 0:
            return found + piece[:end + 1]
        found += piece
    return found


# Writing

@dataclass
class Written(ds.WriterCommitMessage):
    """What a task has written, if it had any row."""

    part: dict | None


class Writer(ds.DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.fields, self.overwrite = path, schema, overwrite

    def write(self, iterator: Iterator) -> Written:
        store, root = _place(self.path)
        store.create_dir(f"{root}/parts", recursive=True)
        name = f"{uuid.uuid4().hex}.jsonl"
        part = {"name": name, "rows": 0, "bytes": 0,
                "columns": {f.name: {"nulls": 0} for f in self.fields.fields}}
        try:
            with store.open_output_stream(f"{root}/parts/{name}", compression=None) as out:
                for batch in iterator:
                    rows = batch.to_pylist()
                    data = "".join(json.dumps(r, ensure_ascii=False, allow_nan=False,
                                              separators=(",", ":")) + "\n" for r in rows).encode()
                    out.write(data)
                    part["rows"] += len(rows)
                    part["bytes"] += len(data)
                    for i, field in enumerate(self.fields.fields):
                        _note(part["columns"][field.name], batch.column(i))
        except BaseException:
            _remove(self.path, name)
            raise
        if not part["rows"]:
            _remove(self.path, name)
            return Written(None)
        return Written(part)

    def commit(self, messages: list[Written | None]) -> None:
        parts = [m.part for m in messages if m is not None and m.part]
        store, root = _place(self.path)
        store.create_dir(f"{root}/commits", recursive=True)
        text = json.dumps({"parts": parts, "replaces": self.overwrite,
                           "schema": self.fields.jsonValue()}).encode()
        while True:
            number = max((c["version"] for c in commits(self.path)), default=0) + 1
            if _claim(store, f"{root}/commits", number, text):
                return

    def abort(self, messages: list[Written | None]) -> None:
        for message in messages:
            if message is not None and message.part:
                _remove(self.path, message.part["name"])


def _note(held: dict, column) -> None:
    """Add a column's values to its statistics."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held["nulls"] += column.null_count
    kind = column.type
    plain = pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_string(kind)
    if not plain or column.null_count == len(column):
        return
    least, most = (v.as_py() for v in pc.min_max(column).values())
    if isinstance(most, str):
        # Cut short, the greatest one must not become smaller than what it stands for.
        least, most = least[:STATISTIC], most if len(most) <= STATISTIC \
            else most[:STATISTIC] + chr(sys.maxunicode)
    held["least"] = min(held.get("least", least), least)
    held["most"] = max(held.get("most", most), most)


def _claim(store, folder: str, number: int, text: bytes) -> bool:
    """Let a commit appear whole, if there is none of that number yet."""
    from pyarrow import fs

    name, draft = f"{folder}/{number:08d}", f"{folder}/.{uuid.uuid4().hex}"
    with store.open_output_stream(draft, compression=None) as out:
        out.write(text)
    try:
        if isinstance(store, fs.LocalFileSystem):
            os.link(draft, name)
            return True
        # Stores whose move replaces a file can lose one of two commits at the same moment.
        if store.get_file_info(name).type != fs.FileType.NotFound:
            return False
        store.move(draft, name)
        return True
    except FileExistsError:
        return False
    finally:
        if store.get_file_info(draft).type != fs.FileType.NotFound:
            store.delete_file(draft)


def _remove(path: str, name: str) -> None:
    from pyarrow import fs

    store, root = _place(path)
    if store.get_file_info(f"{root}/parts/{name}").type != fs.FileType.NotFound:
        store.delete_file(f"{root}/parts/{name}")
