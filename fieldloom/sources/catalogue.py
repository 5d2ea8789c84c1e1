"""A scene catalogue on files as a Spark data source, with filters pushed into it.

Items lie as JSON lines in <root>/tile=<tile>/month=<yyyy-mm>/. Comparisons of the columns with constants go to the source: those of tile and ts choose the
folders, and all of them the rows; any other filter stays with Spark. A partition of the plan is some folders of about `bytes` in all.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.json
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

NAME = "fieldloom_catalogue"
ITEM = pa.schema([("scene_id", pa.int64()), ("ts", pa.timestamp("us")), ("cloud", pa.float64()), ("nodata", pa.float64()), *[(c, pa.float64()) for c in ("x0", "y0", "x1", "y1")]])
SCHEMA = "scene_id bigint, tile string, ts timestamp_ntz, cloud double, nodata double, x0 double, y0 double, x1 double, y1 double"
TESTS = {EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal}


def write_catalogue(items: DataFrame, root: str) -> None:
    """items: the columns of SCHEMA. One folder for each tile and month; rows without tile or time are left out, as no search finds them."""
    rows = items.filter("tile is not null and ts is not null").withColumn("month", F.date_format("ts", "yyyy-MM"))
    rows = rows.withColumns({"tile": F.col("tile").cast("string"), "ts": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")})
    rows.repartition("tile", "month").write.mode("overwrite").partitionBy("tile", "month").json(root)


def _files(root: str):
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/(?=[^/])", "file:///", root)) if ":" in root else (pyarrow.fs.LocalFileSystem(), root)


class Folders(InputPartition):
    def __init__(self, folders: list[tuple[str, list[str]]]):
        super().__init__(tuple(folders))


class CatalogueReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.bytes = options["path"], int(options.get("bytes", 16_000_000))
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = getattr(f, "attribute", None)
            simple = isinstance(f, (*TESTS, In, IsNotNull)) and column is not None and len(column) == 1
            if simple:
                self.tests.append(f)
            else:
                yield f

    def _wanted(self, tile: str, month: str) -> bool:
        first = dt.datetime(int(month[:4]), int(month[5:7]), 1)
        after = dt.datetime(first.year + first.month // 12, first.month % 12 + 1, 1)
        for f in self.tests:
            if f.attribute == ("tile",):
                if isinstance(f, EqualTo) and f.value != tile or isinstance(f, In) and tile not in f.value:
                    return False
            elif f.attribute == ("ts",):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and after <= f.value or isinstance(f, LessThan) and first >= f.value or isinstance(f, LessThanOrEqual) and first > f.value:
                    return False
                if isinstance(f, EqualTo) and not first <= f.value < after:
                    return False
        return True

    def partitions(self) -> list[InputPartition]:
        fs, root = _files(self.root)
        found: dict[tuple[str, str], list] = {}
        for tile in fs.get_file_info(pyarrow.fs.FileSelector(root)):
            # Spark escapes what a folder's name may not hold
            name = re.fullmatch(r"tile=(.*)", unquote(tile.base_name))
            # folders of other tiles are not even listed
            if not name or not self._wanted_tile(name[1]):
                continue
            for month in fs.get_file_info(pyarrow.fs.FileSelector(tile.path)):
                when = re.fullmatch(r"month=(\d{4}-\d\d)", month.base_name)
                if when and self._wanted(name[1], when[1]):
                    found[name[1], when[1]] = [i for i in fs.get_file_info(pyarrow.fs.FileSelector(month.path)) if i.base_name.endswith(".json")]
        out, held, size = [], [], 0
        for (tile, _), files in sorted(found.items()):
            held.append((tile, [i.path for i in files]))
            size += sum(i.size for i in files)
            if size >= self.bytes:
                out.append(Folders(held))
                held, size = [], 0
        return [*out, Folders(held)] if held or not out else out

    def _wanted_tile(self, tile: str) -> bool:
        return not any(f.attribute == ("tile",) and (isinstance(f, EqualTo) and f.value != tile or isinstance(f, In) and tile not in f.value) for f in self.tests)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        fs = _files(self.root)[0]
        order = ["scene_id", "tile", "ts", "cloud", "nodata", "x0", "y0", "x1", "y1"]
        for tile, files in partition.value:
            for path in files:
                with fs.open_input_stream(path) as stream:
                    rows = pyarrow.json.read_json(stream, parse_options=pyarrow.json.ParseOptions(explicit_schema=ITEM, unexpected_field_behavior="ignore"))
                rows = rows.append_column("tile", pa.array([tile] * len(rows), pa.string())).select(order)
                for f in self.tests:
                    column = rows.column(f.attribute[0])
                    if isinstance(f, IsNotNull):
                        keep = column.is_valid()
                    elif isinstance(f, In):
                        keep = pc.is_in(column, pa.array(list(f.value), column.type))
                    else:
                        keep = TESTS[type(f)](column, pa.scalar(f.value, column.type))
                    rows = rows.filter(keep)
                yield from rows.to_batches()


class CatalogueSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return CatalogueReader(self.options)


def read_catalogue(spark: SparkSession, root: str, **options) -> DataFrame:
    """The catalogue under root (the columns of SCHEMA). Filters reach the source, for which this turns on the session's switch."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CatalogueSource)
    return spark.read.format(NAME).options(**{k: str(v) for k, v in options.items()}).load(root)
