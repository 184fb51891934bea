"""Sources and sinks: tables, pages, JSON records, stage folders, graphs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE = T.StructType([T.StructField(n, t) for n, t in (("source", T.StringType()), ("filename", T.StringType()), ("page", T.IntegerType()), ("page_1idx", T.IntegerType()), ("markdown", T.StringType()), ("char_count", T.IntegerType()), ("page_type", T.StringType()), ("content_type", T.StringType()))])
GOLD = T.StructType([T.StructField("id", T.StringType()), T.StructField("user_input", T.StringType()), T.StructField("reference", T.StringType()), T.StructField("reference_contexts", T.ArrayType(T.StringType()))])
PREDICTION = T.StructType(
    [T.StructField("question", T.StringType()), T.StructField("answer", T.StringType()), T.StructField("reasoning", T.StringType()), T.StructField("evidence", T.ArrayType(T.StringType()))]
    + [T.StructField("confidence", T.DoubleType()), T.StructField("run_at", T.StringType()), T.StructField("errors", T.ArrayType(T.StringType()))]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder; filters and columns reach the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents_as_pages(files: DataFrame, parse: Callable[[bytes], list[str]]) -> DataFrame:
    """Pages of binary files ``(path, content)`` by a parser that gives a text for each page; a file that it fails on is left out."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for path, content in zip(part["path"], part["content"], strict=True):
                try:
                    texts = parse(bytes(content))
                except Exception:  # noqa: BLE001  A broken file must not end the job.
                    continue
                rows += [(path, path.rsplit("/", 1)[-1], i, i + 1, t, len(t), None, None) for i, t in enumerate(texts)]
            yield pd.DataFrame(rows, columns=PAGE.names)

    return files.select("path", "content").mapInPandas(run, PAGE)


def binary_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)


def text_pages(content: bytes) -> list[str]:
    """The pages of a text file, with form feeds between them."""
    return content.decode("utf-8").split("\f")


def json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of a JSON array, or of JSON lines, with an explicit schema."""
    first = spark.read.text(path).filter(F.trim("value") != "").first()
    lines = first is not None and first[0].strip().startswith("{") and first[0].strip().endswith("}")
    return spark.read.schema(schema).option("multiLine", str(not lines).lower()).json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


class Stages:
    """Stage tables under a folder, each done when its success marker is there."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, number: int, name: str) -> str:
        return f"{self.folder}/stage{number:02d}_{name}"

    def done(self, number: int, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.path(number, name)}/_SUCCESS"))

    def save(self, number: int, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(number, name))
        return self.load(number, name, df.schema)

    def load(self, number: int, name: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(self.path(number, name))

    def invalidate(self, number: int) -> list[str]:
        """Drops the tables of a stage and of those after it; returns their names."""
        gone = []
        for status in self._fs.listStatus(self._path(self.folder)) if self._fs.exists(self._path(self.folder)) else []:
            name = status.getPath().getName()
            if name.startswith("stage") and name[5:7].isdigit() and int(name[5:7]) >= number:
                self._fs.delete(status.getPath(), True)
                gone.append(name)
        return sorted(gone)

    def run(self, number: int, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return self.load(number, name) if self.done(number, name) else self.save(number, name, make())


class Versions:
    """A table, or a folder of tables, kept as numbered versions: a new one is written beside those that are read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def all(self) -> list[str]:
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder)))
        return [f"{self.folder}/{n}" for n in names if n.startswith("v")]

    def latest(self) -> str | None:
        return (self.all() or [None])[-1]

    def next(self) -> str:
        return f"{self.folder}/v{len(self.all()):08d}"

    def read(self, schema: str) -> DataFrame:
        """The latest version, or an empty table."""
        return self.spark.read.schema(schema).parquet(self.latest()) if self.latest() else self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame) -> DataFrame:
        path = self.next()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def write_graph(nodes: DataFrame, edges: DataFrame, folder: str) -> None:
    """Nodes by label and edges by type, so reads of one label or type touch its files alone."""
    nodes.write.mode("overwrite").partitionBy("label").parquet(f"{folder}/nodes")
    edges.write.mode("overwrite").partitionBy("type").parquet(f"{folder}/edges")


def read_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{folder}/nodes"), spark.read.parquet(f"{folder}/edges")


def first_json_object(text: str) -> str | None:
    """The first balanced object of a program's output; lines that begin with a time of day are log lines, braces in strings do not count."""
    import re

    body = "\n".join(line for line in text.splitlines() if not re.match(r"\s*\d{2}:\d{2}:\d{2}", line))
    start = body.find("{")
    while start >= 0:
        depth, quoted, escaped = 0, False, False
        for i in range(start, len(body)):
            c = body[i]
            if quoted:
                quoted, escaped = (c != '"' or escaped), (c == "\\" and not escaped)
            elif c == '"':
                quoted = True
            elif c in "{}":
                depth += 1 if c == "{" else -1
                if not depth:
                    return body[start : i + 1]
        start = body.find("{", start + 1)
    return None


@F.pandas_udf(T.StringType())
def extract_json(text: pd.Series) -> pd.Series:
    """``first_json_object`` of each text."""
    return text.map(lambda t: None if t is None else first_json_object(t))
