"""Landing raw files in the bronze layer with every byte as it is.

Files are read as lines that end in a given character and written with the same one, so bytes come out as they went in,
whatever their quoting, line ends or encoding. A file that ends in a line break is landed in the parts that Spark splits it
into, all its tasks at once; parts are named by file and by where they start, so that in this order they make up the file.
Other files, and those with line breaks in cells, have to stay whole to be parsed: each becomes one part.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.sources import storage
from truegrain.sources.files import csv_reader

#: Parts with a header that can be split on, parts that go on without one, and whole files.
FIRST, REST, WHOLE = "first", "rest", "whole"
BYTE_ORDER_MARK = b"\xef\xbb\xbf"


def _ending(spark: SparkSession, path: str, size: int) -> str:
    """The last character of a file in UTF-8."""
    tail = storage.some_bytes(spark, path, max(0, size - 4), 4)
    for n in range(1, len(tail) + 1):
        try:
            return tail[-n:].decode()
        except UnicodeDecodeError:
            continue
    raise ValueError(f"{path} does not end in a character of UTF-8, so it is no text to land")


def land(spark: SparkSession, source: str, target: str, multi_line: bool = False) -> DataFrame:
    """Bring a file, or all files of a folder, into the bronze layer at ``target``, replacing what is there.

    Returns ``file_no, source_file, bytes, marked``, one row per file in the order of paths. A landed file that differs in length from its
    source, as a compressed one would, is an error. A byte order mark is kept.
    """
    sources = storage.data_files(spark, source)
    endings = defaultdict(list)
    marked = []
    for number, (path, size) in enumerate(sources):
        if size:
            endings[_ending(spark, path, size)].append((number, path))
            if storage.some_bytes(spark, path, 0, 3) == BYTE_ORDER_MARK:
                marked.append(number)
    system, place = storage.located(spark, target)
    system.delete(place, True)
    for ending, files in endings.items():
        split = ending == "\n" and not multi_line
        lines = spark.read.option("lineSep", ending).text([path for _, path in files])
        named = [(number, storage.uri(spark, path)) for number, path in files]
        numbers = spark.createDataFrame(named, "file int, __path string")  # as many rows as the listing has files
        placed = lines.select(
            "value", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("at"),
            F.monotonically_increasing_id().alias("__line"),
        ).join(F.broadcast(numbers), "__path")
        if marked:  # the reader takes the mark off the first line
            heads = placed.where(F.col("file").isin(marked) & (F.col("at") == 0)).groupBy("file").agg(F.min("__line").alias("__line"))
            placed = placed.join(F.broadcast(heads.withColumn("__head", F.lit(True))), ["file", "__line"], "left")
            mark = F.lit(BYTE_ORDER_MARK.decode())
            placed = placed.withColumn("value", F.when(F.col("__head"), F.concat(mark, "value")).otherwise(F.col("value")))
        if split:
            kept = placed.withColumn("kind", F.when(F.col("at") == 0, FIRST).otherwise(REST))
        else:
            kept = placed.repartition("file").withColumn("kind", F.lit(WHOLE))
        kept = kept.sortWithinPartitions("kind", "file", *(["at"] if split else []), *(["__line"] if split else ["at", "__line"]))
        kept = kept.select("value", "kind", "file", "at" if split else F.lit(0).cast("long").alias("at"))
        kept.write.mode("append").partitionBy("kind", "file", "at").option("lineSep", ending).text(target)
    sizes = defaultdict(int)
    for path, size in storage.data_files(spark, target) if endings else []:
        sizes[_number_of(path)] += size
    for number, (path, size) in enumerate(sources):
        if sizes[number] != size:
            raise RuntimeError(f"{path} has {size} bytes, but {sizes[number]} were landed")
    rows = [(number, path, size, number in marked) for number, (path, size) in enumerate(sources)]
    return spark.createDataFrame(rows, "file_no int, source_file string, bytes long, marked boolean")


def _number_of(path: str) -> int:
    return int(path.rsplit("/file=", 1)[1].split("/", 1)[0])


def parts_of(spark: SparkSession, target: str) -> dict[int, list[str]]:
    """The parts of each landed file, in the order that makes it up."""
    parts = defaultdict(list)
    for path, _ in storage.data_files(spark, target):
        parts[_number_of(path)].append(path)
    return {n: sorted(paths, key=lambda p: int(p.rsplit("/at=", 1)[1].split("/", 1)[0])) for n, paths in sorted(parts.items())}


def read_landed(spark: SparkSession, target: str, multi_line: bool = False, malformed: str | None = None) -> DataFrame:
    """The landed CSV with every column as the text it holds. All files must have the same header.

    A line with too few or too many cells is filled up or cut. ``malformed`` names a column that is to hold such a line as
    it stands, null for all others; every cell of a line is parsed then.
    """
    below = {kind: f"{target}/kind={kind}" for kind in (FIRST, REST, WHOLE) if storage.exists(spark, f"{target}/kind={kind}")}
    if not below:
        raise FileNotFoundError(f"nothing was landed at {target}")
    reader = lambda: csv_reader(spark, multi_line).option("recursiveFileLookup", True).option("inferSchema", False)
    names = reader().csv(below[WHOLE] if WHOLE in below else below[FIRST]).columns
    texts = T.StructType([T.StructField(name, T.StringType()) for name in names])
    options = {"enforceSchema": False}
    if malformed:
        texts = texts.add(malformed, T.StringType())
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": malformed, "columnPruning": False}
    read = [reader().schema(texts).options(**options).option("header", kind != REST).csv(path) for kind, path in below.items()]
    out = read[0]
    for more in read[1:]:
        out = out.unionByName(more)
    return out


def line_digests(spark: SparkSession, paths: dict[str, int]) -> DataFrame:
    """``file_no, lines, digest`` of the files that paths belong to: digests add up over lines, so parts need no order."""
    named = [(storage.uri(spark, path), number) for path, number in paths.items()]
    numbers = spark.createDataFrame(named, "__path string, file_no int")  # a row per listed file
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(list(paths))
    told = lines.select("value", F.col("_metadata.file_path").alias("__path")).join(F.broadcast(numbers), "__path")
    return told.groupBy("file_no").agg(
        F.count("*").alias("lines"), F.sum(F.xxhash64("value").cast("decimal(38,0)")).alias("digest")
    )


def landing_check(spark: SparkSession, manifest: DataFrame, target: str) -> DataFrame:
    """Per landed file: ``file_no, bytes, lines, same_lines``, its lines compared with those of its source by digest."""
    sources = {row["source_file"]: row["file_no"] for row in manifest.where("bytes > 0").collect()}
    landed = {path: number for number, parts in parts_of(spark, target).items() for path in parts}
    if not sources:
        return manifest.select("file_no", "bytes", F.lit(0).cast("long").alias("lines"), F.lit(True).alias("same_lines"))
    before = line_digests(spark, sources)
    after = line_digests(spark, landed).select("file_no", F.col("lines").alias("__lines"), F.col("digest").alias("__digest"))
    told = manifest.join(before, "file_no", "left").join(after, "file_no", "left")
    same = F.col("digest").eqNullSafe(F.col("__digest")) & F.col("lines").eqNullSafe(F.col("__lines"))
    return told.select("file_no", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"), same.alias("same_lines"))
