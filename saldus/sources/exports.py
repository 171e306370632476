"""Reading a ledger export: rows of text cells under the export's headers, with _ord, the row's place."""

from __future__ import annotations

import re
import uuid
from itertools import accumulate
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldus.sources.failures import ImportFailure
from saldus.sources.storage import Storage
from saldus.sources.workbook import WorkbookSource


def file_rows() -> tuple[Column, ...]:
    """What places a row of a Parquet file: its file and its number there."""
    return F.col("_metadata.file_path").alias("_file"), F.lit(0).cast("long").alias("_start"), F.col("_metadata.row_index").alias("_row")


def file_splits() -> tuple[Column, ...]:
    """What places a row of any file: its file, the start of its split, and a number that grows inside it."""
    return F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_row")


def read_table(spark: SparkSession, path: str | list[str], order: str | None = None) -> DataFrame:
    """A parquet or CSV export of one or more files. order: the column that holds the row's place. Without it, rows are in the order of their files' paths and of their place in a file.

    Codes are text in the end, whole numbers without a point.
    """
    first = path if isinstance(path, str) else path[0]
    csv = first.lower().rstrip("/").endswith(".csv")
    raw = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"') if csv else spark.read.parquet(*([path] if isinstance(path, str) else path))
    if order or "_ord" in raw.columns:
        return numbered(as_text(raw), order)
    return as_text(in_file_order(raw.select("*", *(file_splits() if csv else file_rows()))))


def in_file_order(placed: DataFrame) -> DataFrame:
    """Rows of files (with _file, _start and _row) numbered from 0 on in _ord: files by path, splits of a file by where they start, rows of a split as they stand.

    Two passes: the first counts the rows of each split, and a running sum of the counts says where each begins. The driver handles a row for each split, as Spark's own list of files does;
    the join takes them to the rows. If Spark cuts the files into other splits by the second pass, rows would get wrong places: that fails, and is never silent.
    """
    counted = placed.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("first")).collect()
    counted.sort(key=lambda r: (unquote(r["_file"]), r["_start"]))
    begins = [0, *accumulate(r["n"] for r in counted)]
    splits = placed.sparkSession.createDataFrame([(*r, at) for r, at in zip(counted, begins, strict=False)], "_file string, _start long, _n long, _first long, _begin long")
    place = F.col("_row") - F.col("_first")
    found = F.when((place >= 0) & (place < F.col("_n")), F.col("_begin") + place)
    moved = F.raise_error(F.concat(F.lit("split anew while its rows were numbered: "), "_file")).cast("long")
    return placed.join(splits, ["_file", "_start"], "left").withColumn("_ord", F.coalesce(found, moved)).drop("_file", "_start", "_row", "_n", "_first", "_begin")


def as_text(raw: DataFrame) -> DataFrame:
    """Every cell as text; numbers with a fraction of zero lose it."""
    whole = lambda c, kind: F.when(F.col(f"`{c}`") == F.floor(f"`{c}`"), F.col(f"`{c}`").cast("bigint").cast("string")).otherwise(F.col(f"`{c}`").cast("string")) if kind in ("double", "float") else F.col(f"`{c}`").cast("string")
    return raw.select(*(F.col(c) if c == "_ord" else whole(c, kind).alias(c) for c, kind in raw.dtypes))


def numbered(raw: DataFrame, order: str | None = None) -> DataFrame:
    """raw with _ord: a column of its own, or the order in which partitions hold the rows."""
    if "_ord" in raw.columns:
        return raw
    if order:
        return raw.withColumn("_ord", F.col(f"`{order}`").cast("bigint"))
    return raw.withColumn("_ord", F.monotonically_increasing_id())


def read_sheets(spark: SparkSession, path: str, first: bool = False) -> DataFrame:
    """(file, sheet, sheet_idx, row_idx, cells, shown, is_text) of all sheets of the workbooks under path, or of the first sheets; see sources.workbook."""
    spark.dataSource.register(WorkbookSource)
    return spark.read.format("workbook").option("first", str(first).lower()).load(path)


def matrix_of(sheets: DataFrame) -> DataFrame:
    """read_sheets() for profiling: cells as the workbooks show them, which are text all of them."""
    return sheets.select("sheet", "row_idx", F.col("shown").alias("cells"), F.transform("shown", lambda c: c != "").alias("is_text"))


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of a workbook under the headers of its first row, with _ord; blank rows are left out. Only the headers come to the driver.

    A column without a header is __EMPTY; of columns of one header, all but the first have a number behind it.
    """
    rows = read_sheets(spark, path, first=True).where("sheet_idx = 0")
    try:
        head = rows.where("row_idx = 0").select("shown").first()
    except Exception as e:
        if "erro_leitura" in str(e):
            raise ImportFailure("erro_leitura") from e
        raise
    names: list[str] = []
    for given in head["shown"] if head else ():
        name, k = given or "__EMPTY", 0
        while name in names:
            k += 1
            name = f"{given or '__EMPTY'}_{k}"
        names.append(name)
    below = rows.where((F.col("row_idx") > 0) & F.exists("cells", lambda c: c != ""))
    if not names or below.isEmpty():
        raise ImportFailure("planilha_vazia")
    return below.select(F.col("row_idx").alias("_ord"), *(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)))


#: Fixed value: bytes of an upload, at most.
UPLOAD_BYTES = 50 * 1024 * 1024


def file_name(header: str | None) -> str | None:
    """The name that an upload gives in percent-encoded UTF-8; None without one, and for what can't be decoded."""
    if not header or re.search("%(?![0-9A-Fa-f]{2})", header):
        return None
    try:
        return unquote(header, errors="strict")
    except UnicodeDecodeError:
        return None


def check_size(data: bytes) -> None:
    if len(data) > UPLOAD_BYTES:
        raise ImportFailure("upload_invalido")


def read_upload(spark: SparkSession, data: bytes, name: str, folder: str) -> DataFrame:
    """An uploaded workbook's first sheet; the upload is put into folder, a URI that all executors read, under a name of its own, and stays there as long as the result is read."""
    check_file(name, data)
    storage, own = Storage(spark, folder), f"{uuid.uuid4().hex}.xls"
    storage.write(own, data)
    return read_workbook(spark, storage.at(own))


def check_file(name: str, data: bytes) -> None:
    if not name.lower().endswith(".xls"):
        raise ImportFailure("formato_invalido")
    if not data:
        raise ImportFailure("arquivo_vazio")


def read_matrix(spark: SparkSession, sheets: dict[str, list[list[object]]]) -> DataFrame:
    """(sheet, row_idx, cells, is_text) of sheets at hand on the driver, for profiling; is_text: whether each cell was text in the sheet."""
    rows = [(name, i, [None if c is None else str(c) for c in cells], [isinstance(c, str) for c in cells]) for name, own in sheets.items() for i, cells in enumerate(own)]
    return spark.createDataFrame(rows, "sheet string, row_idx bigint, cells array<string>, is_text array<boolean>")
