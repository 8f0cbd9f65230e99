"""Readers and writers: CSV with encoding fallback, Parquet, JSON, fingerprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CP1252 = "cp1252"
# The five byte values that the Windows code page leaves undefined.
CP1252_UNDEFINED = "\x81\x8d\x8f\x90\x9d"
#: Leading hex digits of a row digest that are summed: 60 bits, the same number in any SQL engine.
ROW_DIGITS = 15


def contract_schema(columns: Sequence[Mapping]) -> T.StructType:
    """StructType of a table from its contract rows (feature, dtype, nullable); dtype as Spark spells it."""
    kinds = {c["dtype"]: T.StructType.fromDDL(f"x {c['dtype']}")[0].dataType for c in columns}
    return T.StructType([T.StructField(c["feature"], kinds[c["dtype"]], bool(c["nullable"])) for c in columns])


# --- CSV --------------------------------------------------------------------
# A file is parsed as ISO-8859-1, which gives every byte a character and loses none; delimiters, quotes and line ends are ASCII in all
# three encodings. So the bytes of a text are still there after the parse: whether they are UTF-8 is counted in the same pass that uses them.


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _bytes_as_text(c: Column) -> Column:
    return F.encode(c, "ISO-8859-1").cast("string")


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a headered CSV; reads its first line."""
    names = spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path).columns
    raw = [n.encode("latin-1") for n in names]
    try:
        return [n.decode() for n in raw]
    except UnicodeDecodeError:
        return [n.decode(CP1252, "replace") for n in raw]


def parse_csv(spark: SparkSession, path: str, schema: T.StructType | None, corrupt: str | None = None) -> DataFrame:
    """Headered CSV, one character a byte. A malformed row raises, or is kept in the column `corrupt` with null for what doesn't fit."""
    reader = spark.read.option("header", True).option("encoding", "ISO-8859-1").option("mode", "PERMISSIVE" if corrupt else "FAILFAST")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if corrupt:
        reader = reader.option("enforceSchema", not all(n.isascii() for n in schema.names))  # each file's header is compared
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).csv(path)


def encoding_marks(df: DataFrame) -> dict[str, Column]:
    """Of each parsed row: whether its texts are not UTF-8, and whether they hold a byte that the Windows code page lacks."""
    odd, undefined = F.lit(False), F.lit(False)
    for c in _text_columns(df):
        x = F.col(f"`{c}`")
        odd = odd | F.coalesce(~F.is_valid_utf8(_bytes_as_text(x)), F.lit(False))
        undefined = undefined | F.coalesce(F.translate(x, CP1252_UNDEFINED, "") != x, F.lit(False))
    return {"not_utf8": odd, "not_cp1252": undefined}


def encoding_of(not_utf8: int, not_cp1252: int) -> str:
    """utf-8, cp1252, else latin-1: the first that can read all rows."""
    return "utf-8" if not not_utf8 else "latin-1" if not_cp1252 else CP1252


def in_encoding(df: DataFrame, encoding: str) -> DataFrame:
    """Parsed rows with their texts in the given encoding; the Windows code page needs no codec, its 0x80-0x9F range is translated."""
    source = [b for b in range(0x80, 0xA0) if chr(b) not in CP1252_UNDEFINED]
    plain, fancy = "".join(map(chr, source)), bytes(source).decode(CP1252)
    read = {"utf-8": _bytes_as_text, CP1252: lambda c: F.translate(c, plain, fancy), "latin-1": lambda c: c}[encoding]
    text = set(_text_columns(df))
    return df.select(*[read(F.col(f"`{c}`")).alias(c) if c in text else F.col(f"`{c}`") for c in df.columns])


def _decoded(df: DataFrame) -> tuple[DataFrame, str]:
    counts = df.agg(*[F.count_if(c).alias(n) for n, c in encoding_marks(df).items()]).first() if _text_columns(df) else (0, 0)
    encoding = encoding_of(*counts)
    return in_encoding(df, encoding), encoding


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> tuple[DataFrame, str]:
    """Headered CSV and the encoding that fits it: utf-8, cp1252, else latin-1 (S1, S2). The encoding is asked in one pass before."""
    return _decoded(parse_csv(spark, path, schema))


def read_columns(spark: SparkSession, path: str, columns: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """CSV scan that converts the named columns only (S4); the encoding is that of these columns, and numbers are not read for it."""
    return _decoded(parse_csv(spark, path, schema).select(*[f"`{c}`" for c in columns]))[0]


def head_sample(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """First rows for a quick look."""
    return df.limit(rows)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan, pruned to the named columns (S6, S7); a missing path raises."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Snappy Parquet, replacing what was there."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, order: Sequence[Column | str] = ()) -> str:
    """Headered CSV in the given order (S12); blanks around a text are kept."""
    writer = (df.orderBy(*order) if order else df).write.mode("overwrite").option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """One JSON record per row."""
    df.write.mode("overwrite").json(path)
    return path


def row_digest(columns: Sequence[str]) -> Column:
    """60 bits of the MD5 of a row: every value with its length, nulls marked, so no two rows spell alike."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, ROW_DIGITS), 16, 10).cast("decimal(38,0)")


def content_fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, rows, fingerprint) of a table regardless of row order (S11, any size); nulls count by their place."""
    total = F.coalesce(F.sum(row_digest([c for c in df.columns if c not in by])), F.lit(0).cast("decimal(38,0)"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), total.cast("string").alias("fingerprint"))


def file_fingerprints(df: DataFrame) -> DataFrame:
    """(path, rows, fingerprint) per file of a scan (S11), in the scan's own tasks, whatever the size of a file."""
    return content_fingerprint(df.select("*", F.col("_metadata.file_path").alias("path")), ["path"])


def read_violations(spark: SparkSession, path: str) -> DataFrame:
    """Violations that the ingestion gate wrote."""
    return spark.read.schema("`table` string, check string, `column` string, expected string, observed string, severity string").json(path)


def stale_inputs(current: DataFrame, recorded: DataFrame, key: str = "table", value: str = "fingerprint") -> DataFrame:
    """Per input: match, mismatch, or unrecorded."""
    old = recorded.select(key, F.col(value).alias("recorded"))
    state = F.when(F.col("recorded").isNull(), "unrecorded").when(F.col("recorded") == F.col(value), "match").otherwise("mismatch")
    return current.join(old, key, "left").select(key, value, "recorded", state.alias("state"))


def save_model(model, path: str, metadata: Mapping[str, str]) -> str:
    """Model with a one-row description next to it."""
    from pyspark.sql import SparkSession as S

    model.write().overwrite().save(f"{path}/model")
    row = {k: str(v) for k, v in metadata.items()}
    S.getActiveSession().createDataFrame([row]).write.mode("overwrite").json(f"{path}/metadata")
    return path


def load_model(spark: SparkSession, path: str, kind) -> tuple[object, dict[str, str]]:
    """Model of the given class and its description."""
    return kind.load(f"{path}/model"), spark.read.json(f"{path}/metadata").first().asDict()
