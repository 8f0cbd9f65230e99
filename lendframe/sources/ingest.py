"""Gated ingestion: parse once, check, publish, record.

Each file is parsed once, with the schema of its contract, into a staging folder beside its target. Rows, malformed rows, encoding and
fingerprint are counted by that same pass (`DataFrame.observe`); every other check reads the staged Parquet, which is typed and columnar.
Only when all tables pass are the staged folders renamed to their targets, so a failed run leaves the targets as they were.
A file that is not UTF-8 is parsed a second time with the encoding that the first pass found.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as PT

from lendframe.operators import contracts as K
from lendframe.sources import tables as T

CORRUPT = "_corrupt_record"
MANIFEST = (
    "`table` string, input_file string, path string, rows bigint, cols int, dtypes string, encoding string, malformed bigint,"
    " input_fingerprint string, output_fingerprint string, input_bytes bigint, size_bytes bigint, overwrote boolean"
)


class GateError(RuntimeError):
    """Input broke its contract or changed since it was profiled; nothing was published."""


@dataclass(frozen=True)
class Staged:
    """A table parsed into its staging folder, with what the pass counted."""

    name: str
    source: str
    folder: str
    frame: DataFrame
    encoding: str
    rows: int
    malformed: int
    fingerprint: str


def fingerprint_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows, fingerprint), one scan per table."""
    parts = [T.content_fingerprint(df).select(F.lit(name).alias("table"), "*") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def file_schema(spark: SparkSession, path: str, contract: PT.StructType) -> PT.StructType:
    """The columns of a file in its own order: contracted ones with their type, others as text, all nullable."""
    known = {f.name: f.dataType for f in contract.fields}
    return PT.StructType([PT.StructField(n, known.get(n, PT.StringType())) for n in T.csv_header(spark, path)])


def observing(spark: SparkSession) -> SparkSession:
    """A session of the same application with the same settings, for passes that count on the way.

    A session that has observed a pass can no longer be sent along with a task, which fits of pyspark.ml do with theirs.
    """
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.isModifiable(key) and other.conf.get(key, None) != value:
            other.conf.set(key, value)
    return other


def stage(spark: SparkSession, name: str, path: str, contract: PT.StructType, folder: str) -> Staged:
    """Parse a CSV once and write it as Parquet, counting on the way."""
    schema = file_schema(spark, path, contract)
    names, own = schema.names, observing(spark)

    def write(encoding: str) -> dict:
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        raw = T.parse_csv(own, path, schema, CORRUPT)
        plain = raw.drop(CORRUPT)
        marked = raw.select(*plain.columns, F.col(CORRUPT).isNotNull().alias("_bad"), *[c.alias(f"_{n}") for n, c in T.encoding_marks(plain).items()])
        texts = T.in_encoding(marked, encoding)
        counts = {"rows": F.count(F.lit(1)), "malformed": F.count_if("_bad"), "not_utf8": F.count_if("_not_utf8"), "not_cp1252": F.count_if("_not_cp1252")}
        counts["fingerprint"] = F.coalesce(F.sum(T.row_digest(names)), F.lit(0).cast("decimal(38,0)"))
        watched = texts.observe(seen, *[c.alias(n) for n, c in counts.items()])
        T.write_parquet(watched.select(*[f"`{n}`" for n in names]), folder)
        return seen.get

    facts = write("utf-8")
    encoding = T.encoding_of(facts["not_utf8"], facts["not_cp1252"])
    if encoding != "utf-8":
        facts = write(encoding)
    frame = spark.read.schema(schema).parquet(folder)
    return Staged(name, path, folder, frame, encoding, facts["rows"], facts["malformed"], str(facts["fingerprint"]))


def malformed_rows(spark: SparkSession, staged: list[Staged]) -> DataFrame:
    """A violation for each table with rows that don't fit its schema (too few or many fields, or a value of another type)."""
    rows = [(s.name, "row_format", None, "0", str(s.malformed), "error") for s in staged if s.malformed]
    return spark.createDataFrame(rows, K.VIOLATION)


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder, from the file system's own records."""
    fs, where = _files(spark, path)
    return sum(f.getLen() for f in fs.globStatus(where) or [] if f.isFile()) or fs.getContentSummary(where).getLength()


def publish(spark: SparkSession, folder: str, target: str) -> bool:
    """Rename a staged folder to its target. What was there gives way only once the new one is complete; true if something was."""
    fs, new = _files(spark, folder)
    _, old = _files(spark, target)
    there = fs.exists(old)
    aside = _files(spark, f"{target}.replaced-{uuid.uuid4().hex}")[1]
    if there and not fs.rename(old, aside):
        raise OSError(f"{target} cannot be moved aside")
    fs.mkdirs(old.getParent())
    if not fs.rename(new, old):
        if there:
            fs.rename(aside, old)
        raise OSError(f"{folder} cannot be published as {target}")
    if there:
        fs.delete(aside, True)
    return there


def drop_staged(spark: SparkSession, folder: str) -> None:
    fs, where = _files(spark, folder)
    if fs.exists(where):
        fs.delete(where, True)


def ingest(
    spark: SparkSession,
    paths: Mapping[str, str],
    out_dir: str,
    columns: DataFrame,
    sizes: DataFrame,
    joins: DataFrame | None = None,
    recorded: DataFrame | None = None,
) -> DataFrame:
    """CSV tables to Parquet behind both gates (S9); returns the manifest.

    Nothing is published unless every table passes: no malformed rows, no broken contract, no fingerprint other than the recorded one.
    Inputs without a recorded fingerprint are let through. All violations are written beside out_dir before an error is raised.
    """
    out_dir = out_dir.rstrip("/")
    rules: dict[str, list] = {}
    for r in columns.select("table", "feature", "dtype", "nullable").collect():
        rules.setdefault(r["table"], []).append(r)
    staging = f"{out_dir}-staging-{uuid.uuid4().hex}"
    try:
        staged = [stage(spark, name, path, T.contract_schema(rules.get(name, [])), f"{staging}/{name}") for name, path in paths.items()]
        frames = {s.name: s.frame for s in staged}
        violations, _ = K.validate(frames, columns, sizes, joins)
        report = T.write_json(violations.unionByName(malformed_rows(spark, staged)), f"{out_dir}-violations")
        errors = T.read_violations(spark, report).where("severity = 'error'").count()
        if errors:
            raise GateError(f"validation failed: {errors} errors, all listed in {report}")
        if recorded is not None:
            current = spark.createDataFrame([(s.name, s.fingerprint) for s in staged], "`table` string, fingerprint string")
            stale = T.stale_inputs(current, recorded).where("state = 'mismatch'").collect()
            if stale:
                raise GateError("inputs changed since profiling: " + ", ".join(r["table"] for r in stale))
        # what was written is read back before it is published
        after = {r["table"]: (r["rows"], r["fingerprint"]) for r in fingerprint_table(frames).collect()}
        wrong = [s.name for s in staged if after[s.name] != (s.rows, s.fingerprint)]
        if wrong:
            raise GateError("staged files differ from what was parsed: " + ", ".join(wrong))
        manifest = []
        for s in staged:
            target = f"{out_dir}/{s.name}"
            overwrote = publish(spark, s.folder, target)
            dtypes = ", ".join(f"{c} {t}" for c, t in s.frame.dtypes)
            prints = s.fingerprint, after[s.name][1]
            manifest.append((s.name, s.source, target, s.rows, len(s.frame.columns), dtypes, s.encoding, s.malformed, *prints, size_of(spark, s.source), size_of(spark, target), overwrote))
    finally:
        drop_staged(spark, staging)
    return spark.createDataFrame(manifest, MANIFEST)
