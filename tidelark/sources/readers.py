"""Scans: string tables, JSONL logs, glossaries, manifests.  Small dimension files are parsed on the driver."""

from __future__ import annotations

import codecs
import csv
import io
import itertools
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.order import numbered
from ..operators.helpers import keep_last, number_repeats, pick_column

ENCODINGS = ("utf-8-sig", "utf-8", "gb18030", "gbk", "cp936")
ALIASES = {"id": "string_id", "key": "string_id", "source": "source_zh", "text": "source_zh", "locale": "source_locale"}
TARGETS = ("target_text", "translated_text", "target_en", "target_ru", "target_zh", "tokenized_target")


def detect_encoding(raw: bytes, candidates: Sequence[str] = ENCODINGS) -> str:
    for name in candidates:
        try:
            raw.decode(name)
        except UnicodeDecodeError:
            continue
        return name
    raise ValueError(f"none of {', '.join(candidates)} decodes the file")


def read_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """All-string CSV with a header; a byte-order mark goes, missing values are empty; ``encoding='auto'`` probes the file's head."""
    if encoding == "auto":
        head = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 1 << 20).alias("c")).first()
        raw = bytes(head["c"]) if head else b""
        cut = raw if len(raw) < 1 << 20 else raw[: raw.rfind(b"\n") + 1]
        encoding = detect_encoding(cut)
    if encoding not in (None, "utf-8", "utf-8-sig"):
        return _decoded_csv(spark, path, encoding)
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "emptyValue": "", "encoding": "UTF-8"}
    df = spark.read.options(**options).csv(path)
    df = df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns if c.startswith("﻿")})
    return df.fillna("")


def _decoded_csv(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """CSV in a charset that Spark's own reader doesn't take: a file a task (quoted line breaks don't split either)."""
    files = spark.read.format("binaryFile").load(path).select("content")
    head = files.select(F.substring("content", 1, 1 << 20).alias("c")).first()
    names = next(csv.reader(io.StringIO(codecs.getincrementaldecoder(encoding)().decode(bytes(head["c"])))), []) if head else []
    names = [n.lstrip("\ufeff") for n in names]

    def rows(batches):
        for batch in batches:
            for content in batch.column(0):
                found = csv.reader(io.TextIOWrapper(io.BytesIO(content.as_py()), encoding, newline=""))
                next(found, None)
                while part := list(itertools.islice(found, 10_000)):
                    wide = [[*r, *[""] * (len(names) - len(r))][: len(names)] for r in part if r]
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in wide], pa.string()) for i in range(len(names))], names=names)

    return files.mapInArrow(rows, ", ".join(f"`{n}` string" for n in names))


def with_line_numbers(df: DataFrame, order: str) -> DataFrame:
    """Line numbers from 2 (the header is line 1) in an explicit order."""
    return numbered(df, [order], "row").withColumn("row", F.col("row") + 1)


def ingest(df: DataFrame, required: Sequence[str] = ("string_id", "source_zh", "context", "source_locale"), aliases: Mapping[str, str] = ALIASES) -> DataFrame:
    """Header aliases renamed (where the name is free), missing required columns empty."""
    names = {c: aliases[c.lower()] for c in df.columns if c.lower() in aliases and aliases[c.lower()] not in df.columns}
    df = df.withColumnsRenamed(names)
    return df.withColumns({c: F.lit("") for c in required if c not in df.columns})


def read_workbook(spark: SparkSession, path: str, marker: str, source: str, target: str) -> DataFrame:
    """Sheets whose header holds ``marker``; rows that lack either side go.  Needs openpyxl on the driver."""
    import pandas as pd

    raw = spark.read.format("binaryFile").load(path).select("content").first()[0]
    sheets = pd.read_excel(io.BytesIO(bytes(raw)), sheet_name=None, dtype=str)
    rows = [(name, str(r[source]), str(r[target])) for name, s in sheets.items() if marker in s.columns for r in s.dropna(subset=[source, target]).to_dict("records")]
    return spark.createDataFrame(rows, "sheet string, source string, target string")


def skip_second_header(df: DataFrame, order: str, source: str, limit: int | None = None) -> DataFrame:
    """Without the first data row (a second header) and rows of empty source; optionally the first ``limit``."""
    first = df.agg(F.min(order).alias("_first"))
    out = df.join(F.broadcast(first)).filter((F.col(order) != F.col("_first")) & (F.trim(source) != "")).drop("_first")
    return out.orderBy(order).limit(limit) if limit else out


def unique_ids(df: DataFrame, key: str, order: str) -> DataFrame:
    return number_repeats(df, key, order)


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType, strict: bool = False, file_column: str | None = None) -> DataFrame:
    """JSONL by schema: malformed lines are dropped, or fail the job if ``strict``; files can be named in a column."""
    df = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(paths)
    return df.withColumn(file_column, F.col("_metadata.file_name")) if file_column else df


def read_trace(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    return read_jsonl(spark, paths, schema).filter("type = 'llm_call'")


GLOSSARY = "term_zh string, term_ru string, scope string, status string, language_pair string, source string, source_file string, tags array<string>, avoid_long_form array<string>, targets map<string,string>, confidence double, note string"
_FIELDS = [x.split()[0] for x in GLOSSARY.split(", ")]


def glossary_rows(documents: Mapping[str, Mapping]) -> list[tuple]:
    """Entries of parsed glossary files; file-level metadata fills what an entry leaves blank."""
    out = []
    for name, doc in documents.items():
        meta = doc.get("meta") or {}
        for e in doc.get("entries") or []:
            fill = {"scope": meta.get("scope"), "language_pair": meta.get("language_pair"), "source": meta.get("source"), "source_file": name}
            row = {k: e.get(k) for k in _FIELDS}
            row |= {k: v for k, v in fill.items() if not str(row.get(k) or "").strip()}
            row["tags"], row["avoid_long_form"] = list(row["tags"] or []), list(row["avoid_long_form"] or [])
            row["confidence"] = float(row["confidence"]) if row["confidence"] is not None else None
            out.append(tuple(row[k] for k in _FIELDS))
    return out


def read_glossaries(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """YAML glossaries, read through Spark (any store), parsed on the driver, united by name."""
    import yaml

    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content").collect()
    return spark.createDataFrame(glossary_rows({f["path"].rsplit("/", 1)[-1]: yaml.safe_load(bytes(f["content"])) or {} for f in files}), GLOSSARY)


def resolved_targets(entries: DataFrame, locale: str, seq: str) -> DataFrame:
    """term, target for a locale: the targets map, or the old field for Russian; the last entry of a term wins."""
    old = F.col("term_ru") if locale.lower().startswith("ru") else F.lit(None).cast("string")
    target = F.coalesce(F.try_element_at("targets", F.lit(locale)), old)
    rows = entries.select(F.col("term_zh").alias("term"), target.alias("target"), seq).filter("term <> '' AND target <> ''")
    return keep_last(rows, ["term"], seq).select("term", "target")


def usable_entries(entries: DataFrame, compiled: bool = False) -> DataFrame:
    status = F.when(F.coalesce(F.trim("status"), F.lit("")) == "", "approved" if compiled else "proposed").otherwise(F.lower(F.trim("status")))
    return entries.withColumn("status", status).filter(F.col("status").isin("approved", "proposed", "banned"))


def source_texts(df: DataFrame, order: str) -> DataFrame:
    """string_id, text, module_tag, source_line_no of rows with text."""
    key, text = pick_column(df, ("string_id", "id", "key")), pick_column(df, ("source_zh", "text", "source"))
    if not key or not text:
        raise ValueError("an id and a text column are needed")
    module = F.coalesce(F.nullif(F.col("module_tag"), F.lit("")), F.lit("misc")) if "module_tag" in df.columns else F.lit("misc")
    return df.filter(F.trim(text) != "").select(F.col(key).alias("string_id"), F.col(text).alias("text"), module.alias("module_tag"), F.col(order).alias("source_line_no"))


TASK = "string_id string, type string, severity string, detail string, source string, target string, source_text string, current_translation string, issues array<struct<type:string,severity:string,detail:string>>"


def repair_tasks(raw: DataFrame) -> DataFrame:
    """Tasks from report objects (errors[]), single objects or JSONL lines; source and target renamed."""
    error = "struct<string_id:string,type:string,severity:string,detail:string,source:string,target:string>"
    fields = raw.schema.fieldNames()
    blank = F.lit(None).cast("string")
    col = lambda *names: F.coalesce(*[F.col(n) for n in names if n in fields], blank)
    plain = raw.select(col("string_id").alias("string_id"), col("type").alias("type"), col("severity").alias("severity"), col("source_text", "source").alias("source_text"), col("current_translation", "target").alias("current_translation")).filter("string_id IS NOT NULL")
    if "errors" not in fields:
        return plain
    exploded = raw.select(F.explode(F.col("errors").cast(f"array<{error}>")).alias("e")).select("e.string_id", "e.type", "e.severity", F.col("e.source").alias("source_text"), F.col("e.target").alias("current_translation"))
    return plain.unionByName(exploded)


def discover_runs(manifests: DataFrame, prefix: str, window: int) -> DataFrame:
    """The latest ``window`` runs whose id has the prefix, newest first."""
    return manifests.filter(F.col("run_id").startswith(prefix)).orderBy(F.desc(F.coalesce("started_at", "timestamp")), "run_id").limit(window)


def pattern_list(text: str) -> list[str]:
    """One pattern a line; blank lines and comments go."""
    return [x.strip() for x in text.splitlines() if x.strip() and not x.lstrip().startswith("#")]


def layered_rules(base: Sequence[tuple[str, str]], locale: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Base rules with the locale's laid over by source; an override keeps its base's place."""
    merged = dict(base)
    merged.update(locale)
    return list(merged.items())


def done_ids(checkpoints: DataFrame, column: str = "done_ids") -> DataFrame:
    return checkpoints.select(F.explode(column).alias("string_id")).distinct()
